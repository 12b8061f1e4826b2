import random
import re

import numpy as np
import pytest
import xxhash

from cairn.llm import simhash as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fp(text):
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    sh = [" ".join(ws[k : k + 4]) for k in range(len(ws) - 3)] if len(ws) >= 4 else [" ".join(ws)] if ws else []
    votes = [0] * 64
    for x in sh:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for k in range(64):
            votes[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(sh))


def roots(values, radius):
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def test_fingerprints_and_components(small):
    rows = sorted(small.collect(), key=lambda r: r.doc_id)
    prints = [fp(r.text) for r in rows]
    want = {r.doc_id: (f"{p:016x}", rows[k].doc_id) for r, p, k in zip(rows, prints, roots(prints, 4), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in s.near_duplicates(small).collect()} == want


def near_set(rng, n, centres, radius):
    out = []
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randrange(radius)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_all_within_the_radius(seed, monkeypatch):
    rng = random.Random(seed)
    shards = [near_set(rng, n, [rng.getrandbits(64) for _ in range(5)], 9) for n in (400, 1, 2, 3, 60)]
    values = [x for v in shards for x in v]
    fps, shard = np.array(values, np.uint64).reshape(-1, 1), np.repeat(np.arange(5), [len(v) for v in shards])
    monkeypatch.setattr(s, "FRONTIER", 100)
    want = {(i, j) for i in range(len(values)) for j in range(i) if shard[i] == shard[j] and bin(values[i] ^ values[j]).count("1") <= 4}
    forest = s.Forest(fps, shard)
    assert len(forest.kids) == len(values) - 5 and all(forest.edges % forest.stride == s.distances(fps[forest.kids], fps[forest.parent[forest.kids]]))
    assert {(int(i), int(j)) for x, y in forest.links(4, np.arange(len(values)), False) for i, j in zip(x, y, strict=True)} == want
    label = roots(values[: len(shards[0])], 4)
    assert s.connect(fps, shard, 4)[: len(shards[0])].tolist() == label
    groups = np.array(label + list(range(len(label), len(values))))
    between = {(int(i), int(j)) for x, y in forest.links(9, groups, False) for i, j in zip(x, y, strict=True)}
    assert between == {(i, j) for i in range(len(values)) for j in range(i) if shard[i] == shard[j] and groups[i] != groups[j] and bin(values[i] ^ values[j]).count("1") <= 9}


def test_tree_follows_only_edges_within_the_radius(monkeypatch):
    rng = random.Random(2)
    values = sorted({rng.getrandbits(64) & 0xFFFF for _ in range(3000)})
    forest = s.Forest(np.array(values, np.uint64).reshape(-1, 1), np.zeros(len(values), np.int64))
    seen, plain = [0], s.distances
    monkeypatch.setattr(s, "distances", lambda a, b: (seen.append(len(a)), plain(a, b))[1])
    list(forest.links(1, np.arange(len(values)), False))
    assert sum(seen) < len(values) ** 2 / 4


@pytest.mark.parametrize("least", [10, 100, 10**6])
def test_large_shards_are_cut_without_loss(monkeypatch, least):
    monkeypatch.setattr(s, "LARGE", least)
    rng = np.random.default_rng(1)
    shard, ident = np.repeat([5, 9, 11], [300, 3, 40]), rng.integers(-(2**60), 2**60, 343)
    rows, new = s.cut_large(shard, ident, np.select([shard == 5, shard == 11], [300 * (300 > least), 40 * (40 > least)], 0))
    meet = {}
    for r, k in zip(rows.tolist(), new.tolist(), strict=True):
        meet.setdefault(k, set()).add(r)
    pairs = {(i, j) for v in meet.values() for i in v for j in v if i < j}
    assert pairs == {(i, j) for i in range(343) for j in range(i + 1, 343) if shard[i] == shard[j]}
    assert max(map(len, meet.values())) <= max(2 * least, 50)


def test_a_shard_of_half_a_million_equal_blocks():
    """One block value throughout: memory stays with the shard's rows, not with their pairs."""
    import tracemalloc

    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 50, 500_000).astype(np.uint64))
    rows, shard = s.cut_large(np.zeros(len(fps), np.int64), fps.view(np.int64), np.full(len(fps), len(fps)))
    assert np.bincount(np.unique(shard, return_inverse=True)[1]).max() < 1.2 * s.LARGE
    one = fps[rows[shard == shard[0]]][:20_000].reshape(-1, 1)
    tracemalloc.start()
    s.connect(one, np.zeros(len(one), np.int64), 4)
    assert tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()


@pytest.mark.parametrize("n", [0, 10**8, 10**11])
def test_blocks_lose_no_link(spark, n):
    rng = random.Random(7)
    values = near_set(rng, 600, [rng.getrandbits(64) for _ in range(12)], 12)
    nodes = spark.createDataFrame([(bytearray(x.to_bytes(8, "big")),) for x in values], "fp binary")
    found = s.components(s.edges(nodes, s.block_masks(64, 4, n), 64, 4)).collect()
    root = {bytes(r.node): bytes(r.root) for r in found}
    got = [root.get(x.to_bytes(8, "big"), x.to_bytes(8, "big")) for x in values]
    assert got == [values[k].to_bytes(8, "big") for k in roots(values, 4)]


def test_keys_grow_with_the_fingerprints():
    assert [len(s.block_masks(64, 4, n)) for n in (0, 10**7, 10**9, 10**11, 10**12)] == [5, 5, 15, 35, 70]


def test_links_come_from_trees(small, monkeypatch):
    """Without what the trees say no document has a link."""
    assert any(r.component_id != r.doc_id for r in s.near_duplicates(small).collect())
    rows = s.near_duplicates(small.dropDuplicates(["text"]))
    distinct = {r.fingerprint: r.component_id for r in rows.collect()}
    assert len(set(distinct.values())) < len(distinct)
    monkeypatch.setattr(s, "connect", lambda fps, shard, radius: np.arange(len(fps)))
    distinct = {r.fingerprint: r.component_id for r in s.near_duplicates(small.dropDuplicates(["text"])).collect()}
    assert len(set(distinct.values())) == len(distinct)


def test_large_shards_are_a_table(spark, monkeypatch):
    """However many shards are large, each is cut by the size that the sample tells; nothing of them passes through the driver."""
    monkeypatch.setattr(s, "LARGE", 100)
    rows = spark.createDataFrame([(k % 10, k) for k in range(5000)] + [(1000 + k, k) for k in range(40)], "shard long, id long")
    out = s.cut(rows, rows.where("pmod(xxhash64(id), 16) = 0"), s._ids)
    assert out.columns == rows.columns
    meet = {}
    for r in out.collect():
        meet.setdefault(r.shard, set()).add(r.id)
    pairs = {(a, b) for v in meet.values() for a in v for b in v if a < b}
    assert len(pairs) == 10 * 500 * 499 / 2 and all(a % 10 == b % 10 for a, b in pairs)
    assert len(meet) > 200 and max(map(len, meet.values())) <= 200 and s.cut(rows, rows.limit(0), s._ids) is rows


def test_cut_shards_give_the_same_groups(small, monkeypatch):
    whole = sorted(map(tuple, s.near_duplicates(small).collect()))
    kept = sorted(map(tuple, s.keep_one(small).collect()))
    monkeypatch.setattr(s, "LARGE", 4)
    assert sorted(map(tuple, s.near_duplicates(small).collect())) == whole
    assert sorted(map(tuple, s.keep_one(small).collect())) == kept


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in s.components(links).collect()} == {**{k: 0 for k in range(1, 61)}, 101: 100}


def test_odd_rows(odd, empty):
    rows = s.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].fingerprint == "0" * 16 and by[2].component_id == by[3].component_id == by[4].component_id == 2
    assert by[6].component_id == 5 and s.near_duplicates(empty).collect() == []


def test_keep_one(clashing, empty):
    out = s.keep_one(clashing)
    rows = out.collect()
    assert out.columns == clashing.columns
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [-5, 1, 2, 5, 7, 8, 9]
    assert [r.text[:6] for r in rows if r.doc_id is None] == ["Nobody"]
    assert s.keep_one(empty).collect() == []


def test_stage_finds_near_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(5000)]
    rows, groups = [], {}
    for g in range(40):
        text = [rng.choice(vocabulary) for _ in range(300)]
        for c in range(3):
            copy = list(text)
            for _ in range(3 * c):  # similarity of shingles of five words 0.8 or more to the first
                copy[rng.randrange(300)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
            groups[len(rows) - 1] = g
    kept = [r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len({groups[k] for k in kept}) == 40 and len(kept) <= 44


def test_stage_links_by_exact_similarity_only(spark):
    """Isolated pairs on both sides of 0.8: each one above goes, none below."""
    rng = random.Random(5)
    rows, above = [], set()
    for g in range(400):
        text = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        copy = text[: rng.randrange(140, 190)] + [f"v{rng.randrange(10**6)}" for _ in range(10)]
        sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (text, copy)]
        if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]):
            above.add(2 * g + 1)
        rows += [(2 * g, " ".join(text)), (2 * g + 1, " ".join(copy))]
    kept = {r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert above and len(above) < 400 and kept == set(range(800)) - above


def test_stage_loses_no_isolated_pair_at_the_threshold(spark):
    rng = random.Random(9)
    rows = []
    for g in range(300):
        text = [f"w{rng.randrange(10**7)}" for _ in range(204)]
        copy = text[:182] + [f"v{rng.randrange(10**7)}" for _ in range(22)]  # 178 of 222 shingles are common
        rows += [(2 * g, " ".join(text)), (2 * g + 1, " ".join(copy))]
    kept = {r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(0, 600, 2))


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for n in (0, 1, 30, 500, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        y = np.union1d(x[n // 4 :], rng.integers(0, 1 << 63, n // 5, dtype=np.uint64))
        apart = len(np.setxor1d(x, y))
        differ = int(s.distances(s.sketch(x).view(np.uint64), s.sketch(y).view(np.uint64)))
        assert differ <= apart and (n > 100 or differ >= 0.8 * apart)


def test_texts_alike_below_the_threshold_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies with three changes each of a text: those that were not made from it by few changes are no near duplicates of each other."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(500):
        text = list(base)
        for at in rng.sample(range(5, 145), 1 if k % 10 == 0 else 3):
            text[at] = f"v{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for _, t in rows]
    up = list(range(500))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(500):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    asked, plain = [], s.verified
    monkeypatch.setattr(s, "verified", lambda pairs, texts, width: (asked.append(pairs.count()), plain(pairs, texts, width))[1])
    kept = {r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {k for k in range(500) if find(k) == k} and 1 < len(kept) < 450
    assert sum(asked) < 20_000, asked
