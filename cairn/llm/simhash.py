"""SimHash near-duplicates (3): fingerprints, BK-trees over shards of them, and connected groups.

Shards: a fingerprint is cut into radius + 1 blocks, and one shard holds the distinct fingerprints that agree in one
block. Two fingerprints within the radius agree in a block at least, so a tree of each shard loses no link. Trees over
all documents have no size bound and would take every fingerprint through the driver, so they are not broadcast: each
is built in the task to which its shard is dealt. A shard of more than LARGE members is cut into chunks, and any two of
its chunks meet in a shard of their own. Only a spanning set of a shard's links leaves the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, free_prefix, row_key, stored, whole_groups

SEED = 42
COMMON = 200_000
#: Members of a shard that one task compares; larger shards are cut.
LARGE = 1 << 16
SAMPLE = 16
FRONTIER = 2_000_000
#: Bits of a set's sketch; few of a set's differences fall together up to some 1,000 of them.
SKETCH = 1024
#: Odd multipliers that turn one shingle hash into further ones, for fingerprints of more than 64 bits.
MIXERS = tuple(np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1)) for k in range(16))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of the word shingles of a text, repeats included; fewer words give one shingle of all, none an empty array."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    joined = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends[: n - width])]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)), np.uint64, n - width + 1)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> np.ndarray:
    """bits / 64 unsigned words: a bit is 1 if it is set in over half the hashes."""
    out = np.zeros(bits // 64, np.uint64)
    if not len(hashes):
        return out
    for w in range(bits // 64):
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 14):
            h = hashes[at : at + (1 << 14)]
            if w:
                h = (h ^ (h >> np.uint64(31))) * MIXERS[w]
                h ^= h >> np.uint64(29)
            votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        out[w] = np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def distances(fps: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps ^ to).sum(axis=-1, dtype=np.int64)


def union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Join the groups of ``a[k]`` and ``b[k]``; ``label`` names each group by its smallest member. Whether anything changed."""
    changed = False
    while (apart := label[a] != label[b]).any():
        x, y = label[a[apart]], label[b[apart]]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label[:] = up
        changed = True
    return changed


class Forest:
    """BK-trees of many shards in flat arrays. Every fingerprint is a node; a child hangs on its parent by their Hamming distance.

    Rows are sorted by shard. A subtree's smallest row is its root, so a row looks for smaller ones only and meets each pair once.
    """

    def __init__(self, fps: np.ndarray, shard: np.ndarray) -> None:
        self.fps, self.stride = fps, 64 * fps.shape[1] + 1
        first = np.append(True, shard[1:] != shard[:-1])
        rows, group = np.arange(len(fps)), np.cumsum(first) - 1
        pivots = rows[first]
        self.root, self.levels = pivots[group], [pivots]
        keys, kids = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(pivots) < len(rows):
            rows, own = rows[~first], pivots[group[~first]]
            edge = own * self.stride + distances(fps[rows], fps[own])
            order = np.argsort(edge, kind="stable")
            rows, edge = rows[order], edge[order]
            first = np.append(True, edge[1:] != edge[:-1])
            group, pivots = np.cumsum(first) - 1, rows[first]
            keys.append(edge[first])
            kids.append(pivots)
            self.levels.append(pivots)
        edges, kid = np.concatenate(keys), np.concatenate(kids)
        order = np.argsort(edges)
        self.edges, self.kids = edges[order], kid[order]
        self.parent = np.full(len(fps), -1)
        self.parent[self.kids] = self.edges // self.stride

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """Whether a node's whole subtree is of one group."""
        low, high = label.copy(), label.copy()
        for rows in self.levels[:0:-1]:
            np.minimum.at(low, self.parent[rows], low[rows])
            np.maximum.at(high, self.parent[rows], high[rows])
        return low == high

    def links(self, radius: int, label: np.ndarray, merge: bool, accept: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, smaller row of its shard) within ``radius``: only edges within the radius of a row's distance to the node are followed.

        A row does not enter a subtree that is all of its own group. With ``merge`` each link joins groups at once, so
        links span the groups and a dense shard costs little more than its size; else all links between groups come.
        """
        todo = [(np.arange(len(self.fps)), self.root)]
        one = self.uniform(label)
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                todo += [(q[half:], node[half:]), (q[:half], node[:half])]
                continue
            d = distances(self.fps[q], self.fps[node])
            hit = np.flatnonzero((d <= radius) & (node < q))
            hit = hit[label[q[hit]] != label[node[hit]]]
            if accept is not None and len(hit):
                hit = hit[accept(q[hit], node[hit])]
            if len(hit):
                yield q[hit], node[hit]
                if merge and union(label, q[hit], node[hit]):
                    one = self.uniform(label)
            base = node * self.stride
            low = np.searchsorted(self.edges, base + np.maximum(d - radius, 0))
            n = np.searchsorted(self.edges, base + np.minimum(d + radius, self.stride - 1), "right") - low
            q = np.repeat(q, n)
            node = self.kids[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(q))]
            go = (node < q) & ~(one[node] & (label[node] == label[q]))
            if go.any():
                todo.append((q[go], node[go]))


def connect(fps: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """The smallest row linked with each row of its shard, over all links within ``radius``."""
    label = np.arange(len(fps))
    for _ in Forest(fps, shard).links(radius, label, True):
        pass
    return label


def shared(shard: np.ndarray) -> np.ndarray:
    """Which of the sorted rows have another in their shard."""
    same = shard[1:] == shard[:-1]
    return np.append(same, False) | np.append(False, same)


def cut_large(shard: np.ndarray, ident: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard): rows of a large shard go to one of its chunks, and there to a shard for each other chunk; all others stay.

    ``members`` has for each row how many its shard has, about, or 0 where it is not large. Two rows of a shard meet in
    one of the new shards at least.
    """
    chunks = np.where(members > 0, -(-2 * members // LARGE), 1)
    rows = np.repeat(np.arange(len(shard)), np.where(chunks > 1, chunks - 1, 1))
    n = chunks[rows]
    step = np.arange(len(rows)) - np.searchsorted(rows, rows)
    own = (ident[rows].view(np.uint64) * MIXERS[3] >> np.uint64(33)).astype(np.int64) % n
    other = step + (step >= own)
    low, high = np.minimum(own, other), np.maximum(own, other)
    with np.errstate(over="ignore"):
        mixed = (shard[rows].view(np.uint64) ^ (low * (1 << 20) + high + 1).astype(np.uint64) * MIXERS[5]) * MIXERS[4]
    return rows, np.where(n > 1, mixed.view(np.int64), shard[rows])


def block_masks(bits: int, radius: int, n: int = 0) -> list[np.ndarray]:
    """Bit positions of the keys by which fingerprints meet; two within the radius agree in one key at least.

    With m blocks, radius differing bits leave m - radius of them equal, so the keys are all sets of that many blocks.
    m is the least for which ``n`` fingerprints fill shards with some 4,096 each: 5 keys of 13 bits up to 30 million at
    radius 4 and 64 bits, 15 of 21 bits up to 10 billion, 35 of 27 bits up to 500 billion. Every choice is exact.
    """
    for m in range(radius + 1, min(radius + 4, 48 * bits // (bits + 1)) + 1):
        blocks = np.array_split(np.arange(bits), m)
        if (1 << (bits * (m - radius) // m)) * 4096 >= n:
            break
    return [np.concatenate(c) for c in combinations(blocks, m - radius)]


def _print_batches(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), width), bits).astype(">u8").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(prints, pa.binary())], ["doc_id", "key", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, bits: int = 64) -> DataFrame:
    """doc_id, key (of the row), fp (big-endian bytes) for every row; a null text counts as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    return picked.mapInArrow(_print_batches(width, bits), f"doc_id {kind}, key long, fp binary")


def _cut_batches(ident_of: Callable[[pa.RecordBatch], np.ndarray], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, shard = cut_large(b.column("shard").to_numpy(), ident_of(b), b.column("members").to_numpy())
            taken = b.select(columns).take(pa.array(rows))
            yield taken.set_column(columns.index("shard"), "shard", pa.array(shard))

    return run


def cut(rows: DataFrame, sample: DataFrame, ident_of: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """``rows`` (shard and more) with the shards of more than LARGE members cut, as ``sample``, the same for one in SAMPLE fingerprints, tells them.

    The sample decides how shards are cut, never what is found in them. Large shards are a table, of any number; Spark
    broadcasts it where it is small and joins it by shard where it is not.
    """
    large = stored(sample.groupBy("shard").agg((F.count("*") * SAMPLE).alias("members")).where(F.col("members") > LARGE), "sim-large")
    if large.isEmpty():
        return rows
    marked = rows.join(large, "shard", "left").withColumn("members", F.coalesce("members", F.lit(0).cast("long")))
    return marked.select(*rows.columns, "members").mapInArrow(_cut_batches(ident_of, rows.columns), rows.schema)


def _first_bytes(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in b.column("fp").to_pylist()), np.int64)


def _shard_batches(masks: list[np.ndarray], bits: int):
    masks = [np.asarray(m) for m in masks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp")
            if not len(fps):
                continue
            raw = np.frombuffer(b"".join(fps.to_pylist()), np.uint8).reshape(len(fps), bits // 8)
            flat = np.unpackbits(raw, axis=1)
            for k, mask in enumerate(masks):
                packed = np.zeros((len(fps), 8), np.uint8)
                cut = np.packbits(flat[:, mask], axis=1)
                packed[:, 8 - cut.shape[1] :] = cut
                yield pa.RecordBatch.from_arrays([pa.array(packed.view(">u8").ravel().astype(np.int64) | (k << 48)), fps], ["shard", "fp"])

    return run


def _edge_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "shard", 200_000):
            shard = t.column("shard").to_numpy()
            some = shared(shard)
            raw = t.column("fp").combine_chunks().filter(pa.array(some))
            if not len(raw):
                continue
            fps = np.frombuffer(b"".join(raw.to_pylist()), ">u8").astype(np.uint64).reshape(len(raw), -1)
            label = connect(fps, shard[some], radius)
            linked = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([raw.take(pa.array(linked)), raw.take(pa.array(label[linked]))], ["a", "b"])

    return run


def edges(nodes: DataFrame, masks: list[np.ndarray], bits: int, radius: int, n: int = 0) -> DataFrame:
    """a, b: spanning links of all shards of the distinct fingerprints ``nodes`` (column fp), some ``n`` in number."""
    shards = lambda df: df.select("fp").mapInArrow(_shard_batches(masks, bits), "shard long, fp binary")
    sharded = shards(nodes)
    if n > LARGE:
        sharded = cut(sharded, shards(nodes.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0)), _first_bytes)
    dealt = sharded.repartition("shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(_edge_batches(radius), "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its group), for all nodes of the links (a, b).

    Rounds of large-star and small-star: each node's links are moved to its smallest neighbour until nothing changes.
    Minima are summed up before the shuffle and put back by a join, so a hub's links are never held in one task.
    """
    e = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The minima are written first: a join of two plain tables can be split where a hub's links meet.
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "cc")
        drop(low)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "cc-least")
        moved = large.join(least, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        old, e = e, stored(small.where("a <> b").distinct(), "cc")
        drop(old, large, least)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def grouped(prints: DataFrame, masks: Callable[[int], list[np.ndarray]], bits: int, radius: int) -> DataFrame:
    """``prints`` with component_id: the smallest doc_id that its fingerprint reaches (null if no member has one). ``masks`` gives the keys for a number of fingerprints."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "sim-nodes")
    n = nodes.count()
    return joined(prints, nodes, edges(nodes, masks(n), bits, radius, n))


def joined(prints: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` with component_id, by links between its fingerprints ``nodes``."""
    found = components(links)
    named = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    least = stored(named.join(nodes, named["node"] == nodes["fp"]).groupBy("root").agg(F.min("least").alias("component_id")), "sim-least")
    member = stored(named.join(least, "root").select(F.col("node").alias("fp"), "component_id"), "sim-members")
    alone = nodes.join(member, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    return prints.join(member.unionByName(alone), "fp")


def _least_common(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set of Jaccard similarity 0.8 to it."""
    return (4 * n + 4) // 5


def _shingle_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(t.as_py(), width)).view(np.int64))], ["shingle"])

    return run


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles, sorted, and their counts, by a sixteenth of the documents. They only set an order, in which they come last; any order finds all pairs."""
    some = docs.where(F.pmod(row_key(docs["doc_id"], docs["text"]), F.lit(SAMPLE)) == 0).select("text")
    counted = some.mapInArrow(_shingle_batches(width), "shingle long").groupBy("shingle").count().where("count > 2")
    top = counted.orderBy(F.desc("count"), "shingle").limit(COMMON).toArrow()
    h, n = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def _rare_first(h: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, counts = common
    if not len(keys):
        return h
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return h[np.lexsort((h, np.where(keys[at] == h, counts[at], 0)))]


def _set_batches(width: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), width)) for t in b.column("text")]
            prints = [xxhash.xxh3_128_digest(h.tobytes()) for h in sets]
            heads = [_rare_first(h, common.value)[: len(h) - _least_common(len(h)) + 1].tobytes() for h in sets]
            sims = np.array([fingerprint(h, BITS) for h in sets], np.uint64).reshape(-1, BITS // 64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(prints, pa.binary()), pa.array([len(h) for h in sets], pa.int32()), pa.array(sims[:, 0]), pa.array(sims[:, 1]), pa.array(heads, pa.binary())], ["doc_id", "key", "fp", "size", "s0", "s1", "head"])

    return run


def _head_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle in a set's head: its shard, and the place of the shingle in the set's order."""
    for b in batches:
        for at in range(0, len(b), 500):
            part = b.slice(at, 500)
            heads = [np.frombuffer(h, np.int64) for h in part.column("head").to_pylist()]
            lengths = [len(h) for h in heads]
            which = np.repeat(np.arange(len(heads)), lengths)
            if not len(which):
                continue
            place = np.concatenate([np.arange(n, dtype=np.int64) for n in lengths])
            id_, size, s0, s1 = (part.column(c).to_numpy() for c in ("id", "size", "s0", "s1"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads)), *map(pa.array, (id_[which], size[which].astype(np.int64) << 32 | place, s0[which], s1[which]))], ["shard", "id", "at", "s0", "s1"])


def _may_reach(at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets that share the shingle at these places can have a similarity of 0.8; no true pair fails where its first common shingle is."""
    size, place = at >> 32, at & 0xFFFFFFFF
    most = np.minimum(size[a] - place[a], size[b] - place[b])
    return (5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b])) & (9 * most >= 4 * (size[a] + size[b]))


def _columns(t: pa.Table, some: np.ndarray) -> tuple[np.ndarray, ...]:
    picked = t.filter(pa.array(some))
    at = picked.column("at").to_numpy()
    fps = np.stack([picked.column("s0").to_numpy(), picked.column("s1").to_numpy()], axis=1).view(np.uint64)
    return picked.column("shard").to_numpy(), picked.column("id").to_numpy(), at, fps


def _once(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, the smaller id first, each once."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])) if len(low) else np.empty(0, bool)
    return low[new], high[new]


def sketch(h: np.ndarray) -> np.ndarray:
    """SKETCH bits, each the parity of a set's hashes in one bucket: two sets differ in as many members at least as their sketches do in bits."""
    return np.packbits((np.bincount((h >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64), minlength=SKETCH) & 1).astype(np.uint8))


def _sketch_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [sketch(np.unique(shingle_hashes(t.as_py(), width))).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(bits, pa.binary())], ["id", "sketch"])

    return run


def _reach(t: pa.Table, some: np.ndarray, at: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether rows can have a similarity of 0.8, by their places and, where ``t`` has them, their sketches: at 0.8 sets differ in a ninth of both sizes at most."""
    if "sketch" not in t.column_names:
        return lambda a, b: _may_reach(at, a, b)
    bits = np.frombuffer(b"".join(t.column("sketch").filter(pa.array(some)).to_pylist()), np.uint64).reshape(-1, SKETCH // 64)

    def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = _may_reach(at, a, b)
        left = np.flatnonzero(out)
        for k in range(0, len(left), 1 << 16):
            part = left[k : k + (1 << 16)]
            x, y = a[part], b[part]
            out[part] = 9 * distances(bits[x], bits[y]) <= (at[x] >> 32) + (at[y] >> 32)
        return out

    return reach


def _groups(t: pa.Table, some: np.ndarray) -> np.ndarray:
    """A label for each row: the first row with its root, or the row itself where ``t`` has no roots."""
    if "root" not in t.column_names:
        return np.arange(int(some.sum()))
    _, first, back = np.unique(t.column("root").to_numpy()[some], return_index=True, return_inverse=True)
    return first[back]


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that span what the trees link between groups, and the rows of shards (a, b null) that have any link there."""
    for t in whole_groups(batches, "shard", 200_000):
        some = shared(t.column("shard").to_numpy())
        shard, id_, at, fps = _columns(t, some)
        if not len(id_):
            continue
        start = _groups(t, some)
        label = start.copy()
        found = list(Forest(fps, shard).links(RADIUS, label, True, _reach(t, some, at)))
        if not found:
            continue
        a, b = _once(id_[np.concatenate([x for x, _ in found])], id_[np.concatenate([y for _, y in found])])
        grown = np.zeros(len(label), bool)
        grown[label[label != start]] = True
        rows = t.filter(pa.array(some)).filter(pa.array(grown[label]))
        rows = rows.drop_columns(["root"]) if "root" in t.column_names else rows
        none = pa.nulls(len(rows), pa.int64())
        rows = rows.append_column("a", none).append_column("b", none)
        yield from rows.to_batches()
        blank = {f.name: pa.nulls(len(a), f.type) for f in rows.schema} | {"a": pa.array(a), "b": pa.array(b)}
        yield pa.RecordBatch.from_arrays(list(blank.values()), list(blank))


def _between_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs that the trees link between different groups (root)."""
    for t in whole_groups(batches, "shard", 200_000):
        some = shared(t.column("shard").to_numpy())
        shard, id_, at, fps = _columns(t, some)
        if not len(id_):
            continue
        for x, y in Forest(fps, shard).links(RADIUS, _groups(t, some), False, _reach(t, some, at)):
            a, b = _once(id_[x], id_[y])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _verify_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def shingles(id_: int, text) -> np.ndarray:
            if id_ not in held:
                if len(held) > 200:
                    held.clear()
                held[id_] = np.unique(shingle_hashes(text.as_py(), width))
            return held[id_]

        for rows in batches:
            keep = []
            for a, b, x, y in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist(), rows.column("x"), rows.column("y"), strict=True):
                x, y = shingles(a, x), shingles(b, y)
                keep.append(9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of 0.8 or more, by the texts themselves."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(_verify_batches(width), "a long, b long"), "sim-links")


def _ids(b: pa.RecordBatch) -> np.ndarray:
    return b.column("id").to_numpy()


def similar(nodes: DataFrame, sample: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """a, b: links that connect all sets of Jaccard similarity 0.8 or more (up to the radius), and none below it. ``nodes`` has id, size, s0, s1, head,
    and so has ``sample``, one in SAMPLE of them.

    Of two such sets, ordered alike, the first fifth (and one) of each share a shingle, so shards by these shingles
    lose no pair. Each shard has a tree of the members' fingerprints. What spans its links is verified and grouped. The trees
    then link members of different groups whose sketches may differ so little: first what spans those links is verified and
    grouped, then all of them that still lie between groups are. So neither a large group of near copies nor many texts that
    are alike below 0.8 are compared pair by pair.
    """
    columns = "shard long, id long, at long, s0 long, s1 long"
    in_shards = lambda df: df.repartition("shard").sortWithinPartitions("shard", "id")
    named = lambda df, group: df.join(group, "id", "left").withColumn("root", F.coalesce("root", "id"))
    grouping = lambda links, tag: stored(components(links).select(F.col("node").alias("id"), "root"), tag)
    heads = lambda df: df.mapInArrow(_head_batches, columns)
    met = stored(in_shards(cut(heads(nodes), heads(sample), _ids)).mapInArrow(_candidate_batches, f"{columns}, a long, b long"), "sim-shards")
    pairs = stored(met.where("a IS NOT NULL").select("a", "b").distinct(), "sim-pairs")
    ids = stored(met.where("id IS NOT NULL").select("id").distinct(), "sim-ids")
    texts = stored(docs.select(row_key(docs["doc_id"], docs["text"]).alias("id"), "text").join(ids, "id").dropDuplicates(["id"]), "sim-texts")
    near = verified(pairs, texts, width)
    known = stored(named(texts.mapInArrow(_sketch_batches(width), "id long, sketch binary"), grouping(near, "sim-roots")), "sim-sketches")
    rooted = met.where("id IS NOT NULL").drop("a", "b").join(known, "id").select("shard", "id", "at", "s0", "s1", "sketch", "root")
    still = stored(in_shards(rooted).mapInArrow(_candidate_batches, f"{columns}, sketch binary, a long, b long"), "sim-still")
    more = stored(still.where("a IS NOT NULL").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "sim-more")
    near = near.unionByName(verified(more, texts, width))
    rooted = named(still.where("id IS NOT NULL").drop("a", "b"), grouping(near, "sim-groups"))
    between = in_shards(rooted).mapInArrow(_between_batches, "a long, b long").distinct()
    between = stored(between.join(pairs.unionByName(more), ["a", "b"], "left_anti"), "sim-between")
    return near.unionByName(verified(between, texts, width))


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 64, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id for every row of ``docs``; links are exact for the radius.

    Empty and null texts have fingerprint zero and link like any other. Repeated rows are rows of the same group; null
    doc_ids never name a group unless it has no other; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, width, bits), "sim-prints")
    return grouped(prints, lambda n: block_masks(bits, radius, n), bits, radius).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


#: The pipeline's fingerprints. At a similarity of 0.8 they differ in 19 of 128 bits, give or take 4, and at most in 24 where sets
#: are tiny; the radius is more than four such deviations further on, and loses fewer than one such pair in 100,000.
BITS, RADIUS = 128, 44


def keep_one(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest doc_id stays, whole and unchanged.

    Groups are connected by pairs of Jaccard similarity 0.8 or more of their shingle sets, and no others: pairs are found by
    the BK-trees of the fingerprints and then compared exactly. Groups without any doc_id are kept once each. Columns are
    those of ``docs``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    known = common_shingles(docs, width)
    common = docs.sparkSession.sparkContext.broadcast(known)
    prints = stored(picked.mapInArrow(_set_batches(width, common), f"doc_id {kind}, key long, fp binary, size int, s0 long, s1 long, head binary"), "sim-prints")
    sets = lambda df: df.groupBy("fp").agg(F.min("key").alias("id"), *[F.first(c).alias(c) for c in ("size", "s0", "s1", "head")]).drop("fp")
    links = similar(sets(prints), sets(prints.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0)), docs, width)
    prints = prints.select("doc_id", "key", "fp")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("key").alias("id")), "sim-nodes")
    # joined() names nodes by what links name: here the row key of one row of each set.
    member = joined(prints.join(nodes.select("fp", "id"), "fp").select("doc_id", "key", F.col("id").alias("fp")), nodes.select(F.col("id").alias("fp"), "least"), links)
    # One key per group: its smallest doc_id; among rows that share it, the smallest key.
    unit = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("x"), F.hex("fp")))
    k = free_prefix(docs, "_n_") + "key"
    best = member.groupBy(unit.alias("unit")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("best"))
    chosen = stored(best.select(F.col("best.key").alias(k)).distinct(), "sim-chosen")
    repeated = stored(prints.groupBy("key").count().where("count > 1").select(F.col("key").alias(k)), "sim-repeated")
    own = row_key(docs["doc_id"], docs["text"])
    if repeated.isEmpty():
        return docs.join(chosen, own == chosen[k], "left_semi")
    # Rows equal in doc_id and text share a key: where that key is chosen, one of them stays.
    once, again = chosen.join(repeated, k, "left_anti"), chosen.join(repeated, k)
    single = docs.join(once, own == once[k], "left_semi")
    first = docs.join(again, own == again[k]).dropDuplicates([k]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return single.unionByName(first)
