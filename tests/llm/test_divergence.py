"""Source divergence audit: against its oracle, a plain loop, and odd rows."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cairn.llm import divergence

DDL = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_loop(rows):
    """The contract, term by term, in Python's whole numbers."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        text, lang, source = (text or "").translate(LOWER), lang or "", source or ""
        found = TERM.findall(text)
        groups.add((lang, source))
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= 10]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        others = sorted({s for x, s in groups if x == lang and s != source})
        p, q = shares(count[lang, source]), shares(sum((count[g] for g in groups if g[0] == lang), Counter()))
        pairs = [(s, sum(f(p[t], r[t]) for t in kept)) for s in others for r in [shares(count[lang, s])]]
        terms = [(t, f(p[t], q[t])) for t in kept if count[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def run(df):
    return sorted(map(tuple, divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "cat", "été", "ÉTÉ", "naïve", "x", "日本", "zebra", "zebras", "ab", "abc", "abcdefgh", "abcdefghi", "don't", "a1b"] + [f"w{'ab'[k % 2] * (k % 7)}" for k in range(30)]
    rows = []
    for k in range(n):
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choices(vocabulary, k=rng.randint(0, 40)))
        rows.append((k, rng.choice([text, text, text, None if k % 50 == 0 else text]), rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", None, "é", "z\0"])))
    return [*rows, (n, None, "only", "nothing"), (n + 1, "", "only", "other"), (None, "the cat", "en", "late"), (5, rows[5][1], rows[5][2], rows[5][3])]


@pytest.mark.parametrize("leaves", [50, 10**6])
def test_against_a_loop(spark, monkeypatch, leaves):
    monkeypatch.setattr(divergence, "LEAVES", leaves)
    rows = corpus()
    assert run(spark.createDataFrame(rows, DDL).repartition(5)) == by_loop(rows)


def test_languages_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GROUPS", 3)
    monkeypatch.setattr(divergence, "CELLS", 40)
    rows = corpus(seed=4)
    assert run(spark.createDataFrame(rows, DDL)) == by_loop(rows)


def test_oracle(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.sql(f"SELECT lang, source, part, item, value, rank FROM ({divergence.ORACLE})").fetchall()
    assert run(spark.read.parquet(path)) == sorted(want)


def test_odd_rows(spark, odd, clashing, empty):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
    assert run(odd) == run(clashing) == by_loop(rows)
    assert run(empty) == []
    repeated = [(k, "one very common line of words", "en", s) for k in range(40) for s in ("a", "b")]
    assert run(spark.createDataFrame(repeated, DDL)) == by_loop(repeated)


def test_terms():
    texts = ["A b-c", "", "été2É x\tY", "\x00Ab\x7fc[d]", "日本 語"]
    found, of = divergence.terms(pa.array(["skipped", *texts], pa.string()).slice(1))
    assert [(int(k), t.decode()) for k, t in zip(of, found.to_pylist(), strict=True)] == [(k, t) for k, x in enumerate(texts) for t in TERM.findall(x.translate(LOWER))]


def test_trie_order():
    rng = random.Random(1)
    keys = list({bytes(rng.choices(b"abc\x00\xff", k=rng.randint(0, 20))) for _ in range(2000)})
    trie = divergence.Trie()
    for k, key in enumerate(keys):
        trie.put(key, k)
    assert [keys[k] for k in trie.leaves()] == sorted(keys)


def test_shares_of_large_counts():
    counts, total = np.array([0, 7, 10**15, 9 * 10**14]), 2 * 10**15 + 12345
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]
