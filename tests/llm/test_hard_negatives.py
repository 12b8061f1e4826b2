"""Hard-negative mining: against its oracle, exhaustive search, and odd rows."""

import math
import random

import duckdb
import numpy as np
import pytest

from cairn.llm import hard_negatives as hn

DDL = "vec_id long, embedding array<float>, label int"
TOP = 2**63 - 1


def by_loop(rows):
    whole = []
    for k, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(v is None or not math.isfinite(v * 256) for v in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        whole.append((k, vec_id, label, [math.floor(256 * float(np.float32(v))) for v in vector]))
    last = lambda i: (i is None, i or 0)
    out = []
    for k, anchor, label, x in whole:
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((max(-TOP, min(TOP, sum(a * b for a, b in zip(x, y, strict=False)))), i, other) for j, i, other, y in whole if j != k), key=lambda s: (-s[0], last(s[1])))
        for ps, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(anchor, positive, r + 1, negative, ps, ns) for r, (ns, negative, _) in enumerate(fit)]
    return sorted(out, key=str)


def run(df):
    columns = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    return sorted(map(tuple, hn.mine(df).select(*columns).collect()), key=str)


def vectors(n=600, width=6, seed=1):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0, 1) for _ in range(width)], rng.randint(0, 9)) for k in range(n)]
    rows += [(100, rows[3][1], 4), (200, rows[200][1], rows[200][2]), (None, rows[0][1], rows[0][2]), (None, [1.0] * width, 2), (9000, None, 1), (9100, rows[1][1], None), (9200, [float("nan")] * width, 1), (9300, [1.0, None, 2.0, 0.0, 0.0, 1.0], 1), (9400, [float("inf")] * width, 1), (-100, rows[7][1], 3), (9500, [], 3), (9600, [2.0, 1.0], 3)]
    return rows + [(10_000 + k, [0.5, 0.5, 0.25, 0.0, 0.0, 0.1], 5) for k in range(300)] + [(20_000 + k, [0.5, 0.4, 0.25, 0.0, 0.0, 0.1], 6) for k in range(40)]


@pytest.mark.parametrize("run_rows", [7, 512])
def test_against_exhaustive_search(spark, monkeypatch, run_rows):
    monkeypatch.setattr(hn, "RUN", run_rows)
    rows = vectors()
    assert run(spark.createDataFrame(rows, DDL).repartition(4)) == by_loop(rows)


def test_anchors_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_BYTES", 800)
    rows = vectors(seed=2)
    assert run(spark.createDataFrame(rows, DDL)) == by_loop(rows)


def test_numbers_beyond_doubles(spark):
    """Where doubles would round, scores are reckoned in Python's numbers; those beyond 64 bits count as the end of the range."""
    rng = random.Random(5)
    rows = [(k * 10, [rng.choice([1e6, 3e5, 7.0, 1e5]) * rng.random() for _ in range(4)], rng.randint(0, 2)) for k in range(60)]
    assert run(spark.createDataFrame(rows, DDL)) == by_loop(rows)
    far = [(k * 50, [1e30 * (k + 1), 1.0], k % 2) for k in range(6)]
    assert run(spark.createDataFrame(far, DDL)) == by_loop(far)


def test_oracle(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({hn.ORACLE})").fetchall()
    assert run(spark.read.parquet(path)) == sorted(want, key=str)


def test_odd_tables(spark):
    from pyspark.sql import functions as F

    assert run(spark.createDataFrame([], DDL)) == []
    assert run(spark.createDataFrame([(0, None, 1), (100, [1.0], None)], DDL)) == []
    assert run(spark.createDataFrame([(0, [1.0], 1)], DDL)) == []
    assert run(spark.createDataFrame([(k, [], k % 2) for k in range(0, 300, 50)], DDL)) == by_loop([(k, [], k % 2) for k in range(0, 300, 50)])
    rows = vectors(250)
    df = spark.createDataFrame(rows, DDL)
    more = df.select("*", *[F.lit("own").alias(c) for c in "vector row near home pivots anchor band rank score vec place".split()])
    assert run(more) == by_loop(rows)


def test_brackets_hold():
    rng = np.random.default_rng(2)
    x, a = np.floor(rng.normal(0, 60, (400, 8))), np.floor(rng.normal(0, 60, (9, 8)))
    m2 = float(max((x * x).sum(axis=1).max(), (a * a).sum(axis=1).max()))
    lifted = hn.lifted(x, m2)
    frame = hn.Frame(8, m2, hn.choose_pivots(lifted[:100]))
    d = hn.distances(lifted, frame.pivots)
    anchors = {"sq": (a * a).sum(axis=1), "d": hn.distances(np.concatenate([a, np.zeros((9, 1))], axis=1), frame.pivots)}
    low, high = hn._reach(frame, anchors, d)
    for k in range(9):
        score = x @ a[k]
        row_low, row_high = hn._row_reach(frame, anchors, k, d)
        assert (row_low <= score).all() and (score <= row_high).all() and low[k] <= score.min() and score.max() <= high[k]
        assert row_high.max() <= high[k] + 1 and row_low.min() >= low[k] - 1
