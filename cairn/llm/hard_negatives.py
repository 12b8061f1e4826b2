"""Hard-negative mining (13): rows that score close to an anchor's positives but bear another label, found with a pivot table.

A vector gets one more component, so that all rows have one length M and an anchor's inner product falls as its
Euclidean distance grows. The distances of each row to a few pivots are stored. By the triangle inequality the stored
distances of a row, and those of an anchor to the same pivots, bracket the row's score; whole runs of rows first, by the
range of their distances, then single rows. What a bracket cannot rule out is scored exactly.
The table is stored sorted by label, nearest pivot and distance to it, so that runs are tight. Anchors are a stated share
of the rows; they are taken in blocks of bounded size, each broadcast for a pass over the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, stored

SCALE, ANCHORS, NOISE, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Pivots are chosen, far from each other, among so many rows of smallest hash.
PIVOTS, PIVOT_SAMPLE = 12, 1024
#: Bytes of anchors that are broadcast at once, and rows that share one bracket.
BLOCK_BYTES, RUN = 64 << 20, 512
EXACT = 1 << 53
_LAST = (1 << 63) - 1


def valid(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part, with the label noise of the contract; a component that leaves the doubles when scaled counts as not finite."""
    x = F.transform("embedding", lambda v: v.cast("double") * SCALE)
    finite = F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    noisy = F.when(F.col("vec_id") % NOISE == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.where("label IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), noisy.cast("long").alias("label"), x.alias("vector")).where(finite)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Whole numbers as doubles, a row a vector; shorter vectors end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def lifted(x: np.ndarray, m2: float) -> np.ndarray:
    """Rows of one length: the last component makes up for what a row lacks to M."""
    return np.concatenate([x, np.sqrt(np.maximum(m2 - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(d2, 0))


def choose_pivots(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Each next pivot is the row farthest from those so far."""
    found = sample[:1]
    while len(sample) and len(found) < most:
        far = distances(sample, found).min(axis=1)
        if far.max() <= 0:
            break
        found = np.concatenate([found, sample[[far.argmax()]]])
    return found


class Frame:
    """What all tasks share: the width of vectors, the square of M, the pivots. ``slack`` covers the rounding of brackets."""

    def __init__(self, width: int, m2: float, pivots: np.ndarray) -> None:
        self.width, self.m2, self.pivots = width, m2, pivots
        self.exact = m2 < EXACT  # no partial sum of an inner product leaves what doubles hold exactly
        self.slack = 1e-6 * max(m2, 1.0)

    def scores(self, x: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Inner products, exact; where doubles might round, by Python's numbers. Those beyond 64 bits are the end of the range."""
        if self.exact:
            return (x @ a).astype(np.int64)
        whole = [int(v) for v in a]
        exact = (sum(int(v) * w for v, w in zip(row, whole, strict=True)) for row in x)
        return np.array([max(-_LAST, min(_LAST, v)) for v in exact], np.int64)

    def brackets(self, a2: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of rows whose distance to the anchor lies between ``low`` and ``high``."""
        return (a2 + self.m2 - high * high) / 2 - self.slack, (a2 + self.m2 - low * low) / 2 + self.slack


def _table_batches(frame):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = frame.value
        for b in batches:
            x = matrix(b.column("vector"), f.width)
            d = distances(lifted(x, f.m2), f.pivots)
            near = d.argmin(axis=1) if d.shape[1] else np.zeros(len(x), np.int64)
            home = d[np.arange(len(x)), near] if d.shape[1] else np.zeros(len(x))
            columns = [b.column("vec_id"), b.column("label"), *[pa.FixedSizeListArray.from_arrays(pa.array(v.reshape(-1)), v.shape[1]).cast(pa.list_(pa.float64())) if v.shape[1] else pa.array([[]] * len(x), pa.list_(pa.float64())) for v in (x, d)], pa.array(near, pa.int64()), pa.array(home, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "pivots", "near", "home"])

    return run


def pivot_table(rows: DataFrame) -> tuple[DataFrame, Frame]:
    """row, vec_id, label, vector, pivots (distances) of all rows that take part, sorted, in the shared folder."""
    spark = rows.sparkSession
    own = valid(rows)
    bound = own.agg(F.max(F.size("vector")).alias("width"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, v: s + (F.abs(v) + 1) * (F.abs(v) + 1))).alias("m2")).first()
    width, m2 = bound.width or 0, bound.m2 or 0.0
    sample = own.orderBy(F.xxhash64("vec_id", "label", "vector"), "vec_id").limit(PIVOT_SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    frame = Frame(width, m2, choose_pivots(lifted(matrix(sample, width), m2)))
    schema = "vec_id bigint, label bigint, vector array<double>, pivots array<double>, near bigint, home double"
    plain = stored(own.mapInArrow(_table_batches(spark.sparkContext.broadcast(frame)), schema), "pivot-rows")
    ordered = plain.repartitionByRange("label", "near", "home", "vec_id").sortWithinPartitions("label", "near", "home", "vec_id")
    return stored(ordered.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", "pivots"), "pivot-table"), frame


def _runs(b: pa.RecordBatch, f: Frame) -> Iterator[tuple]:
    """Runs of a batch: row numbers, ids (null: last), labels, vectors, pivot distances."""
    for at in range(0, len(b), RUN):
        part = b.slice(at, RUN)
        ids = pc.fill_null(part.column("vec_id"), _LAST).to_numpy()
        yield part.column("row").to_numpy(), ids, part.column("label").to_numpy(), matrix(part.column("vector"), f.width), matrix_of(part.column("pivots"), len(f.pivots))


def matrix_of(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _ahead(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most``: higher scores first, ties by smaller id."""
    if len(score) > most:
        kth = np.partition(score, -most)[-most]
        places = np.flatnonzero(score >= kth)
    else:
        places = np.arange(len(score))
    return places[np.lexsort((ids[places], -score[places]))[:most]]


class _Best:
    """The first rows of one list, as far as a task has come."""

    __slots__ = ("ids", "most", "score")

    def __init__(self, most: int) -> None:
        self.most, self.score, self.ids = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.most else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score):
            score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
            keep = _ahead(score, ids, self.most)
            self.score, self.ids = score[keep], ids[keep]


def _reach(frame: Frame, a: dict, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the least and greatest score that a run's pivot distances allow."""
    if not d.shape[1]:
        return np.full(len(a["sq"]), -np.inf), np.full(len(a["sq"]), np.inf)
    low, high = d.min(axis=0), d.max(axis=0)
    nearest = np.maximum(np.maximum(low - a["d"], a["d"] - high), 0).max(axis=1)
    return frame.brackets(a["sq"], nearest, (a["d"] + high).min(axis=1))


def _row_reach(frame: Frame, a: dict, k: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not d.shape[1]:
        return np.full(len(d), -np.inf), np.full(len(d), np.inf)
    return frame.brackets(a["sq"][k], np.abs(d - a["d"][k]).max(axis=1), (d + a["d"][k]).min(axis=1))


def _emit(lists: Iterator[tuple[int, int, _Best]]) -> Iterator[pa.RecordBatch]:
    """(anchor's row, band, list) as rows."""
    out: list[tuple] = []
    for anchor, band, best in lists:
        out += [(anchor, band, None if i == _LAST else int(i), int(s)) for i, s in zip(best.ids, best.score, strict=True)]
        if len(out) > 50_000:
            yield _found(out)
            out = []
    yield _found(out)


def _found(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "band", "vec_id", "score"])


FOUND = "anchor bigint, band bigint, vec_id bigint, score bigint"


def _positive_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, a = shared.value
        best: dict[int, _Best] = {}
        for b in batches:
            for rows, ids, labels, x, d in _runs(b, f):
                _, top = _reach(f, a, d)
                for k in np.flatnonzero(np.isin(a["label"], labels)):
                    own = best.setdefault(k, _Best(POSITIVES))
                    if top[k] < own.least():
                        continue
                    left = np.flatnonzero((labels == a["label"][k]) & (rows != a["row"][k]) & (_row_reach(f, a, k, d)[1] >= own.least()))
                    own.add(f.scores(x[left], a["x"][k]), ids[left])
        yield from _emit((int(a["row"][k]), 0, own) for k, own in best.items())

    return run


def _negative_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, a = shared.value
        bands = [(k, int(p), _Best(NEGATIVES)) for k, ps in enumerate(a["bands"]) for p in ps if p >= 0]  # below zero no score is in the band
        least, most = np.array([p * LOW / 100 for _, p, _ in bands]), np.array([p * HIGH / 100 for _, p, _ in bands])
        of = np.array([k for k, _, _ in bands], np.int64)
        floor = least.copy()
        for b in batches if bands else ():
            for _, ids, labels, x, d in _runs(b, f):
                bottom, top = _reach(f, a, d)
                open_bands = np.flatnonzero((top[of] >= floor) & (bottom[of] <= most))
                for k in np.unique(of[open_bands]):
                    mine = open_bands[of[open_bands] == k]
                    low, high = _row_reach(f, a, k, d)
                    left = np.flatnonzero((labels != a["label"][k]) & (high >= floor[mine].min()) & (low <= most[mine].max()))
                    if not len(left):
                        continue
                    score = f.scores(x[left], a["x"][k])
                    for j in mine:
                        _, p, own = bands[j]
                        inside = np.flatnonzero((score >= -(-LOW * p // 100)) & (score <= HIGH * p // 100))
                        own.add(score[inside], ids[left][inside])
                        floor[j] = max(least[j], own.least())
        yield from _emit((int(a["row"][k]), p, own) for k, p, own in bands)

    return run


def _anchors(rows: list, f: Frame, bands: dict[int, list[int]] | None = None) -> dict:
    x = np.array([r.vector for r in rows], np.float64).reshape(len(rows), f.width)
    query = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
    return {"row": np.array([r.row for r in rows]), "label": np.array([r.label for r in rows]), "x": x, "sq": (x * x).sum(axis=1), "d": distances(query, f.pivots), "bands": [bands.get(r.row, []) if bands else [] for r in rows]}


def mine(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for all anchors of ``rows``.

    Rows with a null label or vector, or a component that is null or not finite, take no part; vectors of several
    lengths are filled up with zeros. A null vec_id is no anchor, and comes last among ties. Rows that share a vec_id are
    rows of their own, also as anchors. Equal scores rank by vec_id. Scores are exact; one beyond 64 bits counts as the end
    of the range. An anchor without positives, or a positive without negatives, gives no row; an empty table an
    empty result. A label that a third of all rows bear, or a vector that thousands share, is cut into runs like any other.
    """
    spark = rows.sparkSession
    table, frame = pivot_table(rows)
    anchors = stored(table.where(F.col("vec_id") % ANCHORS == 0), "pivot-anchors")
    blocks = 1 + anchors.count() * 8 * (frame.width + len(frame.pivots) + 20) // BLOCK_BYTES
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    first = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    out = None
    for k in range(blocks):
        chosen = anchors.where(block == k).select("row", "label", "vector").collect()
        sent = spark.sparkContext.broadcast((frame, _anchors(chosen, frame)))
        near = table.mapInArrow(_positive_batches(sent), FOUND).withColumn("place", F.row_number().over(first)).where(F.col("place") <= POSITIVES)
        positives = stored(near.select("anchor", "vec_id", "score", "place"), "pivot-positives")
        bands: dict[int, list[int]] = {}
        for r in positives.select("anchor", "score").distinct().toLocalIterator():  # POSITIVES a row of the block at most
            bands.setdefault(r.anchor, []).append(r.score)
        with_bands = spark.sparkContext.broadcast((frame, _anchors(chosen, frame, bands)))
        negatives = table.mapInArrow(_negative_batches(with_bands), FOUND).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
        found = positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("band"), "place").join(negatives.select("anchor", "band", F.col("vec_id").alias("negative_id"), "rank", F.col("score").alias("negative_score")), ["anchor", "band"])
        found = stored(found, "pivot-found")
        drop(positives)
        out = found if out is None else out.unionByName(found)
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return out.join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", F.col("band").alias("positive_score"), "negative_score")


ORACLE = f"""
WITH e AS (SELECT row_number() OVER () AS i, vec_id, (CASE WHEN vec_id % {NOISE} = 0 THEN (label + 1) % {LABELS} ELSE label END)::BIGINT AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i AS ai, a.vec_id AS anchor_id, a.label = b.label AS same, b.i AS bi, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % {ANCHORS} = 0 AND a.i <> b.i),
p AS (SELECT *, row_number() OVER (PARTITION BY ai ORDER BY score DESC, vec_id) AS k FROM s WHERE same QUALIFY k <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.ai, p.bi ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.ai = p.ai AND NOT s.same AND 100 * s.score BETWEEN {LOW} * p.score AND {HIGH} * p.score QUALIFY rank <= {NEGATIVES})
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n
"""
