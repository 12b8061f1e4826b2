"""Language ID (4): multinomial naive Bayes over hashed character n-grams.

Counts are gathered over all training texts (summed in each task first); the log-probability matrix has languages x
``DIMS`` cells, whatever the corpus, and is broadcast. Batches are scored sparsely with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored

DIMS_LOG2 = 15
DIMS = 1 << DIMS_LOG2
ORDERS = (1, 2, 3)
ALPHA = 0.1
#: Languages that are learned, 200 kB each where broadcast, and that a task counts at once.
MOST_LANGS, TASK_LANGS = 512, 64
MODULUS, HELD_OUT = 3, 1
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
BATCH_CHARS = 1 << 20
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def features(text: str) -> np.ndarray:
    """Hashed n-grams of the lower-cased code points, one number below DIMS for each place and order."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in ORDERS:
        if len(points) < n:
            break
        h = np.full(len(points) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * _MULTIPLIERS[k]
            h ^= h >> np.uint32(15)
        out.append(h >> np.uint32(32 - DIMS_LOG2))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, n) of the task's texts; feature -1 counts documents."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, row in counts.items():
            at = np.flatnonzero(row)
            cols = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(row[at], docs[lang]), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "feature", "n"])
        counts.clear()
        docs.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if lang not in counts:
                if len(counts) >= TASK_LANGS:
                    yield from rows()
                counts[lang], docs[lang] = np.zeros(DIMS, np.int64), 0
            docs[lang] += 1
            counts[lang] += np.bincount(features(text.as_py() or ""), minlength=DIMS)
    yield from rows()


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log priors, and the (DIMS, languages) log probabilities, from all documents that are not held out and have a lang.

    The MOST_LANGS values of most documents are learned, ties by name; this bounds the matrix where lang is dirty.
    """
    rows = docs.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id"), MODULUS) != HELD_OUT)).select("lang", "text")
    sums = stored(rows.mapInArrow(_count_batches, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")), "lang-counts")
    langs = sorted(r.lang for r in sums.where("feature = -1").orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect())
    place = {lang: k for k, lang in enumerate(langs)}
    table = np.full((DIMS, len(langs)), ALPHA)
    prior = np.ones(len(langs))
    # At most languages x (DIMS + 1) rows.
    for batch in sums.where(F.col("lang").isin(langs)).toArrow().to_batches():
        lang, feature, n = (batch.column(k) for k in range(3))
        col = np.array([place[x] for x in lang.to_pylist()], np.int64)
        f, n = feature.to_numpy(), n.to_numpy()
        real = f >= 0
        table[f[real], col[real]] += n[real]
        prior[col[~real]] += n[~real]
    return langs, np.log(prior / prior.sum()) if langs else prior, (np.log(table / table.sum(axis=0)) if langs else table).astype(np.float32)


def _score_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, table = model.value
        for b in batches:
            best, scores = [], []
            for text in b.column("text"):
                text = text.as_py()
                if not langs or text is None or not LETTER.search(text):
                    best.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = prior.copy()
                f = features(text)
                for at in range(0, len(f), BATCH_CHARS):
                    total += table[f[at : at + BATCH_CHARS]].sum(axis=0, dtype=np.float64)
                k = int(total.argmax())
                best.append(langs[k])
                scores.append(float(1.0 / np.exp(total - total[k]).sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(best, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of lang_pred) for every row of ``docs``.

    Only doc_id's checksum decides who is held out; lang, source and doc_id are never inputs of a prediction. Of more than
    MOST_LANGS values of lang the rarest are not learned. Null texts, texts without a letter, and all texts where nothing was learned get ``und`` and 0. A null doc_id is not held
    out. Ties go to the language first in order; repeated rows get equal predictions.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(_score_batches(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
