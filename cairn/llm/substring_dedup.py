"""Substring dedup (1): units of text are normalised and hashed, digests are grouped globally, and the earliest occurrence stays.

Units are whole lines (paragraphs or sentences, if asked for) and passages. A line that an earlier document has, or an
earlier place of its own document, goes, whatever its length. Since repeated text may begin and end inside lines,
passages of ``PASSAGE`` words are hashed too. Where they begin is chosen by the words alone: of any WINDOW places in a
row the one of least hash, so that what two texts share begins passages at the same words in both, and a shared text of
PASSAGE + WINDOW - 1 words is always found. A passage goes if an earlier text has all its words in that order; what is
removed is the union of such passages, so nothing is pieced together from what several texts say apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_prefix, row_key, stored

PASSAGE, WINDOW = 30, 10
UNITS = {
    "sentence": re.compile(r"\S[^\n]*?(?:[.!?](?=\s)|(?=\n)|\Z)"),
    "line": re.compile(r"\S[^\n]*"),
    "paragraph": re.compile(r"\S(?:[^\n]|\n(?!\s*\n))*"),
}
_WORD = re.compile(r"\S+")
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd, so that powers do not vanish
_hashed: dict[str, int] = {}


def _digest(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63)


def units(text: str | None, kind: str = "line") -> list[tuple[int, int, int]]:
    """(start, end, digest) of each line, paragraph or sentence; offsets count code points. Case and spacing do not change a digest."""
    found = ((m.start(), m.end(), m.group().lower().split()) for m in UNITS[kind].finditer(text or ""))
    return [(a, a + len(text[a:b].rstrip()), _digest(ws)) for a, b, ws in found]


def passages(words: list[str], n: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words at which passages of ``n`` words begin, and the passages' digests: polynomials in the hashes of their words."""
    places = len(words) - n + 1
    if places < 1 or not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(_hashed) > 500_000:
        _hashed.clear()
    for w in set(words).difference(_hashed):
        _hashed[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    h = np.array([_hashed[w] for w in words], np.uint64)
    order = (h[:places] * _BASE + h[1 : places + 1] if n > 1 else h[:places]) * _MIX >> np.uint64(16)
    width = min(WINDOW, places)
    begins = np.unique(np.lib.stride_tricks.sliding_window_view(order, width).argmin(axis=1) + np.arange(places - width + 1))
    digests = np.zeros(len(begins), np.uint64)
    for k in range(n):
        digests = digests * _BASE + h[begins + k]
    return begins, (digests ^ digests >> np.uint64(29)).view(np.int64)


def removals(text: str, repeated: set[int], kind: str = "line", n: int = PASSAGE) -> list[tuple[int, int]]:
    """Spans to remove: units and passages that an earlier document has, or that stand in this one before, put together where they meet."""
    first: dict[int, int] = {}
    gone = [(a, b) for a, b, d in units(text, kind) if d in repeated or first.setdefault(d, b) <= a]
    begins, digests = passages(text.lower().split(), n)
    first = {}
    if found := [k for k, d in zip(begins.tolist(), digests.tolist(), strict=True) if d in repeated or first.setdefault(d, k + n) <= k]:
        words = [m.span() for m in _WORD.finditer(text)]
        gone += [(words[k][0], words[k + n - 1][1]) for k in found]
    spans: list[tuple[int, int]] = []
    for start, end in sorted(gone):
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    return spans


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; blanks after a span go with it, a line end stays if text stood before it."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
        while at < len(text) and text[at] in " \t":
            at += 1
        if at < len(text) and text[at] == "\n" and (start == 0 or text[start - 1] == "\n"):
            at += 1
    return "".join([*out, text[at:]])


def _rank(doc_id: Column, text: Column) -> Column:
    """Order of documents: doc_id; rows without a whole number for one come last, in a fixed order of their own."""
    return F.coalesce(doc_id.try_cast("long"), F.lit((1 << 63) - 1) - F.pmod(row_key(doc_id, text), F.lit(1 << 40)))


def _digest_batches(kind: str, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranks, digests = [], []
            for rank, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py() or ""
                own = {u[2] for u in units(text, kind)}.union(passages(text.lower().split(), words)[1].tolist())
                digests += own
                ranks += [rank] * len(own)
                if len(digests) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(ranks, pa.int64())], ["digest", "rank"])
                    ranks, digests = [], []
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(ranks, pa.int64())], ["digest", "rank"])

    return run


def _cut_batches(text_at: int, repeated_at: int, kind: str, words: int, names: list[str]):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans, counts = [], [], []
            for text, repeated in zip(b.column(text_at), b.column(repeated_at), strict=True):
                text, repeated = text.as_py(), repeated.as_py()
                gone = removals(text or "", set(repeated or ()), kind, words)
                texts.append(cut(text, gone) if gone else text)
                spans.append([{"start": s, "end": e} for s, e in gone])
                counts.append(len(UNITS[kind].findall(text or "")))
            kept = [texts and pa.array(texts, b.column(text_at).type) or b.column(text_at) if k == text_at else b.column(k) for k in range(b.num_columns) if k != repeated_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, span), pa.array(counts, pa.int32())], names)

    return run


def clean(docs: DataFrame, kind: str = "line", words: int = PASSAGE, prefix: str = "dedup_") -> DataFrame:
    """``docs`` with repeats cut from text, plus dedup_removed (spans of the original text) and dedup_units (units of ``kind``), or the like with another prefix.

    Whole units of ``kind`` and passages of ``words`` words (0: none) go. Earlier means a smaller doc_id; rows without
    one come after all others. Rows that share a doc_id rank alike: a unit first seen there stays in each. A null text
    stays null; an empty table gives an empty result. Documents without repeats keep their text to the letter. A unit of
    a third of all documents is one row per document, summed up before the shuffle; the join back to it is split where skewed.
    """
    t = free_prefix(docs, "_s_")
    rank = _rank(docs["doc_id"], docs["text"])
    pairs = docs.select(rank.alias("rank"), "text").mapInArrow(_digest_batches(kind, words), "digest long, rank long")
    pairs = stored(pairs, "dedup-pairs")
    firsts = pairs.groupBy("digest").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).where("first < last").drop("last")
    late = stored(pairs.join(stored(firsts, "dedup-firsts"), "digest").where("rank > first").select("rank", "digest"), "dedup-late")
    of = late.groupBy(F.col("rank").alias(f"{t}rank")).agg(F.collect_list("digest").alias(f"{t}repeated"))
    columns = [docs[c] for c in docs.columns]
    joined = docs.join(of, rank == of[f"{t}rank"], "left").select(*columns, of[f"{t}repeated"])
    schema = T.StructType([*docs.schema.fields, T.StructField(f"{prefix}removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))), T.StructField(f"{prefix}units", T.IntegerType())])
    return joined.mapInArrow(_cut_batches(docs.columns.index("text"), len(docs.columns), kind, words, schema.names), schema)


def result(docs: DataFrame) -> DataFrame:
    """doc_id, text (cleaned), removed (spans of the original text), n_units, n_removed for every row."""
    return clean(docs.select("doc_id", "text")).select(
        "doc_id", "text", F.col("dedup_removed").alias("removed"), F.col("dedup_units").alias("n_units"), F.size("dedup_removed").alias("n_removed")
    )


def apply(docs: DataFrame) -> DataFrame:
    """The stage: texts without their repeats, n_chars brought up to date, documents that lose all their words left out."""
    p = free_prefix(docs, "dedup_")
    out = clean(docs, prefix=p)
    removed = F.size(F.col(f"{p}removed"))
    out = out.where(F.col("text").isNull() | (removed == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        cut_length = F.when(removed > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", cut_length)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
