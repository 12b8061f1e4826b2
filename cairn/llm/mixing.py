"""Mixing sources to target weights (10): hash-threshold histograms.

Sizes are summed by source and hash bucket; the bucket in which a source's budget runs out is cut into finer
buckets, level by level, until one hash value is left. Documents are then taken by comparing their hash with
their source's threshold: nothing is sorted and no document moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_prefix, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEATS = 2
LEVELS, LEVEL_BITS, HASH_BITS = 3, 12, 60


def size_of(text: Column) -> Column:
    """Words of a text: one for each place where a blank or the start is followed by a word."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target: ``budget`` of all words shared by weight, no source above ``repeats`` times its size.

    Sharing the excess again until none is above has a closed form: in order of cap by weight, the sources before
    some place stop at their caps and the rest get one level times their weight. ``sizes`` has one row a source;
    its sums run over that table alone.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("w", pick.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    all_rows = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(all_rows) * F.lit(budget)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    s = s.withColumn("level", (total - capped) / open_weight)
    # The first source in this order that its level does not fill sets the level of all that come after.
    line = F.first(F.when(F.col("cap") / F.col("w") >= F.col("level"), F.col("level")), ignorenulls=True).over(all_rows)
    return s.withColumn("line", line).select("source", "source_size", F.least(F.col("cap"), F.col("line") * F.col("w")).alias("target"))


def _bucket(h: Column, level: int) -> Column:
    """The ``level``-th group of bits of the hash, from the top."""
    return F.shiftright(h, HASH_BITS - LEVEL_BITS * (level + 1)).bitwiseAND((1 << LEVEL_BITS) - 1)


def _prefix(h: Column, level: int) -> Column:
    """All bits of the hash above those of ``level``."""
    return F.shiftright(h, HASH_BITS - LEVEL_BITS * level) if level else F.lit(0).cast("long")


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, edge: documents whose hash prefix is below ``edge`` fill ``want`` words as nearly as the last bucket allows.

    ``rows`` has source, size and h; ``wanted`` has source and want.
    """
    at = wanted.select("source", F.col("want").alias("rest"), F.lit(0).cast("long").alias("head"))
    for level in range(LEVELS):
        # Only the bucket on the edge is looked into: a row belongs to it if its upper bits are those found so far.
        inside = rows.join(at.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")) & (_prefix(F.col("h"), level) == F.col("head"))) if level else rows
        sums = inside.groupBy("source", _bucket(F.col("h"), level).alias("b")).agg(F.sum("size").alias("n"))
        sums = stored(sums, f"mix-{level}")
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("b"))
        run = sums.withColumn("upto", upto).join(at.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "right")
        last = level == LEVELS - 1
        # Below the edge: whole buckets that fit. At the last level the bucket that crosses is taken if that comes nearer.
        fits = F.col("upto") <= F.col("rest")
        if last:
            fits = F.col("upto") - F.col("n") / 2 <= F.col("rest")
        found = run.groupBy(F.col("_s").alias("source"), "rest", "head").agg(
            F.max(F.when(fits, F.col("upto"))).alias("used"), F.max(F.when(fits, F.col("b"))).alias("top"), F.min(F.when(~fits, F.col("b"))).alias("next")
        )
        # The edge is the first bucket that does not fit; where all fit, it lies past the last bucket.
        cell = F.coalesce(F.col("next"), F.when(F.col("top").isNotNull(), F.lit(1 << LEVEL_BITS)), F.lit(0))
        past = cell == (1 << LEVEL_BITS)
        at = stored(
            found.select(
                "source", (F.col("rest") - F.coalesce(F.col("used"), F.lit(0))).alias("rest"),
                F.when(past, (F.col("head") + 1) * (1 << LEVEL_BITS)).otherwise(F.col("head") * (1 << LEVEL_BITS) + cell).alias("head"),
            ),
            f"mix-edge-{level}",
        )
    return at.select("source", F.col("head").alias("edge"))


def _hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of identifier and text."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("|"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.left(digest, F.lit(HASH_BITS // 4)), 16, 10).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the hash that orders documents; written once, as every level reads it."""
    return stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), _hash(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row a source: mix_source, source_size, target, base (repeats that all its documents get) and edge (below it, one more)."""
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    goal = targets(sizes, weights, budget, repeats)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = stored(goal.withColumn("base", base.cast("long")).withColumn("want", F.col("target") - F.col("base") * F.col("source_size")), "mix-goal")
    edges = thresholds(rows, goal.select("source", "want")).withColumnRenamed("source", "mix_source")
    joined = goal.join(edges, F.col("source").eqNullSafe(F.col("mix_source")))
    return stored(joined.select(F.col("source").alias("mix_source"), "source_size", "target", "base", "edge"), "mix-plan")


def times(h: Column, base: Column, edge: Column, repeats: int = MAX_REPEATS) -> Column:
    """How often the mix takes a document, from its hash and its source's plan."""
    below = F.shiftright(h, HASH_BITS - LEVEL_BITS * LEVELS) < edge
    return F.least(base + below.cast("long"), F.lit(repeats).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every row of ``docs``: taken is 0, its size, or whole repeats up to ``repeats``.

    A source whose target is k sizes and a part takes every document k times and the part by hash. A null source is
    a source of its own; a null text has size 0 and takes 0; rows equal in doc_id and text share one fate; an empty
    table gives an empty result. Reruns agree, as the hash depends on the row alone.
    """
    rows = measured(docs)
    joined = rows.join(plan(rows, weights, budget, repeats), F.col("source").eqNullSafe(F.col("mix_source")))
    return joined.select("doc_id", "size", "source_size", "target", (times(F.col("h"), F.col("base"), F.col("edge"), repeats) * F.col("size")).alias("taken"), "source")


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus itself: each row of ``docs`` as often as the mix takes it, numbered by mix_copy from 1; texts are not shuffled."""
    t = free_prefix(docs, "_m_")
    decided = plan(measured(docs), weights, budget, repeats)
    decided = decided.select(*[F.col(c).alias(f"{t}{c}") for c in ("mix_source", "base", "edge")])
    joined = docs.join(decided, docs["source"].eqNullSafe(decided[f"{t}mix_source"]))
    n = times(_hash(docs["doc_id"], docs["text"]), F.col(f"{t}base"), F.col(f"{t}edge"), repeats)
    kept = joined.withColumn(f"{t}times", n).where(F.col(f"{t}times") > 0)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{t}times"))).alias(free_prefix(docs, "mix_copy"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], copies)


_WS = ", ".join(map(str, WEIGHTS))
#: The same mix in DuckDB: prefixes of 36 bits are nine hexadecimal digits of the MD5, and one is taken if its middle lies within what is wanted.
ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
  left(md5(coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(text, '')), {LEVELS * LEVEL_BITS // 4}) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([{_WS}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS w, source_size * {float(MAX_REPEATS)}::DOUBLE AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM w),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * {BUDGET}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o),
f AS (SELECT *, (SELECT arg_min(level, k) FROM l WHERE cap / w >= level) AS line FROM l),
t AS (SELECT source, source_size, least(cap, line * w) AS target FROM f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM t),
g AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY h) - n / 2 AS middle FROM g)
SELECT d.doc_id, d.size, b.source_size, b.target, (least(b.base + CASE WHEN c.middle <= b.target - b.base * b.source_size THEN 1 ELSE 0 END, {MAX_REPEATS}) * d.size)::BIGINT AS taken, d.source
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN c ON c.h = d.h AND c.source IS NOT DISTINCT FROM d.source"""
