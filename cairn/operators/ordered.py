"""Running sums and ranks inside groups of any size: two passes over range partitions instead of one task a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def running(rows: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each name in ``sums``, the sum of that column over the rows of the group up to this one in order.

    Rows are dealt to ranges of (group, order) and written; the sums of each range and group, few rows, are what the
    ranges after it start from. A group that holds a third of all rows is many ranges. ``order`` must not tie; null
    groups are groups, a null value counts as nothing. A sum of ones is the rank.
    """
    part = "_part"
    values = {f"_v_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()}
    dealt = stored(rows.withColumns(values).repartitionByRange(*[F.col(g) for g in group], *order).withColumn(part, F.spark_partition_id()), "ranges")
    upto = Window.partitionBy(part, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({n: F.sum(f"_v_{n}").over(upto) for n in sums})
    totals = dealt.groupBy(part, *group).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col(part).alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in group], *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums])
    same = F.col(part) == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return local.join(starts, same).select(*[c for c in rows.columns if c not in sums], *[(F.col(n) + F.col(f"_s_{n}")).alias(n) for n in sums])


def rank(rows: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their number in the group, from 1."""
    return running(rows, group, order, {name: F.lit(1).cast("long")})
