"""Surrogate keys that stay the same from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import rank, running


def stable_ids(existing: DataFrame, current: DataFrame, group: list[str], key: str, order: list[Column], first: int = 1) -> DataFrame:
    """``current`` with id: kept where the key had one, else numbered on from the group's highest kept id.

    ``existing`` has group, key and id; keys no longer current lose theirs. New keys are ranked over range partitions,
    so a group may hold any share of the rows; ``order`` must not tie.
    """
    joined = current.join(existing.select(*group, key, "id"), [*group, key], "left")
    top = joined.groupBy(*group).agg(F.max("id").alias("_top")).where("_top IS NOT NULL")
    new = rank(joined.where("id IS NULL"), group, order, "_rank").join(top, group, "left")
    new = new.withColumn("id", F.coalesce("_top", F.lit(first - 1)) + F.col("_rank")).select(*joined.columns)
    return joined.where("id IS NOT NULL").unionByName(new)


def gap_serials(used: DataFrame, new: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``new`` with serial: the n-th new row of a group gets its n-th smallest unused positive integer.

    Below the i-th used serial u lie u - i free ones, so the n-th free one is n and the number of used serials with
    u - i < n: a running count over both in one order. No candidates are made, and ranks run over range partitions.
    ``order`` must not tie.
    """
    once = used.select(group, F.col("serial").cast("long").alias("_u")).where("_u > 0").distinct()
    taken = rank(once, [group], [F.col("_u")], "_i").select(group, (F.col("_u") - F.col("_i")).alias("_at"), F.lit(1).alias("_taken"), F.col("_u").alias("_nr"))
    nth = rank(new, [group], order, "_at").withColumn("_taken", F.lit(0)).withColumn("_nr", F.lit(0).cast("long"))
    both = nth.unionByName(taken, allowMissingColumns=True)
    counted = running(both, [group], [F.col("_at"), F.col("_taken"), F.col("_nr")], {"_before": F.col("_taken").cast("long")})
    return counted.where("_taken = 0").withColumn("serial", F.col("_at") + F.col("_before")).select(*new.columns, "serial")


def designation(letter: Column, serial: Column) -> Column:
    return F.concat(letter, F.lit("."), F.lpad(serial.cast("string"), F.greatest(F.lit(4), F.length(serial.cast("string"))), F.lit("0")))


def resolve_collisions(rows: DataFrame, slug: str, suffix: Column, order: list[Column]) -> DataFrame:
    """Every occurrence of a slug after the first gets the suffix."""
    rn = F.row_number().over(Window.partitionBy(slug).orderBy(*order))
    return rows.withColumn("_rn", rn).withColumn(slug, F.when(F.col("_rn") > 1, F.concat(F.col(slug), F.lit("-"), suffix)).otherwise(F.col(slug))).drop("_rn")


def first_occurrence(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def rewritten_name(name: Column, number: Column) -> Column:
    """An artifact's name under its new number: the first four digits and hyphen change."""
    return F.concat(F.lpad(number.cast("string"), 4, "0"), F.lit("-"), F.regexp_replace(name, "^[^-]*-", ""))
