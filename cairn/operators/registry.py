"""The registry of covered targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_valid(entries: DataFrame, key: list[str], updated: str, as_of: Column, max_age_days: float | None, complete: Column, tie: list[Column]) -> DataFrame:
    """The newest complete entry of each key that is not too old."""
    ok = complete
    if max_age_days is not None:
        ok = ok & ((F.unix_micros(as_of) - F.unix_micros(F.col(updated))) / F.lit(8.64e10) <= max_age_days)
    return entries.where(ok).withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(updated), *tie))).where("_rn = 1").drop("_rn")


def upsert(registry: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """Complete updates replace the entries of their key."""
    new = updates.where("quality_status = 'complete'")
    return registry.join(new.select(*key), key, "left_anti").unionByName(new)


def disposition(targets: DataFrame, covered: DataFrame, key: list[str], force: bool = False, reuse: bool = False) -> DataFrame:
    """What a run does with each target: mirror, skip or reuse."""
    j = targets.join(covered.select(*key, F.lit(True).alias("_c")), key, "left")
    return j.withColumn("disposition", F.when(F.lit(force) | F.col("_c").isNull(), "mirror").otherwise("reuse" if reuse else "skip")).drop("_c")


def mirrored(requested: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Requested targets that were mirrored; what else was mirrored does not count."""
    return requested.join(done.select(*key), key, "left_semi")


def manifest_entry(corpora: DataFrame) -> DataFrame:
    """The run manifest's row of each corpus; ``corpora`` has a resources array, a quality struct, disposition and covered_by_run_id."""
    q = lambda c: F.col(f"quality.{c}")
    return corpora.select(
        "target_id", "display_name", q("status").alias("quality_status"), "manifest_path", "quality_report_path", F.coalesce(F.size("resources"), F.lit(0)).alias("resource_count"), "disposition",
        q("browserless_calls_used").alias("browserless_calls_used"), q("browserless_call_budget").alias("browserless_call_budget"), q("budget_exhausted").alias("budget_exhausted"), "covered_by_run_id",
    )


def policy_hash(*settings: Column) -> Column:
    """sha256 of the canonical JSON of a policy: its settings by name."""
    return F.sha2(F.to_json(F.struct(*settings)), 256)


def merge_documents(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """All keys of both sides; the left side's columns first."""
    a, b = left.select(*key, *columns), right.select(*key, *[F.col(c).alias(f"_{c}") for c in columns])
    return a.join(b, key, "full_outer").select(*key, *[F.coalesce(c, f"_{c}").alias(c) for c in columns])
