"""Run journals: caps, stop rules, totals and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running


def failure_window(rows: DataFrame, key: list[str], order: list[Column], failed: Column, n: int = 5) -> DataFrame:
    """``rows`` with stop: this and the n - 1 before it all failed."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(-(n - 1), 0)
    return rows.withColumn("stop", (F.min(failed.cast("int")).over(w) == 1) & (F.count("*").over(w) == n))


def cumulative(rows: DataFrame, key: list[str], order: list[Column], cost: Column, cap: Column) -> DataFrame:
    """``rows`` with running (cost so far) and capped (the cap is reached here or before); ``order`` must not tie."""
    return running(rows, key, order, {"running": cost}).withColumn("capped", F.col("running") >= cap)


def remaining_time(passes: DataFrame, key: list[str], order: list[Column], seconds: str, budget: float) -> DataFrame:
    """``passes`` with left: the time a key has before each of its passes."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return passes.withColumn("left", F.greatest(F.lit(0.0), F.lit(float(budget)) - F.coalesce(F.sum(seconds).over(w), F.lit(0.0))))


def totals(rows: DataFrame, key: list[str]) -> DataFrame:
    n = lambda x: F.count_if(F.col("event") == x)
    return rows.groupBy(*key).agg(n("completed").alias("completed"), n("skipped").alias("skipped"), n("failed").alias("failed"), F.sum("cost").alias("cost"))


def state(log: DataFrame, key: list[str], ts: str = "ts") -> DataFrame:
    """The newest status of each key from a log of transitions."""
    return log.groupBy(*key).agg(F.max_by("status", ts).alias("status"), F.max(ts).alias("updated_at"))


def recover(rows: DataFrame, retry_failed: bool = False) -> DataFrame:
    """State after a crash: work that ran is pending again; failed work, too, on retry."""
    again = F.col("status") == "running"
    if retry_failed:
        again = again | (F.col("status") == "failed")
    return rows.withColumn("status", F.when(again, "pending").otherwise(F.col("status")))


def remaining(selected: DataFrame, done: DataFrame, key: list[str], retry_failed: bool = False) -> DataFrame:
    """Work that is left: done URLs are skipped, failed ones unless they are retried."""
    skip = done.where(F.col("status").isin("done", "fetched") | (F.col("status") == "failed") & F.lit(not retry_failed))
    return selected.join(skip.select(*key), key, "left_anti")


def submission(rows: DataFrame, key: list[str]) -> DataFrame:
    """The latest valid submission; partial where the run was capped."""
    g = rows.groupBy(*key).agg(F.max_by("submission", F.when(F.col("valid"), F.col("attempt"))).alias("submission"), F.max_by("status", F.when(F.col("valid"), F.col("attempt"))).alias("_s"), F.bool_or("capped").alias("_c"))
    return g.withColumn("status", F.when(F.col("_c"), "partial").otherwise(F.col("_s"))).drop("_s", "_c")


def accumulated(events: DataFrame, key: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(items, documents) of sessions that hand in items one by one: valid items up to the first valid finalize event, and its status.

    ``events`` has event (item or finalize), valid and status. A session that never finalizes has its items and the
    status failed; what comes after the end does not count.
    """
    at = F.struct(*order)
    ends = events.where("event = 'finalize' AND valid").groupBy(*key).agg(F.min(at).alias("_end"), F.min_by("status", at).alias("_status"))
    marked = events.join(ends, key, "left")
    counts = (F.col("event") == "item") & F.col("valid") & F.coalesce(at < F.col("_end"), F.lit(True))
    documents = marked.groupBy(*key).agg(F.count_if(counts).alias("items"), F.coalesce(F.first("_status"), F.lit("failed")).alias("status"))
    return marked.where(counts).drop("_end", "_status"), documents


# Texts that tell an error after which retrying is futile.
BALANCE_ERRORS = ("credit balance is too low", "credit balance too low", "insufficient credits", "insufficient_credits", "insufficient_funds", "your credit balance is below", "billing")
AUTH_ERRORS = ("invalid x-api-key", "invalid api key", "authentication_error", "unauthorized", "401 unauthorized", "403 forbidden")


def error_class(message: Column) -> Column:
    """Fatal errors by their text, balance before auth; else transient."""
    low = F.lower(message)
    has = lambda texts: low.rlike("|".join(texts))
    return F.when(has(BALANCE_ERRORS), "balance").when(has(AUTH_ERRORS), "auth").otherwise("transient")


def stored_message(message: Column, known: Column) -> Column:
    """An error's text as the journal keeps it: the first 2,000 characters of a known kind, 500 of any other."""
    return F.left(message, F.when(F.coalesce(known, F.lit(False)), 2000).otherwise(500))
