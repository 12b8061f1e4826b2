"""Newsletter polls as a stream: state, items and digest of a poll move together, under one number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import rank
from ..sources.writers import _fs, exists

#: slug, url, first_seen_at: one row for each URL that a vendor has ever listed. items and digest are of one poll each.
TABLES = {"seen": "slug string, url string, first_seen_at timestamp", "items": "slug string, url string, date date, is_new boolean, first_seen_at timestamp, place long", "digest": "slug string, items long, new_items long, newest date, polled_at timestamp"}


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the polls that are complete, in order."""
    fs, folder = _fs(spark, f"{path}/commits")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder)) if fs.exists(folder) else []


def read(spark: SparkSession, path: str, name: str, before: int | None = None) -> DataFrame:
    """One of TABLES with its poll's number as ``poll``: complete polls only, and only those below ``before`` if it is given."""
    polls = [k for k in committed(spark, path) if before is None or k < before]
    if not polls:
        return spark.createDataFrame([], f"{TABLES[name]}, poll long")
    rows = spark.read.schema(f"{TABLES[name]}, poll long").option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    return rows.where(F.col("poll").isin(polls))


def sink(path: str, now: Callable[[int], str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over rows of slug, url, date; ``now`` gives the time of a poll by its number.

    What is new is found by an anti join with the URLs that earlier polls have seen, rows like any others, so a vendor
    may have any number of them. Each table of the poll is written under its number, and a file named by the number,
    made last, makes the three visible at once. A poll that runs again sees what it saw the first time and replaces its
    own rows; one that died leaves nothing that ``read`` shows.
    """

    def run(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        at = F.lit(now(k)).cast("timestamp")
        own = batch.where("slug IS NOT NULL AND url IS NOT NULL").groupBy("slug", "url").agg(F.max("date").alias("date"))
        seen = read(spark, path, "seen", k).select("slug", "url", F.col("first_seen_at").alias("_before"))
        met = own.join(seen, ["slug", "url"], "left").select("slug", "url", "date", F.col("_before").isNull().alias("is_new"), F.coalesce("_before", at).alias("first_seen_at"))
        items = rank(met, ["slug"], [F.desc("date"), F.desc("url")], "place")
        items.write.mode("overwrite").parquet(f"{path}/items/poll={k}")
        written = spark.read.schema(TABLES["items"]).parquet(f"{path}/items/poll={k}")
        written.where("is_new").select("slug", "url", "first_seen_at").write.mode("overwrite").parquet(f"{path}/seen/poll={k}")
        digest = written.groupBy("slug").agg(F.count("*").alias("items"), F.count_if("is_new").alias("new_items"), F.max("date").alias("newest")).withColumn("polled_at", at)
        digest.write.mode("overwrite").parquet(f"{path}/digest/poll={k}")
        fs, mark = _fs(spark, f"{path}/commits/{k}")
        if not exists(spark, f"{path}/commits/{k}"):
            fs.create(mark, False).close()

    return run


def state(spark: SparkSession, path: str) -> DataFrame:
    """slug, seen (how many URLs), polls_completed, last_polled_at of each vendor, over all complete polls."""
    seen = read(spark, path, "seen").groupBy("slug").agg(F.count("*").alias("seen"))
    polls = read(spark, path, "digest").groupBy("slug").agg(F.count("*").alias("polls_completed"), F.max("polled_at").alias("last_polled_at"))
    return polls.join(seen, "slug", "left").withColumn("seen", F.coalesce("seen", F.lit(0).cast("long")))
