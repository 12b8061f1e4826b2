"""Structured Streaming queries over events, drained to a table in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import journal
from ..session import scratch_path, table
from ..streaming import delta, runs

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
LATENESS = "10 days"
#: A user that no event has.
NOBODY = -(1 << 62)
#: Caps of ``stream_stop_rules``: cents, seconds, and failures in a row.
BUDGET, SECONDS, WINDOW, FAILURES = 20000, 12 * 86400, 3, ("error", "view")
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a stream, with time stamps of the session's zone, as watermarks need them."""
    schema = table(spark, sf_dir, "events").schema
    # A file source watches folders; the glob names the one table, be it a file or a folder of parts.
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir.rstrip('/')}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events and, after all of them, one row of a key that no event has: it moves the watermark past the last event, so that append mode hands out everything."""
    events = _events(spark, sf_dir)
    path = scratch_path(spark, "end-of-events")
    row = [F.lit(NOBODY if f.name == "user_id" else "2200-01-01" if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in events.schema.fields]
    spark.range(1).select(*row).write.parquet(path)
    return events.unionByName(spark.readStream.schema(events.schema).parquet(path))


def _on_rocks(spark: SparkSession, run: Callable[[], DataFrame]) -> DataFrame:
    """``run`` with state on RocksDB, as stateful processors need it."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return run()
    finally:
        spark.conf.set(PROVIDER, before)


def _drain(df: DataFrame, tag: str, mode: str = "append") -> DataFrame:
    """Run until nothing is left and read what was written."""
    spark = df.sparkSession
    out = scratch_path(spark, tag)

    def sink(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={k}")  # a batch that runs again replaces its own rows

    delta.run_available(df, scratch_path(spark, f"{tag}-checkpoint"), sink, mode)
    return spark.read.schema(df.schema).parquet(f"{out}/batch=*")


def stream_first_sight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _on_rocks(spark, lambda: _drain(delta.first_sight(_events(spark, sf_dir), "user_id", "event_type", ["event_id", "user_id", "event_type"]), "first-sight"))
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("events"), F.count_if("is_new").alias("new"))


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(delta.distinct_within(_events(spark, sf_dir).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts").select("user_id", "event_type"), "distinct")


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = delta.tumbling(_closed(spark, sf_dir), "ts", "1 day", LATENESS, ["event_type"])
    return _drain(g.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), "tumbling")


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = delta.sliding(_closed(spark, sf_dir), "ts", "1 day", "12 hours", LATENESS, ["event_type"])
    return _drain(g.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n"), "sliding")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = delta.sessions(_closed(spark, sf_dir), "ts", "4 hours", LATENESS, ["user_id"])
    return _drain(g.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n"), "sessions")


def stream_stop_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as finished work that began value minutes before; caps on cost, clock and failures in a row."""
    e = _closed(spark, sf_dir).withWatermark("ts", "0 seconds")
    started = F.col("ts") - F.make_dt_interval(mins=F.floor(F.coalesce("value", F.lit(0.0))).cast("int"))
    rows = e.select("user_id", F.col("ts").alias("time"), F.col("event_id").alias("nr"), started.alias("started"), F.floor(F.col("value") * 100).cast("long").alias("cost"), F.col("event_type").isin(*FAILURES).alias("failed"))
    out = _on_rocks(spark, lambda: _drain(runs.stop_rules(rows, "user_id", BUDGET, SECONDS, WINDOW), "stop-rules"))
    return out.where(F.col("user_id") != NOBODY).select("user_id", "nr", "verdict", "reason", "cost", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def stream_accumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch query ``accumulated`` as a stream, and how many rows came after the end."""
    e = _closed(spark, sf_dir).withWatermark("ts", "0 seconds")
    rows = e.select("user_id", F.col("ts").alias("time"), F.col("event_id").alias("nr"), F.when(F.col("event_id") % 11 == 0, "finalize").otherwise("item").alias("event"), (F.col("event_type") != "error").alias("valid"), F.when(F.col("event_id") % 2 == 0, "complete").otherwise("partial").alias("status"))
    out = _on_rocks(spark, lambda: _drain(runs.sessions(rows, "user_id", 3650 * 86400), "sessions-of-items")).where(F.col("user_id") != NOBODY)
    document = F.col("kind") == "document"
    return out.groupBy("user_id").agg(F.sum(F.when(document, F.col("n"))).alias("items"), F.max(F.when(document, F.col("status"))).alias("status"), F.coalesce(F.sum(F.when(~document, F.col("n"))), F.lit(0)).cast("long").alias("late"))


def stream_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as changes of state, legal or not; a third of the users start from a recovered table."""
    t = F.col("event_type")
    status = F.when(t == "click", "running").when(t == "error", "failed").when(t == "purchase", "done").otherwise("pending")
    rows = _closed(spark, sf_dir).withWatermark("ts", "0 seconds").select("user_id", F.col("ts").alias("time"), F.col("event_id").alias("nr"), status.alias("status"))
    crashed = table(spark, sf_dir, "events").where("user_id % 3 = 0").select("user_id").distinct().withColumn("status", F.when(F.col("user_id") % 2 == 0, "running").otherwise("failed"))
    out = _on_rocks(spark, lambda: _drain(runs.transitions(rows, "user_id", journal.recover(crashed)), "transitions"))
    return out.where(F.col("user_id") != NOBODY).select("user_id", "nr", "before", "status", "legal")


QUERIES = {f.__name__: f for f in (stream_first_sight, stream_distinct, stream_tumbling, stream_sliding, stream_sessions, stream_stop_rules, stream_accumulated, stream_transitions)}

ORACLES = {
    "stream_first_sight": "SELECT user_id, event_type, count(*) AS events, 1::BIGINT AS new FROM events GROUP BY 1, 2",
    "stream_distinct": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_tumbling": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_sliding": """SELECT strftime(time_bucket(INTERVAL 12 HOURS, ts, TIMESTAMP '2000-01-01') - k * INTERVAL 12 HOURS, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1, 2""",
    "stream_sessions": """WITH a AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 4 HOURS THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM a)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, g""",
    "stream_stop_rules": f"""WITH e AS (SELECT user_id, event_id AS nr, (epoch_us(ts) // 1000) AS t, (epoch_us(ts) // 1000) - floor(coalesce(value, 0))::BIGINT * 60000 AS s, coalesce(floor(value * 100), 0)::BIGINT AS cost, event_type IN {FAILURES} AS failed,
  row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id)),
r AS (SELECT *, sum(cost) OVER (PARTITION BY user_id ORDER BY n) AS running, sum(failed::INTEGER) OVER (PARTITION BY user_id ORDER BY n ROWS {WINDOW - 1} PRECEDING) = {WINDOW} AS fails, min(t) OVER (PARTITION BY user_id) + {SECONDS * 1000} AS clock FROM e),
b AS (SELECT user_id, any_value(clock) AS clock, min(n) FILTER (running >= {BUDGET} OR fails) AS nb FROM r GROUP BY user_id),
c AS (SELECT b.*, r.t IS NULL OR b.clock <= r.t AS by_clock, CASE WHEN r.t IS NULL OR b.clock <= r.t THEN b.clock ELSE r.t END AS stop_at,
  CASE WHEN r.t IS NULL OR b.clock <= r.t THEN 'stop_wallclock' WHEN r.running >= {BUDGET} THEN 'stop_budget' ELSE 'stop_failures' END AS why FROM b LEFT JOIN r ON r.user_id = b.user_id AND r.n = b.nb),
v AS (SELECT e.*, why, stop_at, CASE WHEN by_clock AND t < clock OR NOT by_clock AND n <= nb THEN 'run' WHEN s > stop_at THEN 'refused' ELSE 'in flight' END AS verdict FROM e JOIN c USING (user_id)),
f AS (SELECT *, sum(CASE WHEN verdict <> 'refused' THEN cost ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n)::BIGINT AS total FROM v)
SELECT user_id, nr, verdict, CASE WHEN verdict <> 'run' THEN why END AS reason, total AS cost, strftime(make_timestamp(t * 1000), '%Y-%m-%d %H:%M:%S') AS at FROM f
UNION ALL SELECT user_id, NULL, 'stop', any_value(why), coalesce(sum(cost) FILTER (verdict = 'run'), 0)::BIGINT, strftime(make_timestamp(any_value(stop_at) * 1000), '%Y-%m-%d %H:%M:%S') FROM f GROUP BY user_id""",
    "stream_accumulated": """WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS n FROM events),
f AS (SELECT user_id, min(n) AS e, arg_min(CASE WHEN event_id % 2 = 0 THEN 'complete' ELSE 'partial' END, n) AS s FROM a WHERE event_id % 11 = 0 AND event_type <> 'error' GROUP BY user_id)
SELECT user_id, count(*) FILTER (event_id % 11 <> 0 AND event_type <> 'error' AND (e IS NULL OR n < e)) AS items, coalesce(min(s), 'failed') AS status, count(*) FILTER (n > e) AS late FROM a LEFT JOIN f USING (user_id) GROUP BY user_id""",
    "stream_transitions": """WITH RECURSIVE e AS (SELECT user_id, event_id AS nr, CASE event_type WHEN 'click' THEN 'running' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'done' ELSE 'pending' END AS status, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS n FROM events),
w AS (SELECT user_id, 0::BIGINT AS n, CASE WHEN user_id % 6 = 3 THEN 'failed' ELSE 'pending' END AS now, NULL::BIGINT AS nr, NULL::VARCHAR AS before, NULL::VARCHAR AS status, NULL::BOOLEAN AS legal FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT user_id, n, CASE WHEN legal THEN status ELSE before END, nr, before, status, legal FROM (SELECT e.user_id, e.n, e.nr, w.now AS before, e.status,
  e.status = w.now OR (w.now || '>' || e.status) IN ('pending>running', 'running>done', 'running>failed', 'running>pending', 'failed>pending', 'failed>running') AS legal FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1))
SELECT user_id, nr, before, status, legal FROM w WHERE n > 0""",
}
