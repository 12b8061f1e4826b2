"""Queries over journals, run state and the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as d
from ..operators import journal, quality, registry
from ..session import table

def _order():
    return [F.col("ts"), F.col("event_id")]


def failure_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return journal.failure_window(e, ["user_id"], _order(), F.col("event_type").isin("error", "view"), 3).select("event_id", "stop")


def cost_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("cents", F.floor(F.col("value") * 100).cast("long"))
    return journal.cumulative(e, ["user_id"], _order(), F.col("cents"), F.lit(20000)).select("event_id", "running", "capped")


def remaining_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("seconds", F.floor("value").cast("double"))
    return journal.remaining_time(e, ["user_id"], _order(), "seconds", 600.0).select("event_id", "left")


def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.when(t == "purchase", "completed").when(t == "error", "failed").when(t == "view", "skipped").otherwise("other").alias("event"), F.floor(F.col("value") * 100).cast("long").alias("cost"))
    return journal.totals(rows, ["day"])


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "click", "running").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").otherwise("pending").alias("status"), F.struct("ts", "event_id").alias("ts"))
    return journal.recover(journal.state(log, ["user_id"]), retry_failed=True).select("user_id", "status", F.col("updated_at.event_id").alias("event_id"))


def remaining_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    done = o.where("o_orderkey % 2 = 0").groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "failed").otherwise("queued")).alias("status"))
    return journal.remaining(o.select("o_custkey").distinct(), done, ["o_custkey"])


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("attempt"), F.col("event_id").alias("submission"), (F.col("event_type") != "error").alias("valid"), F.lit("complete").alias("status"), (F.col("event_id") % 97 == 0).alias("capped"))
    return journal.submission(rows, ["user_id"])


def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.element_at(F.array(*[F.lit(x) for x in ("Your credit balance is too low", "HTTP 401 Unauthorized", "timeout", "BILLING issue: 403 forbidden", "invalid API key")]), (F.col("event_id") % 5 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select(journal.error_class(m).alias("error_class"), F.repeat(m, (F.col("event_id") % 97).cast("int")).alias("message"))
    kept = F.length(journal.stored_message(F.col("message"), F.col("error_class") != "transient"))
    return e.groupBy("error_class").agg(F.count("*").alias("n"), F.sum(kept).alias("chars"), F.max(kept).cast("long").alias("most"))


def state_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def canonical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(s == "F", "fetched").when(F.col("o_orderpriority").startswith("1"), "failed").when(s == "O", "queued").otherwise("skipped_budget").alias("status"), F.when(F.col("o_orderkey") % 4 == 0, "document").otherwise("html").alias("kind"))
    return quality.canonical(rows, ["o_custkey"])


def registry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("updated_at", F.col("o_orderdate").cast("timestamp"))
    out = registry.newest_valid(o, ["o_custkey"], "updated_at", F.lit("1999-01-01").cast("timestamp"), 900.0, F.col("o_orderstatus") == "F", [F.col("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", F.round(d.age_days(F.col("updated_at"), F.lit("1999-01-01").cast("timestamp")), 3).alias("age"))


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    old = c.select("c_custkey", F.lit("complete").alias("quality_status"), F.lit(1).alias("version"))
    new = c.select((F.col("c_custkey") + 50).alias("c_custkey")).select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "partial").otherwise("complete").alias("quality_status"), F.lit(2).alias("version"))
    return registry.upsert(old, new, ["c_custkey"])


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    covered = registry_latest(spark, sf_dir).select(F.col("o_custkey").alias("c_custkey"))
    return registry.disposition(c, covered, ["c_custkey"], reuse=True)


def requested_mirrored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey"), table(spark, sf_dir, "orders").where("o_totalprice > 100000")
    return registry.mirrored(c, o.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


def profile_products_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.lit("profile").alias("origin"))
    c = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") + 50).alias("k")).agg(F.concat(F.lit("part "), F.max("l_suppkey").cast("string")).alias("name")).withColumn("origin", F.lit("catalog"))
    return registry.merge_documents(p, c, ["k"], ["name", "origin"])


def dates_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return o.select("o_orderkey", d.short_date(day).alias("short"), d.freshness(day, F.lit("1996-06-01").cast("date")).alias("freshness"), d.reviewed_at(F.when(F.col("o_orderkey") % 3 == 0, ""), F.when(F.col("o_orderkey") % 2 == 0, day.cast("string")), F.lit(None).cast("string")).alias("reviewed_at"))


QUERIES = {
    f.__name__: f for f in (failure_window, cost_cap, remaining_time, batch_totals, run_state, remaining_work, submissions, error_classes, state_summary, canonical_quality, registry_latest, registry_upsert, coverage, requested_mirrored, profile_products_full, dates_shown)
}

_LATEST = """l AS (SELECT o_custkey, o_orderkey, round((epoch_us(TIMESTAMP '1999-01-01') - epoch_us(o_orderdate)) / 8.64e10, 3) AS age FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders
  WHERE o_orderstatus = 'F' AND (epoch_us(TIMESTAMP '1999-01-01') - epoch_us(o_orderdate)) / 8.64e10 <= 900.0) WHERE rn = 1)"""
ORACLES = {
    "failure_window": "SELECT event_id, sum(CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING) = 3 AS stop FROM events",
    "cost_cap": "SELECT event_id, (sum(floor(value * 100)) OVER w)::BIGINT AS running, sum(floor(value * 100)) OVER w >= 20000 AS capped FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)",
    "remaining_time": 'SELECT event_id, greatest(0.0::DOUBLE, 600.0 - coalesce(sum(floor(value)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS "left" FROM events',
    "batch_totals": "SELECT ts::DATE AS day, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'error') AS failed, sum(floor(value * 100))::BIGINT AS cost FROM events GROUP BY 1",
    "run_state": "SELECT user_id, CASE event_type WHEN 'purchase' THEN 'done' ELSE 'pending' END AS status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "remaining_work": """SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0 GROUP BY o_custkey
  HAVING max(CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'queued' END) IN ('done', 'failed'))""",
    "submissions": "SELECT user_id, arg_max(event_id, (ts, event_id)) FILTER (event_type <> 'error') AS submission, CASE WHEN bool_or(event_id % 97 = 0) THEN 'partial' WHEN bool_or(event_type <> 'error') THEN 'complete' END AS status FROM events GROUP BY user_id",
    "error_classes": """WITH m AS (SELECT CASE event_id % 5 WHEN 0 THEN 'balance' WHEN 1 THEN 'auth' WHEN 2 THEN 'transient' WHEN 3 THEN 'balance' ELSE 'auth' END AS error_class,
  len(['Your credit balance is too low', 'HTTP 401 Unauthorized', 'timeout', 'BILLING issue: 403 forbidden', 'invalid API key'][event_id % 5 + 1]) * (event_id % 97) AS n FROM events),
k AS (SELECT error_class, least(n, CASE error_class WHEN 'transient' THEN 500 ELSE 2000 END) AS c FROM m) SELECT error_class, count(*) AS n, sum(c)::BIGINT AS chars, max(c) AS most FROM k GROUP BY 1""",
    "state_summary": "SELECT CASE WHEN grouping(o_orderstatus) = 0 THEN 'o_orderstatus' WHEN grouping(o_orderpriority) = 0 THEN 'o_orderpriority' ELSE 'all' END AS dimension, coalesce(o_orderstatus, o_orderpriority) AS value, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "canonical_quality": """WITH r AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'fetched' WHEN starts_with(o_orderpriority, '1') THEN 'failed' WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'skipped_budget' END AS s, o_orderkey % 4 <> 0 AS h FROM orders),
g AS (SELECT o_custkey, count(*) FILTER (s = 'fetched' AND h) AS html, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'skipped_budget') AS skipped FROM r GROUP BY 1)
SELECT *, CASE WHEN html = 0 THEN 'failed' WHEN failed > 0 OR skipped > 0 THEN 'partial' ELSE 'complete' END AS quality FROM g""",
    "registry_latest": f"WITH {_LATEST} SELECT * FROM l",
    "registry_upsert": """SELECT c_custkey, 'complete' AS quality_status, 1 AS version FROM customer WHERE c_custkey % 5 = 0 OR c_custkey - 50 NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT c_custkey + 50, 'complete', 2 FROM customer WHERE c_custkey % 5 <> 0""",
    "coverage": f"WITH {_LATEST} SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN 'mirror' ELSE 'reuse' END AS disposition FROM customer LEFT JOIN l ON o_custkey = c_custkey",
    "requested_mirrored": "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)",
    "profile_products_full": """WITH p AS (SELECT p_partkey AS k, p_name AS name FROM part), c AS (SELECT l_partkey + 50 AS k, 'part ' || max(l_suppkey) AS name FROM lineitem GROUP BY 1)
SELECT coalesce(p.k, c.k) AS k, coalesce(p.name, c.name) AS name, CASE WHEN p.k IS NOT NULL THEN 'profile' ELSE 'catalog' END AS origin FROM p FULL JOIN c ON p.k = c.k""",
    "dates_shown": """SELECT o_orderkey, upper(strftime(o_orderdate, '%d %b')) AS short, CASE WHEN date_diff('day', o_orderdate::DATE, DATE '1996-06-01') > 30 THEN 'stale' ELSE 'fresh' END AS freshness,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2026-05-03' END AS reviewed_at FROM orders""",
}
