"""Engine extras: general SQL operators over the star schema and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table


def _net_cents() -> F.Column:
    """Net price in whole cents, so that sums do not depend on their order."""
    return F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5).cast("long")


def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum(_net_cents()).alias("net_cents"), F.max("l_discount").alias("max_discount"), F.count("*").alias("n"))


def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o, c = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    s, n, r = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return j.groupBy("r_name", "n_name").agg(F.sum(_net_cents()).alias("net_cents"))


def rollup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.rollup(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def cube_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"), F.grouping_id().cast("int").alias("level"))


def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return c.intersect(o).withColumn("part", F.lit("both")).unionByName(c.exceptAll(o.distinct()).withColumn("part", F.lit("customers"))).unionByName(o.subtract(c.where("k % 2 = 0")).withColumn("part", F.lit("orders")))


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), "c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.rank().over(w).alias("rank"), F.ntile(4).over(w).alias("quartile"), F.lag("c_custkey").over(w).alias("before"), F.lead("c_custkey", 2).over(w).alias("after"), F.round(F.percent_rank().over(w), 6).alias("share"))


def range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("day", F.datediff(F.to_date("o_orderdate"), F.lit("1992-01-01")))
    w = Window.partitionBy("o_custkey").orderBy("day").rangeBetween(-90, 0)
    return o.select("o_orderkey", F.count("*").over(w).alias("orders_90d"), F.round(F.max("o_totalprice").over(w), 2).alias("largest"))


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    g = e.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    g = e.groupBy(F.window("ts", "2 days", "1 day").alias("w")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "users")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    g = e.groupBy(F.session_window("ts", "4 hours").alias("w"), "user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return g.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "first")


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the user's last event before it: one sort over the union of both, instead of a range join."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 150).alias("k"), F.dayofmonth("o_orderdate").alias("at"), F.col("o_orderkey"), F.lit(None).cast("long").alias("event_id"))
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 150).alias("k"), F.dayofmonth("ts").alias("at"), F.lit(None).cast("long").alias("o_orderkey"), "event_id")
    w = Window.partitionBy("k").orderBy("at", F.col("o_orderkey").isNotNull(), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    both = o.unionByName(e).withColumn("last_event", F.last("event_id", ignorenulls=True).over(w))
    return both.where("o_orderkey IS NOT NULL").select("o_orderkey", "last_event")


def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem").where("l_quantity >= 45")
    return p.join(li, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_brand")


def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)).alias("n")).na.fill(0)


QUERIES = {f.__name__: f for f in (pricing_summary, revenue_by_nation, rollup_orders, cube_lineitem, set_operations, ranking, range_frame, tumbling, sliding, sessions, as_of, anti_join, pivot_status)}

ORACLES = {
    "pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5)::BIGINT)::BIGINT AS net_cents, max(l_discount) AS max_discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
    "revenue_by_nation": """SELECT r_name, n_name, sum(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5)::BIGINT)::BIGINT AS net_cents FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
    "rollup_orders": "SELECT year(o_orderdate)::INTEGER AS year, o_orderstatus, count(*) AS n, grouping(year(o_orderdate), o_orderstatus)::INTEGER AS level FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)",
    "cube_lineitem": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, grouping(l_returnflag, l_linestatus)::INTEGER AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
    "set_operations": """SELECT k, 'both' AS part FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT k, 'customers' FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT k, 'orders' FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""",
    "ranking": """SELECT c_custkey, (rank() OVER w)::INTEGER AS rank, (ntile(4) OVER w)::INTEGER AS quartile, lag(c_custkey) OVER w AS before, lead(c_custkey, 2) OVER w AS after, round(percent_rank() OVER w, 6) AS share FROM customer
WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)""",
    "range_frame": "SELECT o_orderkey, count(*) OVER w AS orders_90d, round(max(o_totalprice) OVER w, 2) AS largest FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate::DATE RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW)",
    "tumbling": "SELECT strftime(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "sliding": "SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT user_id, date_trunc('day', ts) AS s FROM events UNION ALL SELECT user_id, date_trunc('day', ts) - INTERVAL 1 DAY FROM events) GROUP BY s",
    "sessions": """WITH a AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 4 HOURS THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM a)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, min(event_id) AS first FROM s GROUP BY user_id, g""",
    "as_of": """SELECT o_orderkey, last_event FROM (SELECT o_orderkey, last_value(event_id IGNORE NULLS) OVER (PARTITION BY k ORDER BY a, o_orderkey IS NOT NULL, event_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS last_event FROM (
  SELECT o_custkey % 150 AS k, day(o_orderdate) AS a, o_orderkey, NULL::BIGINT AS event_id FROM orders UNION ALL SELECT user_id % 150, day(ts), NULL, event_id FROM events)) WHERE o_orderkey IS NOT NULL""",
    "anti_join": "SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)",
    "pivot_status": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1",
}
