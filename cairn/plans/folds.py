"""Queries that fold runs and keep keys stable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import fold, keys
from ..session import table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with pos, a place within the order that no other line has."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    return table(spark, sf_dir, "lineitem").withColumn("pos", F.row_number().over(w))


def url_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    status = F.when(t == "purchase", "fetched").when(t == "error", "failed").when(t == "signup", "skipped_budget").otherwise("skipped_class_budget")
    rows = _events(spark, sf_dir).select(
        "user_id", F.to_date("ts").alias("day"), "seq", status.alias("status"), F.when((t == "purchase") & (F.col("event_id") % 5 != 0), F.col("event_id")).alias("resource"), F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("r"), F.col("event_id").cast("string"))).alias("skip_reason"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).alias("final_url"), F.when(F.col("event_id") % 4 != 0, t).alias("page_class"), F.lit("html").alias("kind"), (F.col("event_id") % 7).cast("int").alias("depth"), (F.col("event_id") % 11 == 0).alias("in_scope"),
    )
    return fold.urls(rows, ["user_id", "day"])


def answer_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    rows = _events(spark, sf_dir).select("user_id", F.to_date("ts").alias("day"), "seq", F.round("value", 6).alias("value"), F.when(t == "purchase", "answered").when(t == "signup", "not_disclosed").otherwise("unknown").alias("status"), "event_type")
    return rows.groupBy("user_id", "day").agg(
        fold.answer(F.col("value"), F.col("status"), F.col("seq")).alias("value"), fold.best_status(F.when(t == "purchase", "complete").when(t == "signup", "partial").when(t == "error", "failed").otherwise("unknown")).alias("status"),
        fold.first_filled(F.when(t != "view", t).otherwise(""), F.col("seq")).alias("tagline"), fold.forward_looking(F.when(t != "click", F.col("value")), F.col("seq")).alias("latest"),
    )


def best_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_orderpriority")
    s = F.when(p.startswith("1"), "complete").when(p.startswith("2"), "partial").when(p.startswith("3"), "needs_more_fetches").when(p.startswith("4"), "failed").otherwise("unknown")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(fold.best_status(s).alias("best"))


def product_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("l_orderkey", (F.col("l_partkey") % 5).alias("name"), "pos", (F.col("l_suppkey") % 3).alias("seq"), "l_quantity", "l_returnflag")
    out = fold.products(rows, ["l_orderkey"], "name", ["l_quantity", "l_returnflag"])
    return out.withColumn("position", F.col("position").cast("int"))


def request_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select(
        "user_id", F.get_json_object("props", "$.k").cast("int").alias("url"), "seq", F.col("event_type").alias("reason"), F.array(F.col("event_type"), F.concat(F.lit("x"), (F.col("event_id") % 3).cast("string"))).alias("expected_evidence"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("").alias("source_hint"), (F.col("event_id") % 5 == 0).alias("in_corpus_index"),
    )
    return fold.requests(rows, ["user_id", "url"]).withColumn("expected_evidence", F.array_join("expected_evidence", ","))


def provenance_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("l_orderkey", F.array("l_returnflag", "l_linestatus").alias("found"), "pos")
    return fold.ordered_union(rows, ["l_orderkey"], "found", "pos").select("l_orderkey", F.array_join("found", ",").alias("found"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    old = c.select("c_nationkey", "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") / 3).cast("int").alias("id"))
    now = c.where("c_custkey % 5 <> 0").select("c_nationkey", "c_custkey", "c_acctbal")
    return keys.stable_ids(old, now, ["c_nationkey"], "c_custkey", [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_nationkey", "c_custkey", F.col("id").cast("int").alias("id"))


def gap_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    letter = F.left("c_mktsegment", F.lit(1))
    used = c.select(letter.alias("letter"), (F.col("c_custkey") * 2).alias("serial"))
    new = c.select(letter.alias("letter"), "c_custkey")
    out = keys.gap_serials(used, new, "letter", [F.col("c_custkey")])
    return out.select("c_custkey", keys.designation(F.col("letter"), F.col("serial")).alias("designation"))


def slug_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.concat_ws("-", F.col("p_brand"), F.col("p_size").cast("string"))).alias("slug"), "p_type")
    return keys.resolve_collisions(p, "slug", F.lower("p_type"), [F.col("p_partkey")]).select("p_partkey", "slug")


def link_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", F.col("l_orderkey").alias("pos"))
    return fold.links(li.where("l_linenumber <= 2").unionByName(li), ["l_suppkey", "l_returnflag", "l_linestatus"])


def entry_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as crawl entries of a customer's run of a year, and as the resources there, some ids twice; some entries name none."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    corpus = [F.col("o_custkey").alias("target_id"), F.year("o_orderdate").alias("run_id")]
    rid = lambda n: F.concat(F.lit("resource-000"), (k % n).cast("string")).alias("resource_id")
    entries = o.select(*corpus, k.alias("url"), F.when(k % 4 != 0, F.concat(F.lit("resource-000"), F.floor(k / 8 % 3).cast("string"))).alias("resource_id"))
    resources = o.select(*corpus, rid(3), k.alias("pos"), F.col("o_totalprice").alias("chars"), F.col("o_orderstatus").alias("status"))
    out = fold.with_resources(entries, resources, ["target_id", "run_id"])
    return out.select("target_id", "run_id", "url", "resource_id", "resource.chars", "resource.status")


QUERIES = {f.__name__: f for f in (url_fold, answer_fold, best_status, product_union, request_dedupe, provenance_union, stable_ids, gap_serials, slug_collisions, link_union, entry_resources)}

_EVENTS = "e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)"
_LINES = "li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS pos FROM lineitem)"
ORACLES = {
    "url_fold": f"""WITH {_EVENTS}, r AS (SELECT user_id, ts::DATE AS day, seq, CASE event_type WHEN 'purchase' THEN 'fetched' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped_budget' ELSE 'skipped_class_budget' END AS status,
  CASE WHEN event_type = 'purchase' AND event_id % 5 <> 0 THEN event_id END AS resource, CASE WHEN event_id % 3 <> 0 THEN 'r' || event_id END AS skip_reason, CASE WHEN event_id % 2 = 0 THEN event_id::VARCHAR END AS final_url,
  CASE WHEN event_id % 4 <> 0 THEN event_type END AS page_class, 'html' AS kind, (event_id % 7)::INTEGER AS depth, event_id % 11 = 0 AS in_scope FROM e),
m AS (SELECT *, row_number() OVER w = 1 AS fst, lag(skip_reason) OVER w AS bef FROM r WINDOW w AS (PARTITION BY user_id, day ORDER BY seq))
SELECT user_id, day, arg_max(resource, seq) FILTER (resource IS NOT NULL) AS resource, CASE WHEN bool_or(status = 'fetched') THEN 'fetched' ELSE arg_max(status, seq) END AS status,
  CASE WHEN bool_or(status = 'fetched') THEN arg_min_null(CASE WHEN fst OR resource IS NULL THEN skip_reason ELSE bef END, seq) FILTER (status = 'fetched') ELSE arg_max_null(skip_reason, seq) END AS skip_reason,
  arg_max(final_url, seq) FILTER ((fst OR resource IS NOT NULL) AND final_url IS NOT NULL) AS final_url, arg_max(page_class, seq) FILTER ((fst OR resource IS NOT NULL) AND page_class IS NOT NULL) AS page_class,
  'html' AS kind, min(depth) AS depth, bool_or(in_scope) AS in_scope FROM m GROUP BY user_id, day""",
    "answer_fold": f"""WITH {_EVENTS}, r AS (SELECT user_id, ts::DATE AS day, seq, round(value, 6) AS value, event_type AS t FROM e)
SELECT user_id, day, coalesce(arg_max(value, seq) FILTER (t = 'purchase' AND value IS NOT NULL), arg_min(value, seq) FILTER (t = 'signup' AND value IS NOT NULL), arg_min_null(value, seq)) AS value,
  CASE max(CASE t WHEN 'purchase' THEN 4 WHEN 'signup' THEN 3 WHEN 'error' THEN 1 ELSE 0 END) WHEN 4 THEN 'complete' WHEN 3 THEN 'partial' WHEN 1 THEN 'failed' ELSE 'unknown' END AS status,
  arg_min(t, seq) FILTER (t <> 'view') AS tagline, arg_max(value, seq) FILTER (t <> 'click' AND value IS NOT NULL) AS latest FROM r GROUP BY user_id, day""",
    "best_status": """SELECT o_custkey, CASE max(CASE left(o_orderpriority, 1) WHEN '1' THEN 4 WHEN '2' THEN 3 WHEN '3' THEN 2 WHEN '4' THEN 1 ELSE 0 END)
  WHEN 4 THEN 'complete' WHEN 3 THEN 'partial' WHEN 2 THEN 'needs_more_fetches' WHEN 1 THEN 'failed' ELSE 'unknown' END AS best FROM orders GROUP BY o_custkey""",
    "product_union": f"""WITH {_LINES}, r AS (SELECT l_orderkey, l_partkey % 5 AS name, pos, l_suppkey % 3 AS seq, l_quantity, l_returnflag, count(DISTINCT l_suppkey % 3) OVER (PARTITION BY l_orderkey) AS runs FROM li),
g AS (SELECT l_orderkey, name, CASE WHEN runs = 1 THEN pos END AS own, arg_max(l_quantity, seq * 1000 + pos) AS l_quantity, arg_max(l_returnflag, seq * 1000 + pos) AS l_returnflag, min(seq * 1000 + pos) AS f FROM r GROUP BY ALL)
SELECT l_orderkey, name, l_quantity, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY f)::INTEGER AS position FROM g""",
    "request_dedupe": f"""WITH {_EVENTS}, r AS (SELECT user_id, (props->>'$.k')::INTEGER AS url, seq, event_type, event_id FROM e),
a AS (SELECT user_id, url, x, min(o) AS o FROM (SELECT user_id, url, event_type AS x, seq * 2 AS o FROM r UNION ALL SELECT user_id, url, 'x' || (event_id % 3), seq * 2 + 1 FROM r) GROUP BY ALL),
b AS (SELECT user_id, url, string_agg(x, ',' ORDER BY o) AS expected_evidence FROM a GROUP BY ALL)
SELECT user_id, url, arg_min(event_type, seq) AS reason, any_value(expected_evidence) AS expected_evidence, arg_min(event_type, seq) FILTER (event_id % 2 = 0) AS source_hint, bool_or(event_id % 5 = 0) AS in_corpus_index
FROM r JOIN b USING (user_id, url) GROUP BY user_id, url""",
    "provenance_union": f"""WITH {_LINES}, a AS (SELECT l_orderkey, x, min(o) AS o FROM (SELECT l_orderkey, l_returnflag AS x, pos * 2 AS o FROM li UNION ALL SELECT l_orderkey, l_linestatus, pos * 2 + 1 FROM li) GROUP BY ALL)
SELECT l_orderkey, string_agg(x, ',' ORDER BY o) AS found FROM a GROUP BY l_orderkey""",
    "stable_ids": """WITH o AS (SELECT c_nationkey, c_custkey, (c_custkey / 3)::INTEGER AS id FROM customer WHERE c_custkey % 3 = 0),
n AS (SELECT c.c_nationkey, c.c_custkey, c_acctbal, id, max(id) OVER (PARTITION BY c.c_nationkey) AS top FROM customer c LEFT JOIN o ON o.c_custkey = c.c_custkey WHERE c.c_custkey % 5 <> 0)
SELECT c_nationkey, c_custkey, coalesce(id, coalesce(top, 0) + row_number() OVER (PARTITION BY c_nationkey, id IS NULL ORDER BY c_acctbal DESC, c_custkey))::INTEGER AS id FROM n""",
    "gap_serials": """WITH u AS (SELECT left(c_mktsegment, 1) AS l, c_custkey * 2 AS s FROM customer),
n AS (SELECT left(c_mktsegment, 1) AS l, c_custkey, row_number() OVER (PARTITION BY left(c_mktsegment, 1) ORDER BY c_custkey) AS k FROM customer),
f AS (SELECT l, s, row_number() OVER (PARTITION BY l ORDER BY s) AS k FROM (SELECT DISTINCT n.l, g.s FROM (SELECT DISTINCT l FROM n) n, (SELECT unnest(range(1, (SELECT 2 * count(*) FROM customer) + 2)) AS s) g) c WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.l = c.l AND u.s = c.s))
SELECT c_custkey, n.l || '.' || lpad(s::VARCHAR, greatest(4, len(s::VARCHAR))::INTEGER, '0') AS designation FROM n JOIN f USING (l, k)""",
    "slug_collisions": """SELECT p_partkey, CASE WHEN rn > 1 THEN slug || '-' || lower(p_type) ELSE slug END AS slug FROM (
  SELECT p_partkey, p_type, lower(p_brand || '-' || p_size) AS slug, row_number() OVER (PARTITION BY lower(p_brand || '-' || p_size) ORDER BY p_partkey) AS rn FROM part)""",
    "entry_resources": """WITH o AS (SELECT o_custkey AS target_id, year(o_orderdate)::INTEGER AS run_id, o_orderkey AS url, CASE WHEN o_orderkey % 4 <> 0 THEN 'resource-000' || floor(o_orderkey / 8.0 % 3)::INTEGER END AS resource_id,
  'resource-000' || (o_orderkey % 3) AS own, o_totalprice AS chars, o_orderstatus AS status FROM orders),
r AS (SELECT target_id, run_id, own AS resource_id, arg_max(chars, url) AS chars, arg_max(status, url) AS status FROM o GROUP BY ALL)
SELECT o.target_id, o.run_id, o.url, o.resource_id, r.chars, r.status FROM o LEFT JOIN r ON r.target_id = o.target_id AND r.run_id = o.run_id AND r.resource_id = o.resource_id""",
    "link_union": "SELECT l_suppkey, l_returnflag, l_linestatus, min(l_orderkey) AS pos FROM lineitem GROUP BY ALL",
}
