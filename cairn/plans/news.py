"""Queries of the news flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as d
from ..operators import news
from ..session import table

AS_OF = "2024-01-31"
#: Texts with and without dates, dealt to events by id.
TEXTS = (
    "Posted April 27, 2023 by staff", "27 Apr 2023", "on 2023-04-07, at noon", "4/27/2023", "27/4/2023", "Sept 5 2023 and 2022-01-01", "no date here", "June 31, 2023", "May 1, 2031", "12 December 2009 then 1/2/2021", "  March   3,\n2022", "2023-13-40",
)


def _as_of():
    return F.lit(AS_OF).cast("date")


def text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(x) for x in TEXTS]), (F.col("event_id") % len(TEXTS) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", d.in_text(text, _as_of()).alias("date"), d.strip_leading(text).alias("title"))


def news_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return news.first_seen(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "is_new")


def seen_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    seen = e.where(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz")).select("user_id", "event_type")
    return news.delta(e.where(F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz")).select("event_id", "user_id", "event_type"), seen, ["user_id", "event_type"]).select("event_id", "is_new")


def news_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("date", F.when(F.col("event_id") % 13 != 0, F.to_date("ts")))
    return news.recent(e, _as_of(), 10).groupBy("date", "event_type").agg(F.count("*").alias("items"), F.count_distinct("user_id").alias("users"), F.max("event_id").alias("last")).orderBy(F.desc("date"), F.desc("event_type"))


def news_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    items = o.select("o_orderkey", F.concat(F.lit("https://n/"), F.col("o_custkey").cast("string"), F.lit("/")).alias("url"))
    third = F.col("o_custkey") - F.col("o_custkey") % 3  # resources lie at every third customer, and at the next where they were redirected
    res = o.select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("https://n/"), third.cast("string")).alias("url"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://n/"), (third + 1).cast("string"), F.lit("/"))).alias("final_url"), F.col("o_orderpriority").alias("text"))
    return news.bundle(items, res)


def news_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    items = o.select("o_orderkey", F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("/")).alias("url"))
    res = o.select(F.when(F.col("o_orderkey") % 9 == 0, "fetched").otherwise("failed").alias("status"), F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("url"), F.lit(None).cast("string").alias("final_url"))
    return news.not_mirrored(items, res)


def repeat_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.repeats(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"), ["l_orderkey"])


def family_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("items"))
    g = docs.withColumn("family_rank", F.when(F.col("lang") == "es", 1).when(F.col("lang") == "fr", 2).when(F.col("lang") == "de", 3).otherwise(4))
    return news.rank_families(g, ["source"]).select("source", "lang", "items", F.col("rank").cast("int").alias("rank"))


def source_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.cohort(family_rank(spark, sf_dir).withColumnRenamed("lang", "family"))


QUERIES = {f.__name__: f for f in (text_date, news_delta, seen_set, news_digest, news_bundle, news_backlog, repeat_filter, family_rank, source_cohort)}

_T = "[" + ", ".join("'" + x.replace("\n", "' || chr(10) || '") + "'" for x in TEXTS) + "]"
_M = d.MONTHS.replace("(?:", "(")


def _month(c: str) -> str:
    return f"lpad(((instr('janfebmaraprmayjunjulaugsepoctnovdec', left(lower({c}), 3)) + 2) // 3)::VARCHAR, 2, '0')"


_FORM = (
    (rf"\b({d.MONTHS})\s+(\d{{1,2}}),?\s+(20\d{{2}})\b", "mo da ye"), (rf"\b(\d{{1,2}})\s+({d.MONTHS})\s+(20\d{{2}})\b", "da mo ye"),
    (r"\b(20\d{2})-(\d{1,2})-(\d{1,2})\b", "ye mo da"), (r"\b(\d{1,2})/(\d{1,2})/(20\d{2})\b", "mo da ye"),
)


def _form_sql(k: int) -> str:
    rx, names = _FORM[k]
    x = f"regexp_extract(flat, '(?i){rx}', [{', '.join(repr(n) for n in names.split())}])"
    if k < 2:
        body = f"x.ye || '-' || {_month('x.mo')} || '-' || lpad(x.da, 2, '0')"
    elif k == 2:
        body = "x.ye || '-' || lpad(x.mo, 2, '0') || '-' || lpad(x.da, 2, '0')"
    else:
        body = "CASE WHEN try_cast(x.mo AS INTEGER) <= 12 THEN x.ye || '-' || lpad(x.mo, 2, '0') || '-' || lpad(x.da, 2, '0') ELSE x.ye || '-' || lpad(x.da, 2, '0') || '-' || lpad(x.mo, 2, '0') END"
    return f"(SELECT CASE WHEN dd BETWEEN DATE '2010-01-01' AND DATE '2024-02-02' THEN dd END FROM (SELECT CASE WHEN x.ye <> '' THEN try_cast({body} AS DATE) END AS dd FROM (SELECT {x} AS x)))"


_HEAD = "|".join(f[2:] if f.startswith(r"\b") else f for f in d.FORMS)
ORACLES = {
    "text_date": rf"""WITH t AS (SELECT k, x, trim(regexp_replace(x, '\s+', ' ', 'g')) AS flat FROM (SELECT unnest({_T}) AS x, unnest(range({len(TEXTS)})) AS k)),
u AS (SELECT k, coalesce({', '.join(_form_sql(k) for k in range(4))}) AS date, regexp_replace(x, '(?i)^(?:{_HEAD})[ :\-—]*', '') AS title FROM t)
SELECT event_id, date, title FROM events JOIN u ON k = event_id % {len(TEXTS)}""",
    "news_delta": "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_new FROM events",
    "seen_set": "SELECT event_id, NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type = e.event_type AND s.ts < TIMESTAMP '2024-01-03') AS is_new FROM events e WHERE ts >= TIMESTAMP '2024-01-03'",
    "news_digest": f"SELECT ts::DATE AS date, event_type, count(*) AS items, count(DISTINCT user_id) AS users, max(event_id) AS last FROM events WHERE event_id % 13 <> 0 AND ts::DATE >= DATE '{AS_OF}' - 10 GROUP BY 1, 2",
    "news_bundle": """WITH r AS (SELECT u, arg_max(o_orderpriority, o_orderkey) AS x FROM (SELECT 'https://n/' || (o_custkey - o_custkey % 3) AS u, o_orderkey, o_orderpriority FROM orders
  UNION ALL SELECT 'https://n/' || (o_custkey - o_custkey % 3 + 1), o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0) GROUP BY u)
SELECT o_orderkey, 'https://n/' || o_custkey || '/' AS url, '==== https://n/' || o_custkey || '/ ====' || chr(10) || coalesce(x, 'NOT MIRRORED') AS section FROM orders LEFT JOIN r ON u = 'https://n/' || o_custkey""",
    "news_backlog": "SELECT o_orderkey, 'u' || o_custkey || '/' AS url FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey = o.o_custkey AND s.o_orderkey % 9 = 0)",
    "repeat_filter": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n <= 3",
    "family_rank": """WITH g AS (SELECT source, lang, count(*) AS items, CASE lang WHEN 'es' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 ELSE 4 END AS r FROM documents GROUP BY source, lang),
h AS (SELECT *, coalesce(min(r) FILTER (items >= 3) OVER (PARTITION BY source), min(r) OVER (PARTITION BY source)) AS b FROM g)
SELECT source, lang, items, row_number() OVER (PARTITION BY source ORDER BY (r = b) DESC, r)::INTEGER AS rank FROM h""",
    "source_cohort": """WITH g AS (SELECT source, lang, count(*) AS items, CASE lang WHEN 'es' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 ELSE 4 END AS r FROM documents GROUP BY source, lang),
h AS (SELECT *, coalesce(min(r) FILTER (items >= 3) OVER (PARTITION BY source), min(r) OVER (PARTITION BY source)) AS b FROM g)
SELECT lang AS family, count(*) AS vendors FROM h WHERE r = b GROUP BY lang""",
}
