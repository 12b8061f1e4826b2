"""Queries over citations and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import cite
from ..session import table


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("doc_id") % 4).cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", start.alias("line_start"), (start + F.col("doc_id") % 3).cast("int").alias("line_end"))


def citation_hydrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.hydrate(_citations(spark, sf_dir), table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("text")), ["doc_id"])


def citation_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    recorded = d.select((F.col("doc_id") + F.when(F.col("doc_id") % 2 == 0, 0).otherwise(1)).alias("doc_id"), F.split("text", "\n").alias("_l")).groupBy("doc_id").agg(F.max(F.get("_l", F.lit(0))).alias("recorded"))
    c = d.select("doc_id", F.lit(1).alias("line_start"), F.lit(1).alias("line_end")).join(recorded, "doc_id", "left")
    return cite.drift(cite.hydrate(c, d, ["doc_id"]), refuse=True).select("doc_id", "drifted", "rewritten", "problem")


def citation_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 3).alias("run_id"), F.lit(1).alias("target_id"), t.resource_id(F.col("o_custkey")).alias("resource_id"))
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    url = F.when(k % 7 != 0, F.concat(F.lit("u"), k.cast("string")))
    id_to_url = c.select(F.explode(F.array(*[F.lit(k).cast("long") for k in range(3)])).alias("run_id"), t.resource_id(k).alias("resource_id"), url.alias("url"))
    url_to_id = c.select(F.lit(1).alias("target_id"), url.alias("url"), F.when(k % 5 != 0, k + k % 2).alias("canonical_id"))
    return cite.remap(o, id_to_url, url_to_id, ["run_id"], ["target_id"]).select("o_orderkey", "resource_id", "url", "new_id", "outcome")


def remap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cite.report(citation_remap(spark, sf_dir).withColumn("batch", F.col("o_orderkey") % 10), ["batch"])


def request_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("url"), (F.col("o_orderkey") % 2 == 0).alias("in_corpus_index"))
    i = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("url"), F.when(F.col("c_nationkey") < 10, "fetched").otherwise("skipped_budget").alias("status"))
    return cite.request_violations(r, i, []).select("o_orderkey", "violation")


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rules = {
        "locator": cite.locator_ok(F.col("l_linenumber"), F.col("l_quantity") / 10), "score_range": F.col("l_quantity").between(1, 45), "returned_has_discount": (F.col("l_returnflag") != "R") | (F.col("l_discount") > 0.02),
        "tax_known": F.nullif("l_tax", F.lit(0.0)).isNotNull(),
    }
    return cite.violations(li, [F.col("l_orderkey"), F.col("l_linenumber")], rules)


def list_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_returnflag") == "R").alias("flags"), F.min(F.when(F.col("l_linestatus") == "O", "answered").otherwise("unknown")).alias("status"))
    return cite.violations(g, [F.col("l_orderkey")], {"one_primary": cite.one_primary(F.col("status"), F.col("flags")), "has_evidence": cite.answered_has_evidence(F.col("status"), F.col("flags"))})


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    x = F.col("text")
    return c.select(
        "conv_id", "turn", t.markdown_to_text(x).alias("plain"), t.truncate_words(x, 12).alias("short"), t.word_count(x).alias("words"), t.slugify(x, 20).alias("slug"), t.title_label(F.concat_ws("_", "role", F.lit("turn-name"))).alias("label"),
        t.collapse(x).alias("flat"), t.search_string(F.col("role"), F.lit(""), x).alias("search"),
    )


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.sha1("url").alias("cache_key"), F.sha2("html", 256).alias("sha256"), F.sha2(F.concat_ws("|", F.col("page_id").cast("string"), F.col("url")), 256).alias("policy_hash"))


QUERIES = {f.__name__: f for f in (citation_hydrate, citation_drift, citation_remap, remap_report, request_violations, constraint_violations, list_constraints, text_functions, hashes)}

_WS = r"list_filter(regexp_split_to_array(coalesce(@, ''), '\s+'), lambda w: w <> '')"
_SNIP = "CASE WHEN line_start >= 1 AND line_end >= line_start AND line_end <= len(string_split(x, chr(10))) THEN array_to_string(string_split(x, chr(10))[line_start:line_end], chr(10)) END"
_REMAP = """r AS (SELECT o_orderkey, 'resource-' || lpad(o_custkey::VARCHAR, greatest(4, len(o_custkey::VARCHAR))::INTEGER, '0') AS resource_id, CASE WHEN c_custkey % 7 <> 0 THEN 'u' || c_custkey END AS url,
  CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 1 END END AS cid FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
s AS (SELECT o_orderkey, resource_id, url, 'resource-' || lpad(cid::VARCHAR, greatest(4, len(cid::VARCHAR))::INTEGER, '0') AS new_id FROM r),
m AS (SELECT *, CASE WHEN url IS NULL THEN 'unknown_resource' WHEN new_id IS NULL THEN 'url_not_canonical' WHEN resource_id = new_id THEN 'already_canonical' ELSE 'migrated' END AS outcome FROM s)"""
ORACLES = {
    "citation_hydrate": f"""WITH c AS (SELECT doc_id, (doc_id % 4)::INTEGER AS line_start, (doc_id % 4 + doc_id % 3)::INTEGER AS line_end, CASE WHEN doc_id % 11 <> 0 THEN text END AS x FROM documents),
s AS (SELECT *, {_SNIP} AS snippet FROM c), w AS (SELECT *, CASE WHEN snippet IS NOT NULL THEN len({_WS.replace('@', 'snippet')})::INTEGER END AS words FROM s)
SELECT doc_id, line_start, line_end, snippet, words, CASE WHEN x IS NULL THEN 'missing_text' WHEN snippet IS NULL THEN 'out_of_range' WHEN words = 0 THEN 'empty' WHEN words > 60 THEN 'too_long' END AS problem FROM w""",
    "citation_drift": f"""WITH d AS (SELECT doc_id, string_split(text, chr(10))[1] AS f FROM documents),
r AS (SELECT doc_id + CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS doc_id, max(f) AS recorded FROM d GROUP BY 1),
j AS (SELECT d.doc_id, f, recorded, len({_WS.replace('@', 'f')}) AS n FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, f IS DISTINCT FROM recorded AS drifted, f IS NOT DISTINCT FROM recorded AS rewritten, CASE WHEN n = 0 THEN 'empty' WHEN n > 60 THEN 'too_long' END AS problem FROM j""",
    "citation_remap": f"WITH {_REMAP} SELECT * FROM m",
    "remap_report": f"""WITH {_REMAP} SELECT o_orderkey % 10 AS batch, count(*) AS citations, count(*) FILTER (outcome = 'migrated') AS migrated, count(*) FILTER (outcome = 'already_canonical') AS already_canonical,
  count(*) FILTER (outcome = 'url_not_canonical') AS url_not_canonical, count(*) FILTER (outcome = 'unknown_resource') AS unknown_resource FROM m GROUP BY 1""",
    "request_violations": """SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND c_custkey IS NULL THEN 'not_in_index' WHEN o_orderkey % 2 <> 0 AND c_custkey IS NOT NULL THEN 'unmarked_in_index' WHEN c_nationkey < 10 THEN 'already_fetched' END AS violation
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey) WHERE violation IS NOT NULL""",
    "constraint_violations": """SELECT l_orderkey, l_linenumber, unnest(list_filter([CASE WHEN NOT (l_linenumber >= 1 AND l_quantity / 10 >= l_linenumber) THEN 'locator' END, CASE WHEN NOT l_quantity BETWEEN 1 AND 45 THEN 'score_range' END,
  CASE WHEN l_returnflag = 'R' AND NOT l_discount > 0.02 THEN 'returned_has_discount' END, CASE WHEN l_tax = 0 THEN 'tax_known' END], lambda x: x IS NOT NULL)) AS violation FROM lineitem""",
    "list_constraints": "SELECT l_orderkey, 'one_primary' AS violation FROM lineitem GROUP BY l_orderkey HAVING min(CASE WHEN l_linestatus = 'O' THEN 'answered' ELSE 'unknown' END) = 'answered' AND count(*) FILTER (l_returnflag = 'R') <> 1",
    "text_functions": rf"""SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '\s+$', '')), lambda x: trim(x) <> ''), chr(10)) AS plain,
  CASE WHEN len({_WS.replace('@', 'text')}) > 12 THEN rtrim(array_to_string(({_WS.replace('@', 'text')})[1:12], ' '), ',.;:') || '…' ELSE text END AS short, len({_WS.replace('@', 'text')})::INTEGER AS words,
  coalesce(nullif(left(lower(trim(regexp_replace(text, '[^A-Za-z0-9]+', '-', 'g'), '-')), 20), ''), 'item') AS slug, upper(left(role, 1)) || substring(role, 2) || ' Turn Name' AS label,
  trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat, lower(role || ' ' || text) AS search FROM conversations""",
    "hashes": "SELECT page_id, sha1(url) AS cache_key, sha256(html) AS sha256, sha256(page_id || '|' || url) AS policy_hash FROM pages",
}
