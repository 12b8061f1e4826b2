"""Queries of final documents, digests, envelopes, newsletter state and nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import url as u
from ..operators import cite, documents, facets, journal, news, quality, registry
from ..session import table
from ..sources import readers

AS_OF = "2024-01-31"
#: Date values in free forms, dealt to events by id, and the dates they stand for.
FREE = (
    ("2023/04/15", "2023-04-15"), ("20230415", "2023-04-15"), ("Sat, 15 Apr 2023 08:30:00 GMT", "2023-04-15"), ("2023-04-15T23:30:00+02:00", "2023-04-15"), ("15.04.2023", "2023-04-15"), ("on the 5th of May, 2023 by staff", "2023-05-05"),
    ("nothing of the kind", None), ("2009-05-05", None), ("3 June 2031", None), ("", None), ("Tuesday 2 May 2023 at noon", "2023-05-02"), ("April 9, 2023", "2023-04-09"), ("12/25/2022 10:00", "2022-12-25"), (None, None),
)


def _as_of():
    return F.lit(AS_OF).cast("date")


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def free_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.element_at(F.array(*[F.lit(x) for x, _ in FREE]), (F.col("event_id") % len(FREE) + 1).cast("int"))
    return d.with_free_date(table(spark, sf_dir, "events").select("event_id", value.alias("value")), "value", _as_of()).select("event_id", "date")


def jsonld_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page lists itself in a list inside a graph, and one of fifty shared URLs in a graph inside a graph."""
    p = F.col("page_id")
    own = _text('[[{"url":"https://j/', p, '","datePublished":"2023-0', p % 9 + 1, '-15"}]]')
    shared = _text('{"@graph":[{"@graph":[{"url":{"odd":1},"datePublished":"2023-01-01"},{"@id":"https://j/', p % 50, 's","dateCreated":"2023-02-', F.lpad((p % 28 + 1).cast("string"), 2, "0"), 'T08:00:00Z"}]}]}')
    html = _text('<p>x</p><script type="application/ld+json">{"@graph":', own, '}</script><script type="application/ld+json">', shared, '</script><script type="application/ld+json">{broken</script>')
    return news.jsonld_dates(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), _as_of(), order=p)


def dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date from JSON-LD where there is one, else from the URL, else from the text beside it."""
    p = F.col("page_id")
    url = F.when(p % 3 == 0, _text("https://j/", p)).when(p % 3 == 1, _text("https://j/2023/0", p % 9 + 1, "/x")).otherwise("https://j/plain")
    items = table(spark, sf_dir, "pages").select("page_id", url.alias("url"), F.when(p % 2 == 0, "Posted May 5, 2023").alias("date_text"))
    return news.with_dates(items, jsonld_dates(spark, sf_dir), _as_of()).select("page_id", "date")


def _poll(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each user's events of the last days as items, those before as what the state has seen."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), F.concat("event_type", (F.col("event_id") % 5).cast("string")).alias("url"), F.to_date("ts").alias("date"), "ts", F.col("ts").cast("date").alias("day"))
    old = e.where("day < DATE'2024-01-10'").groupBy("slug").agg(F.sort_array(F.collect_set("url")).alias("seen_urls"), F.count("*").cast("int").alias("polls_completed"), F.max("day").alias("last_polled_at"))
    new = e.where("day >= DATE'2024-01-10'").groupBy("slug", "url").agg(F.max("date").alias("date"))
    return old, new


def newsletter_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = news.merge_state(*_poll(spark, sf_dir), _as_of())
    return state.select("slug", F.array_join("seen_urls", ",").alias("seen_urls"), "polls_completed", "last_polled_at")


def newsletter_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _poll(spark, sf_dir)
    first = F.map_from_arrays("seen_urls", F.transform("seen_urls", lambda x: F.date_sub("last_polled_at", F.length(x))))
    _, rendered = news.merge_state(old.withColumn("first_seen", first), new, _as_of(), strict=True)
    return rendered.select("slug", "url", "date", "is_new", "first_seen_at", "place")


def _titles(content: str, source: str) -> list[tuple[str, str]]:
    if "7" in content:
        raise ValueError("a seven")
    return [(f"i{len(content)}", content), (source, content)]


def poll_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    pages = o.select(F.col("o_custkey").alias("slug"), _text("s", F.col("o_orderkey")).alias("source_url"), F.col("o_orderkey").alias("source_pos"), (F.col("o_orderkey") % 5 != 0).alias("ok"), F.when(F.col("o_orderkey") % 10 == 0, "timeout").alias("message"), F.col("o_orderkey").cast("string").alias("content"))
    items, errors = news.poll(pages, _titles)
    return items.select("slug", "url", "source_url", F.lit(None).cast("string").alias("error")).unionByName(errors.select("slug", F.lit(None).cast("string").alias("url"), "source_url", "error"))


def accumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(F.col("event_id") % 11 == 0, "finalize").otherwise("item").alias("event"), (F.col("event_type") != "error").alias("valid"), F.when(F.col("event_id") % 2 == 0, "complete").otherwise("partial").alias("status"))
    return journal.accumulated(e, ["user_id"], ["ts", "event_id"])[1]


def homepage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(k % 4 == 0, "resource-0001").otherwise("resource-0002").alias("resource_id"), F.when(F.col("o_orderpriority").startswith("1"), "homepage").otherwise("other").alias("page_class"),
        F.when(F.col("o_orderstatus") == "F", "fetched").otherwise("failed").alias("status"), k.alias("pos"), F.when(k % 3 != 0, _text(F.col("o_orderpriority"), " ", k)).alias("text"),
    )
    return documents.homepage_text(rows, ["o_custkey"])


def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("target_id"), F.col("c_name").alias("display_name"), F.lit("https://h").alias("homepage_url"), F.lit("r1").alias("run_id"), F.lit("/c").alias("corpus_root"), F.lit("complete").alias("quality_status"), (F.col("c_custkey") * 10).alias("total_text_chars"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("target_id"), F.when(F.col("o_orderstatus") == "F", "fetched").otherwise("skipped_budget").alias("status"), F.when(F.col("o_orderkey") % 6 != 0, "r").alias("resource_id"), F.when(F.col("o_orderkey") % 5 != 0, F.lower(F.left("o_orderpriority", F.lit(1)))).alias("page_class"))
    return documents.corpus_summary(c, o)


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    value = lambda c: F.struct(c.alias("value"))
    cats = F.array(*[F.struct(F.lit(f"cat{j}").alias("category"), (k % 4 == j).alias("is_primary")) for j in range(3)])
    named = F.transform(F.sequence(F.lit(1), (k % 12 + 1).cast("int")), lambda x: F.struct(F.concat(F.lit("p"), x.cast("string")).alias("name")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("display_name"), value(F.when(k % 5 != 0, F.col("c_mktsegment"))).alias("drone_supply_chain_role"), F.struct(cats.alias("items")).alias("products_categories"),
        F.struct(F.when(k % 7 != 0, F.struct(F.when(k % 2 == 0, "Oslo").alias("city"), F.lit("").alias("state_or_province"), F.when(k % 3 == 0, F.col("c_nationkey").cast("string")).alias("country"))).alias("value")).alias("headquarters"),
        F.struct(F.when(k % 13 != 0, F.slice(named, 2, 20)).alias("items")).alias("products"), value(F.when(k % 2 == 0, "compliant")).alias("ndaa"), value(F.lit("")).alias("blue_uas"), value(F.lit("production")).alias("readiness"),
    )


def profile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).select("c_custkey", documents.profile_digest().alias("digest"), documents.vendor_context().alias("full"), documents.vendor_context(False).alias("brief"))


def products_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    one = F.struct(k.alias("k"), _text("n", k).alias("name"), F.col("p_brand").alias("category"), F.when(k % 2 == 0, "sku").alias("granularity"), F.lit("production").alias("readiness"), F.lit("d").alias("descriptor"), F.when(k % 3 == 0, "unknown").when(k % 3 == 1, "compliant").alias("ndaa"), F.when(k % 5 == 0, "listed").alias("blue_uas"))
    return p.groupBy("p_size").agg(F.sort_array(F.collect_list(one)).alias("products")).select("p_size", documents.products_digest(F.col("products")).alias("digest"))


def final_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority lists of three orders each, under their customers' metadata."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("target_id")).agg(F.sort_array(F.collect_list("o_orderkey")).alias("products"), F.max("o_orderpriority").alias("notes"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target_id"), F.lit("r").alias("run_id"), F.col("c_name").alias("display_name"), F.lit("h").alias("homepage_url"), F.lit("/c").alias("corpus_root"), F.struct(F.col("c_nationkey").alias("turns")).alias("meta"))
    out = documents.priorities(o, c, 3)
    return out.select("target_id", "run_id", "display_name", "homepage_url", "corpus_root", F.concat_ws(",", F.transform("products", lambda x: x.cast("string"))).alias("products"), "agent_listed", "max_products", "status", "notes", F.col("meta.turns").alias("turns"))


def _depth():
    """0 to 10 levels; one event in 500 has up to 490."""
    return (F.when(F.col("event_id") % 500 == 0, F.floor(F.col("value") * 100) % 491).otherwise(F.floor("value") % 11)).cast("int")


def citations_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations as deep as an event's value says: most shallow, those of the greatest values hundreds of levels."""
    k = F.col("event_id")
    n = _depth()
    raw = F.concat(F.repeat(F.lit('{"x":"]}","a":['), n), _text('{"b":{"resource_id":"resource-', k, '","line_start":', k % 7, "}}"), F.repeat(F.lit("]}"), n))
    # The small rows of a few files become large documents here, so they are dealt over all cores first.
    events = table(spark, sf_dir, "events").select("event_id", "value").repartition(4 * spark.sparkContext.defaultParallelism)
    return readers.citations(events.select("event_id", raw.alias("raw")), "raw", ["event_id"]).select("event_id", "at", "resource_id", "line_start")


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    raw = F.when(k % 5 == 0, "[1]").when(k % 5 == 1, "{broken").otherwise(_text('{"ok":', F.when(k % 2 == 0, "true").otherwise("false"), ',"statusCode":', k % 600, ',"content":"c', k, '","links":["https://a/', k, '","x"],"message":null}'))
    out = readers.scrapes(table(spark, sf_dir, "pages").select("page_id", raw.alias("raw")))
    return out.select("page_id", "ok", "status_code", "content", "message", F.array_join("links", " ").alias("links"))


def site_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    raw = F.when(k % 5 == 0, '{"links":3}').otherwise(_text('{"links":["https://a/', k, '",{"url":"http://b/', k, '"},"ftp://c","https://a/', k, '",5,{"x":1}]}'))
    return readers.site_map(table(spark, sf_dir, "pages").select("page_id", raw.alias("raw"))).select("page_id", F.array_join("urls", " ").alias("urls"))


def preflights(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("homepage_url"))
    answers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("url"), F.when(F.col("c_custkey") % 3 == 0, _text("https://f/", F.col("c_custkey"))).alias("final_url"), (F.col("c_custkey") % 500).cast("int").alias("status_code"), F.lit("text/html").alias("content_type"), F.when(F.col("c_custkey") % 3 == 1, "refused").alias("error"))
    return readers.preflights(c, answers).select("c_custkey", "final_url", "status_code", "error")


def sector_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ("MACHINERY", "AUTOMOBILE", "BUILDING")
    domains = F.array(F.lit("ugv"), F.when(F.col("c_custkey") % 2 == 0, "boat").otherwise("uav"), F.lit("uuv"))
    return table(spark, sf_dir, "customer").select("c_custkey", facets.listed_order(F.col("c_mktsegment"), order).cast("int").alias("place"), F.array_join(facets.valid_domains(domains), ",").alias("domains"))


def citation_remap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cite resources in the run of their year; each run numbers the same URLs in its own way."""
    o = table(spark, sf_dir, "orders")
    run, target = F.year("o_orderdate").cast("string"), F.col("o_custkey")
    c = o.select(target.alias("target_id"), run.alias("run_id"), _text("resource-", F.col("o_orderkey") % 3).alias("resource_id"), "o_orderkey")
    corpora = o.select(target.alias("target_id"), run.alias("run_id"), F.year("o_orderdate").alias("seq")).distinct()
    index = corpora.select("target_id", "run_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n"), "seq").select("target_id", "run_id", _text("resource-", F.col("n")).alias("resource_id"), _text("u", (F.col("n") + F.col("seq")) % 4).alias("url"))
    canonical = corpora.select("target_id").distinct().select("target_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n")).select("target_id", _text("u", F.col("n")).alias("url"), F.col("n").alias("canonical_id"))
    a = cite.remap_runs(c, corpora, index, canonical).select("o_orderkey", F.col("url").alias("by_oldest"), F.col("outcome").alias("outcome_oldest"))
    b = cite.remap_runs(c, corpora, index, canonical, strict=True).select("o_orderkey", F.col("url").alias("by_own"), F.col("outcome").alias("outcome_own"))
    return a.join(b, "o_orderkey")


def url_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("urls"))
    return quality.url_totals(rows, "urls").select(F.col("most").cast("long").alias("most"), "total")


def manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("resources"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    q = F.struct(F.lit("complete").alias("status"), (F.col("c_custkey") % 9).alias("browserless_calls_used"), F.lit(9).alias("browserless_call_budget"), (F.col("c_custkey") % 9 == 8).alias("budget_exhausted"))
    rows = c.select(F.col("c_custkey").alias("target_id"), F.col("c_name").alias("display_name"), "resources", q.alias("quality"), F.lit("m.json").alias("manifest_path"), F.lit("q.json").alias("quality_report_path"), F.lit("mirrored").alias("disposition"), F.when(F.col("c_custkey") % 2 == 0, "r0").alias("covered_by_run_id"))
    return registry.manifest_entry(rows)


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit(r'href\s*=\s*"([^"]*)"'), F.lit(1)).alias("links"), "url")
    edges = readers.link_edges(pages, ["page_id"])
    return edges.groupBy("page_id").agg(F.count("*").alias("n"), F.min(u.join_homepage(F.lit("https://h.example/x"), F.col("target_url"))).alias("least"))


QUERIES = {
    f.__name__: f
    for f in (
        free_dates, jsonld_dates, dated_items, newsletter_state, newsletter_items, poll_isolated, accumulated, homepage_text, corpus_summary, profile_digest, products_digest, final_documents, citations_walk,
        scrapes, site_maps, preflights, sector_order, citation_remap_runs, url_totals, manifest_entries, link_edges,
    )
}

_FREE = "CASE event_id % " + str(len(FREE)) + " " + " ".join(f"WHEN {k} THEN DATE '{day}'" for k, (_, day) in enumerate(FREE) if day) + " END"
_LD = """ld AS (SELECT 'https://j/' || page_id AS url, make_date(2023, (page_id % 9 + 1)::INTEGER, 15) AS date FROM pages
UNION ALL SELECT 'https://j/' || (page_id % 50) || 's', make_date(2023, 2, (arg_max(page_id, page_id) % 28 + 1)::INTEGER) FROM pages GROUP BY page_id % 50)"""
_ITEMS = """e AS (SELECT user_id AS slug, event_type || (event_id % 5) AS url, ts::DATE AS day FROM events),
old AS (SELECT slug, list_sort(list(DISTINCT url)) AS seen, count(*)::INTEGER AS polls, max(day) AS last FROM e WHERE day < DATE '2024-01-10' GROUP BY slug),
new AS (SELECT slug, url, max(day) AS date FROM e WHERE day >= DATE '2024-01-10' GROUP BY slug, url)"""
_CAT = "list_filter([CASE WHEN c_custkey % 4 {0} 0 THEN 'cat0' END, CASE WHEN c_custkey % 4 {0} 1 THEN 'cat1' END, CASE WHEN c_custkey % 4 {0} 2 THEN 'cat2' END], lambda x: x IS NOT NULL)"
ORACLES = {
    "free_dates": f"SELECT event_id, {_FREE} AS date FROM events",
    "jsonld_dates": f"WITH {_LD} SELECT * FROM ld",
    "dated_items": f"""WITH {_LD}, i AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://j/' || page_id END AS url FROM pages)
SELECT page_id, coalesce(ld.date, CASE WHEN page_id % 3 = 1 THEN make_date(2023, (page_id % 9 + 1)::INTEGER, 1) END, CASE WHEN page_id % 2 = 0 THEN DATE '2023-05-05' END) AS date FROM i LEFT JOIN ld USING (url)""",
    "newsletter_state": f"""WITH {_ITEMS}, n AS (SELECT slug, list(url) AS urls FROM new GROUP BY slug)
SELECT coalesce(old.slug, n.slug) AS slug, array_to_string(list_sort(list_distinct(list_concat(coalesce(seen, []), coalesce(urls, [])))), ',') AS seen_urls,
  (coalesce(polls, 0) + CASE WHEN urls IS NULL THEN 0 ELSE 1 END)::INTEGER AS polls_completed, CASE WHEN urls IS NULL THEN last ELSE DATE '{AS_OF}' END AS last_polled_at FROM old FULL JOIN n ON old.slug = n.slug""",
    "newsletter_items": f"""WITH {_ITEMS}
SELECT new.slug, url, date, NOT coalesce(list_contains(seen, url), false) AS is_new, CASE WHEN list_contains(seen, url) THEN last - len(url)::INTEGER ELSE DATE '{AS_OF}' END AS first_seen_at,
  row_number() OVER (PARTITION BY new.slug ORDER BY date DESC, url DESC)::INTEGER AS place FROM new LEFT JOIN old ON old.slug = new.slug""",
    "poll_isolated": """WITH o AS (SELECT o_custkey AS slug, 's' || o_orderkey AS s, o_orderkey AS k, o_orderkey::VARCHAR AS c FROM orders),
g AS (SELECT * FROM o WHERE k % 5 <> 0 AND NOT contains(c, '7')),
i AS (SELECT slug, 'i' || len(c) AS url, s, k FROM g UNION ALL SELECT slug, s, s, k FROM g)
SELECT slug, url, arg_min(s, k) AS source_url, NULL::VARCHAR AS error FROM i GROUP BY slug, url
UNION ALL SELECT slug, NULL, s, CASE WHEN k % 10 = 0 THEN 'timeout' WHEN k % 5 = 0 THEN 'no content' ELSE 'parse error: ValueError: a seven' END FROM o WHERE k % 5 = 0 OR contains(c, '7')""",
    "accumulated": """WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT user_id, min(n) AS e, arg_min(CASE WHEN event_id % 2 = 0 THEN 'complete' ELSE 'partial' END, n) AS s FROM a WHERE event_id % 11 = 0 AND event_type <> 'error' GROUP BY user_id)
SELECT user_id, count(*) FILTER (event_id % 11 <> 0 AND event_type <> 'error' AND (e IS NULL OR n < e)) AS items, coalesce(min(s), 'failed') AS status FROM a LEFT JOIN f USING (user_id) GROUP BY user_id""",
    "homepage_text": """WITH r AS (SELECT o_custkey, o_orderkey AS k, o_orderstatus = 'F' AND starts_with(o_orderpriority, '1') AS home, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority || ' ' || o_orderkey END AS t FROM orders)
SELECT o_custkey, coalesce(arg_min(t, k) FILTER (home AND t IS NOT NULL), arg_min(t, k) FILTER (k % 4 = 0 AND t IS NOT NULL), '') AS text FROM r GROUP BY o_custkey""",
    "corpus_summary": """WITH i AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 6 <> 0 THEN CASE WHEN o_orderkey % 5 <> 0 THEN left(o_orderpriority, 1) ELSE 'other' END END AS c FROM orders),
n AS (SELECT o_custkey, count(c) AS got, count(*) - count(c) AS rest FROM i GROUP BY 1), k AS (SELECT o_custkey, c, count(*) AS n FROM i WHERE c IS NOT NULL GROUP BY 1, 2), s AS (SELECT o_custkey, string_agg(c || '=' || n, ', ' ORDER BY c) AS s FROM k GROUP BY 1)
SELECT c_custkey::VARCHAR AS target_id, concat_ws(chr(10), 'Vendor: ' || c_name, 'target_id: ' || c_custkey, 'homepage_url: https://h', 'run_id: r1', 'corpus_root: /c', '',
  'Mirror coverage: status=complete, total_text_chars=' || (c_custkey * 10) || ', fetched_pages=' || coalesce(got, 0) || ', skipped_or_failed=' || coalesce(rest, 0) || '.', 'Fetched page_classes: ' || coalesce(s, '(none)') || '.', '',
  'Read crawl_index.json to see exactly which URLs were fetched vs skipped, then read the relevant text/ files. Submit a single `submit_profile` call when done.') AS prompt
FROM customer LEFT JOIN n ON n.o_custkey = c_custkey LEFT JOIN s ON s.o_custkey = c_custkey""",
    "profile_digest": f"""WITH p AS (SELECT *, {_CAT.format('=')}[1] AS prim, array_to_string({_CAT.format('<>')}, ', ') AS sec, CASE WHEN c_custkey % 13 <> 0 THEN list_transform(range(2, c_custkey % 12 + 2), lambda x: 'p' || x) ELSE [] END AS names,
  CASE WHEN c_custkey % 7 <> 0 THEN concat_ws(', ', CASE WHEN c_custkey % 2 = 0 THEN 'Oslo' END, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey::VARCHAR END) ELSE '' END AS hq, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS role FROM customer),
q AS (SELECT *, CASE WHEN sec <> '' THEN ' (also: ' || sec || ')' ELSE '' END AS also, array_to_string(names[1:8], ', ') AS n8, array_to_string(names[1:10], ', ') AS n10 FROM p)
SELECT c_custkey, concat_ws(chr(10), '  display_name: ' || c_name, '  role: ' || coalesce(role, 'unknown'), '  primary category: ' || coalesce(prim, '(none)') || also, '  hq: ' || CASE WHEN hq = '' THEN 'unknown' ELSE hq END,
  '  ndaa: ' || CASE WHEN c_custkey % 2 = 0 THEN 'compliant' ELSE 'unknown' END, '  blue_uas: unknown', '  readiness: production', '  vendor-pass-named products: ' || CASE WHEN n8 = '' THEN '(none enumerated)' ELSE n8 END, '') AS digest,
  concat_ws(chr(10), '', '', 'VENDOR-PASS CONTEXT (from existing profile.json):', '  role: ' || coalesce(role, '(unknown)'), '  primary category: ' || coalesce(prim, '(no primary)') || also,
  '  ' || CASE WHEN n10 = '' THEN 'Vendor pass did not enumerate any products.' ELSE 'Vendor pass already named these products: ' || n10 END, '',
  'Treat this as a hint, not ground truth. Re-derive products from the corpus; you may find more (or fewer) SKUs than the vendor pass listed.', '') AS "full",
  concat_ws(chr(10), '', '', 'VENDOR-PASS CONTEXT:', '  role: ' || coalesce(role, '(unknown)'), '  primary category: ' || coalesce(prim, '(no primary)'), '') AS brief FROM q""",
    "products_digest": """WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n, count(*) OVER (PARTITION BY p_size) AS c, p_partkey AS k FROM part),
l AS (SELECT *, concat_ws(', ', CASE WHEN k % 3 = 1 THEN 'NDAA=compliant' END, CASE WHEN k % 5 = 0 THEN 'BlueUAS=listed' END) AS m FROM p WHERE n <= 20)
SELECT p_size, string_agg('  - n' || k || ' (' || p_brand || '/' || CASE WHEN k % 2 = 0 THEN 'sku' ELSE 'None' END || '/production) — d' || CASE WHEN m <> '' THEN ' [' || m || ']' ELSE '' END, chr(10) ORDER BY n)
  || CASE WHEN max(c) > 20 THEN chr(10) || '  ... and ' || (max(c) - 20) || ' more' ELSE '' END AS digest FROM l GROUP BY p_size""",
    "final_documents": """WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
g AS (SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY n) FILTER (n <= 3) AS products, count(*)::INTEGER AS agent_listed, max(o_orderpriority) AS notes FROM o GROUP BY 1)
SELECT o_custkey AS target_id, 'r' AS run_id, c_name AS display_name, 'h' AS homepage_url, '/c' AS corpus_root, products, agent_listed, 3::INTEGER AS max_products, 'complete' AS status, notes, c_nationkey AS turns FROM g JOIN customer ON c_custkey = o_custkey""",
    "citations_walk": "SELECT event_id, '$' || repeat('.a[0]', (CASE WHEN event_id % 500 = 0 THEN floor(value * 100) % 491 ELSE floor(value) % 11 END)::INTEGER) || '.b' AS at, 'resource-' || event_id AS resource_id, (event_id % 7)::INTEGER AS line_start FROM events",
    "scrapes": """SELECT page_id, page_id % 5 > 1 AND page_id % 2 = 0 AS ok, CASE WHEN page_id % 5 > 1 THEN (page_id % 600)::INTEGER END AS status_code, CASE WHEN page_id % 5 > 1 THEN 'c' || page_id END AS content,
  CASE WHEN page_id % 5 <= 1 THEN 'Browserless returned a non-object response' END AS message, CASE WHEN page_id % 5 > 1 THEN 'https://a/' || page_id || ' x' END AS links FROM pages""",
    "site_maps": "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE 'https://a/' || page_id || ' http://b/' || page_id END AS urls FROM pages",
    "preflights": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://f/' || c_custkey ELSE c_name END AS final_url, (c_custkey % 500)::INTEGER AS status_code, CASE WHEN c_custkey % 3 = 1 THEN 'refused' END AS error FROM customer",
    "sector_order": "SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 ELSE -1 END::INTEGER AS place, CASE WHEN c_custkey % 2 = 0 THEN 'ugv,uuv' ELSE 'ugv,uav,uuv' END AS domains FROM customer",
    "citation_remap_runs": """WITH o AS (SELECT o_orderkey, o_custkey AS t, year(o_orderdate) AS y, o_orderkey % 3 AS n FROM orders), f AS (SELECT *, min(y) OVER (PARTITION BY t) AS y0 FROM o),
g AS (SELECT *, (n + y0) % 4 AS a, (n + y) % 4 AS b FROM f)
SELECT o_orderkey, 'u' || a AS by_oldest, CASE WHEN a = 3 THEN 'url_not_canonical' ELSE 'migrated' END AS outcome_oldest, 'u' || b AS by_own, CASE WHEN b = 3 THEN 'url_not_canonical' ELSE 'migrated' END AS outcome_own FROM g""",
    "url_totals": "SELECT max(n) AS most, sum(n)::BIGINT AS total FROM (SELECT count(DISTINCT event_type) AS n FROM events GROUP BY user_id)",
    "manifest_entries": """SELECT c_custkey AS target_id, c_name AS display_name, 'complete' AS quality_status, 'm.json' AS manifest_path, 'q.json' AS quality_report_path, coalesce(n, 0)::INTEGER AS resource_count, 'mirrored' AS disposition,
  c_custkey % 9 AS browserless_calls_used, 9::INTEGER AS browserless_call_budget, c_custkey % 9 = 8 AS budget_exhausted, CASE WHEN c_custkey % 2 = 0 THEN 'r0' END AS covered_by_run_id FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "link_edges": """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, 'href\\s*=\\s*"([^"]*)"', 1)) AS h FROM pages)
SELECT page_id, count(*) AS n, min('https://h.example' || CASE WHEN starts_with(h, '/') THEN '' ELSE '/' END || h) AS least FROM a GROUP BY page_id""",
}
