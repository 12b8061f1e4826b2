"""Queries of polls that commit as one, archives, front matter, sketches and slugs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import quality
from ..session import scratch_path, table
from ..sources import archive, readers, writers
from ..streaming import poll

POLLS = ("2024-01-10", "2024-01-20", "2024-02-01")


def newsletter_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls over the events of three spans of days; the second is run twice, as after a crash. The items of all polls."""
    path = scratch_path(spark, "polls")
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("slug"), F.concat("event_type", (F.col("event_id") % 9).cast("string")).alias("url"), F.to_date("ts").alias("date"))
    run = poll.sink(path, lambda k: POLLS[k])
    for k in (0, 1, 1, 2):
        run(e.where(F.col("date") < POLLS[k]) if k == 0 else e.where((F.col("date") >= POLLS[k - 1]) & ((F.col("date") < POLLS[k]) | F.lit(k == 2))), k)
    return poll.read(spark, path, "items").select("poll", "slug", "url", "date", "is_new", F.to_date("first_seen_at").alias("first_seen"), "place")


def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as members of tar shards, one snapshot of all and one of their addresses; the pages read back from the first."""
    path = scratch_path(spark, "snapshots")
    spark.dataSource.register(archive.TarArchive)
    p = table(spark, sf_dir, "pages").withColumn("path", F.concat(F.lit("pages/p"), F.col("page_id").cast("string"), F.lit(".html")))
    for name, content in (("whole", "html"), ("addresses", "url")):
        p.select("path", F.encode(F.coalesce(content, F.lit("")), "utf-8").alias("content")).write.format("tar_archive").option("path", path).option("snapshot", name).mode("append").save()
    pushed = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(pushed)
    spark.conf.set(pushed, "true")
    try:
        rows = spark.read.format("tar_archive").option("path", path).load().where("snapshot = 'whole'").select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.lit(archive.latest(path)).alias("latest"))
        rows.schema  # noqa: B018
        kept = scratch_path(spark, "members")
        rows.write.parquet(kept)
    finally:
        spark.conf.set(pushed, before)
    return spark.read.parquet(kept)


def archived_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a page renderer and of a site map, archived by run; those of three runs are read, a fourth is not opened."""
    path = scratch_path(spark, "answers")
    spark.dataSource.register(archive.TarArchive)
    k = F.col("page_id")
    links = F.to_json(F.struct(F.array(F.col("url"), F.concat("url", F.lit("x")), F.lit("ftp://no"), F.col("url")).alias("links")))
    scrape = F.when(k % 5 == 0, "[1]").otherwise(F.to_json(F.struct((k % 2 == 0).alias("ok"), (k % 600).cast("int").alias("statusCode"), F.col("html").alias("content"))))
    p = table(spark, sf_dir, "pages").select(k.cast("string").alias("id"), (k % 3).alias("run"), F.array(F.struct(F.lit("map").alias("kind"), links.alias("raw")), F.struct(F.lit("scrape").alias("kind"), scrape.alias("raw"))).alias("answers"))
    members = p.select("run", F.explode("answers").alias("a"), "id").select("run", F.concat("a.kind", F.lit("/"), "id", F.lit(".json")).alias("path"), F.encode("a.raw", "utf-8").alias("content"))
    for run in range(4):
        members.where(F.col("run") == run % 3).drop("run").write.format("tar_archive").option("path", path).option("snapshot", f"r{run}").mode("append").save()
    pushed, kept = "spark.sql.python.filterPushdown.enabled", scratch_path(spark, "answers-read")
    before = spark.conf.get(pushed)
    spark.conf.set(pushed, "true")
    try:
        spark.read.format("tar_archive").option("path", path).load().where("snapshot IN ('r0', 'r1', 'r2')").select("snapshot", "path", F.decode("content", "utf-8").alias("raw")).write.parquet(kept)
    finally:
        spark.conf.set(pushed, before)
    read = spark.read.parquet(kept).withColumn("page_id", F.regexp_extract("path", r"/(\d+)\.json$", 1).cast("long"))
    maps = readers.site_map(read.where("path LIKE 'map/%'")).select("page_id", "snapshot", F.array_join("urls", " ").alias("urls"))
    scrapes = readers.scrapes(read.where("path LIKE 'scrape/%'")).select("page_id", "ok", "status_code", F.length("content").alias("chars"), "message")
    return maps.join(scrapes, "page_id")


def front_matter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as markdown with front matter, and read from it again."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('"'), "c_name", F.lit('": '), "c_mktsegment").alias("name"), F.array("c_mktsegment", F.lit("a: b\n---")).alias("tags"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("nation"))
    text = c.select(writers.front_matter(c, F.concat(F.lit("---\nbody "), F.col("c_custkey").cast("string"))).alias("value"))
    got = readers.front_matter(text, "c_custkey long, name string, tags array<string>, nation long")
    return got.select("c_custkey", "name", F.array_join("tags", "|").alias("tags"), "nation", "body", "problem")


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of each supplier's lines, from one sketch for each ship mode and supplier group, merged without a rescan."""
    li = table(spark, sf_dir, "lineitem")
    key = (F.col("l_suppkey") % 5).alias("suppliers")
    merged = quality.distinct_of(quality.sketches(li.select(key, "l_returnflag", "l_orderkey"), ["suppliers", "l_returnflag"], "l_orderkey"), ["suppliers"])
    exact = li.groupBy(key).agg(F.count_distinct("l_orderkey").alias("exact"))
    return merged.join(exact, "suppliers").select("suppliers", "exact", (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.col("exact") * 0.02, F.lit(1))).alias("close"))


ENDINGS = ("", ", Inc.", " S.A", " s.a.", " GmbH & Co", " L.L.C.", " Inc!", " (old)", " Limited", " b.v.")


def name_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with corporate endings of all kinds, as slugs."""
    ending = F.element_at(F.array(*[F.lit(x) for x in ENDINGS]), (F.col("p_partkey") % len(ENDINGS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", udfs.ascii_slug(F.concat("p_name", ending)).alias("slug"))


QUERIES = {f.__name__: f for f in (newsletter_commits, archive_round_trip, archived_answers, front_matter_rows, distinct_sketches, name_slugs)}

_ENDINGS = "[" + ", ".join("'" + x + "'" for x in ENDINGS) + "]"
ORACLES = {
    "newsletter_commits": f"""WITH e AS (SELECT user_id::VARCHAR AS slug, event_type || (event_id % 9) AS url, ts::DATE AS date, CASE WHEN ts::DATE < DATE '{POLLS[0]}' THEN 0 WHEN ts::DATE < DATE '{POLLS[1]}' THEN 1 ELSE 2 END::BIGINT AS poll FROM events),
i AS (SELECT poll, slug, url, max(date) AS date FROM e GROUP BY ALL), f AS (SELECT *, min(poll) OVER (PARTITION BY slug, url) AS first FROM i)
SELECT poll, slug, url, date, poll = first AS is_new, (['{POLLS[0]}', '{POLLS[1]}', '{POLLS[2]}'][first + 1])::DATE AS first_seen, row_number() OVER (PARTITION BY poll, slug ORDER BY date DESC, url DESC) AS place FROM f""",
    "archive_round_trip": "SELECT 'pages/p' || page_id || '.html' AS path, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS sha256, 'addresses' AS latest FROM pages",
    "archived_answers": """SELECT page_id, 'r' || (page_id % 3) AS snapshot, url || ' ' || url || 'x' AS urls, page_id % 5 <> 0 AND page_id % 2 = 0 AS ok, CASE WHEN page_id % 5 <> 0 THEN (page_id % 600)::INTEGER END AS status_code,
  CASE WHEN page_id % 5 <> 0 THEN length(html)::INTEGER END AS chars, CASE WHEN page_id % 5 = 0 THEN 'Browserless returned a non-object response' END AS message FROM pages""",
    "front_matter_rows": """SELECT c_custkey, '"' || c_name || '": ' || c_mktsegment AS name, c_mktsegment || '|a: b' || chr(10) || '---' AS tags, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS nation, '---' || chr(10) || 'body ' || c_custkey AS body, NULL::VARCHAR AS problem FROM customer""",
    "distinct_sketches": "SELECT l_suppkey % 5 AS suppliers, count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem GROUP BY 1",
    "name_slugs": rf"""WITH n AS (SELECT p_partkey, trim(regexp_replace(trim(p_name || {_ENDINGS}[p_partkey % {len(ENDINGS)} + 1]), '\s*\([^)]*\)\s*$', '')) AS x FROM part),
s AS (SELECT p_partkey, lower(regexp_replace(x, '(?i)\b(inc|incorporated|llc|l\.l\.c\.|ltd|limited|corp|corporation|co|company|gmbh|sa|s\.a\.|plc|ag|bv|b\.v\.)\.?$', '')) AS x FROM n)
SELECT p_partkey, coalesce(nullif(rtrim(left(trim(regexp_replace(x, '[^a-z0-9]+', '-', 'g'), '-'), 60), '-'), ''), 'unnamed') AS slug FROM s""",
}
