"""Readers of documents, text and files. Broken rows are set aside, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.walk import gather

CORRUPT = "_corrupt_record"


def documents(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """One JSON document a file, with path and modified; a file that does not parse has its text in _corrupt_record."""
    df = spark.read.schema(f"{ddl}, {CORRUPT} string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return df.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of ``documents``."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select("path", CORRUPT)


def path_part(path: Column, after: str) -> Column:
    """The path segment that follows the segment ``after``."""
    return F.nullif(F.regexp_extract(path, f"/{after}/([^/]+)", 1), F.lit(""))


def corpora(spark: SparkSession, workspace: str, run: str = "*", target: str = "*") -> DataFrame:
    """Corpora below workspace/output/runs/RUN/targets/TARGET/manifest.json; a run's time is its manifest's, else the file's."""
    df = documents(spark, f"{workspace.rstrip('/')}/output/runs/{run}/targets/{target}/manifest.json", schemas.CORPUS)
    ids = df.withColumn("run_id", F.coalesce("run_id", path_part(F.col("path"), "runs"))).withColumn("target_id", F.coalesce("target_id", path_part(F.col("path"), "targets")))
    return ids.withColumn("created_at", F.coalesce(F.nullif("created_at", F.lit("")), F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss")))


def child(corpora_df: DataFrame, array: str) -> DataFrame:
    """crawl_index, resources or links as a table keyed by target_id and run_id, with pos."""
    return corpora_df.select("target_id", "run_id", F.posexplode(array).alias("pos", "_x")).select("target_id", "run_id", "pos", "_x.*")


def runs_in_order(df: DataFrame, by: str = "created_at") -> DataFrame:
    """``df`` with seq: 1 for a target's oldest run; ``by`` is created_at or, for merged documents, modified."""
    from pyspark.sql import Window

    return df.withColumn("seq", F.row_number().over(Window.partitionBy("target_id").orderBy(by, "run_id")))


def targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets of a JSON-lines file: blank lines and # comments skipped, follow-up URLs joined to the seeds, problem told with its line number."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    rows = raw.where((F.trim("text") != "") & ~F.ltrim("text").startswith("#")).withColumn("line", F.col("line") + 1)
    t = rows.withColumn("t", F.from_json("text", schemas.TARGET))
    seeds = F.array_distinct(F.array_compact(F.concat(F.coalesce("t.seed_urls", F.array().cast("array<string>")), F.coalesce(F.transform("t.follow_ups", lambda x: x["url"]), F.array().cast("array<string>")))))
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    problem = F.when(~filled("t.name"), "name missing").when(~filled("t.homepage_url"), "homepage missing")
    return t.select("line", "t.name", "t.homepage_url", "t.aliases", seeds.alias("seed_urls"), "t.categories", problem.alias("problem"))


def target_literals(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Name=https://... literals as name and homepage_url; problem where one does not read so."""
    parts = F.split(raw, "=", 2)
    name, home = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    ok = (name != "") & home.rlike("^https?://")
    return df.select("*", name.alias("name"), home.alias("homepage_url"), F.when(~F.coalesce(ok, F.lit(False)), "not Name=URL").alias("problem"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Text artifacts NNNN-*.txt: number, text, path; of several files with one number the first by name."""
    df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    n = F.regexp_extract("path", r"/(\d{4,})-[^/]*\.txt$", 1)
    return df.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).withColumn("number", n.try_cast("int")).where("number IS NOT NULL").groupBy("folder", "number").agg(F.min("path").alias("path"), F.min_by("text", "path").alias("text"))


def lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row a line, numbered from 1."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, "\n")).alias("_p", "line")).withColumn("line_no", F.col("_p") + 1).drop("_p")


def crawl_entries(df: DataFrame, raw: str = "value") -> DataFrame:
    """Entries of crawl indexes in either layout, an object with entries or a bare list, as variants."""
    v = df.withColumn("_v", F.expr(f"try_parse_json({raw})"))
    return v.select(*df.columns, F.posexplode(F.coalesce(F.expr("try_variant_get(_v, '$.entries', 'array<variant>')"), F.expr("try_variant_get(_v, '$', 'array<variant>')"))).alias("pos", "entry"))


def binaries(spark: SparkSession, path: str, with_content: bool = False) -> DataFrame:
    """Files as path, modificationTime, length, and content only if asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df if with_content else df.drop("content")


def downloads(df: DataFrame) -> DataFrame:
    """Downloads with status: failed from HTTP status 400 on or without content."""
    return df.withColumn("status", F.when((F.col("status_code") >= 400) | F.col("content").isNull(), "failed").otherwise("fetched")).withColumn("sha256", F.sha2("content", 256))


def cached(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests answered from a response cache keyed by the URL's sha1; body is null where one must be fetched."""
    return requests.withColumn("cache_key", F.sha1("url")).join(cache.select("cache_key", "body"), "cache_key", "left")


def mapped_urls(df: DataFrame, items: str = "items", limit: int = 5000) -> DataFrame:
    """URL lists of a site map: strings or objects with url, http and https only, first occurrence, at most 1 to 5000."""
    keep = F.array_distinct(F.filter(F.array_compact(F.col(items)), lambda u: u.rlike("^https?://")))
    return df.withColumn(items, F.slice(keep, 1, max(1, min(limit, 5000))))


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A JSON table, or an empty one where the path does not exist yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(ddl).json(path) if there else spark.createDataFrame([], ddl)


def unknown_fields(df: DataFrame, raw: str, allowed: list[str]) -> DataFrame:
    """Documents with top-level fields that the schema does not have, and which."""
    extra = F.array_except(F.json_object_keys(raw), F.array(*[F.lit(a) for a in allowed]))
    return df.withColumn("unknown", extra).where(F.size("unknown") > 0)


def link_edges(resources: DataFrame, key: list[str], links: str = "links") -> DataFrame:
    return resources.select(*key, F.explode(F.filter(links, lambda x: x.isNotNull())).alias("target_url"))


#: Levels that Spark's JSON parser goes down; a deeper text is none to it.
MOST_LEVELS = 1000


def citations(df: DataFrame, raw: str, key: list[str], loose: bool = False) -> DataFrame:
    """Citation-shaped objects anywhere in JSON documents, with their path: objects that have resource_id and line_start.

    With ``loose`` the canonical merge's rule holds: a resource_id that begins with resource-, and line_start or snippet.
    Depth is in the data, not in the plan; a text that does not parse, as any of more than MOST_LEVELS levels, has no citations.
    """
    listed = "transform(try_variant_get(x.v, '$', 'array<variant>'), (y, i) -> struct(concat(x.at, '[', i, ']') AS at, y AS v))"
    named = "transform(map_entries(try_variant_get(x.v, '$', 'map<string,variant>')), e -> struct(concat(x.at, '.', e.key) AS at, e.value AS v))"
    get = lambda p, t: f"try_variant_get(x.v, '$.{p}', '{t}')"
    fields = {"resource_id": "string", "line_start": "int", "line_end": "int", "snippet": "string"}
    take = f"struct(x.at AS at, {', '.join(f'{get(p, t)} AS {p}' for p, t in fields.items())})"
    opened = f"length({raw}) - length(translate({raw}, '[{{', ''))"  # no text is nested deeper than it has opening brackets
    cites = gather(f"struct('$' AS at, try_parse_json({raw}) AS v)", f"coalesce({listed}, {named})", f"{get('resource_id', 'string')} IS NOT NULL", take, "at: string, " + ", ".join(f"{p}: {t}" for p, t in fields.items()), f"least({opened}, {MOST_LEVELS})")
    found = df.select(*key, F.inline(cites))
    if loose:
        return found.where("startswith(resource_id, 'resource-') AND (line_start IS NOT NULL OR snippet IS NOT NULL)")
    return found.where("resource_id IS NOT NULL AND line_start IS NOT NULL")


# Fixed value: the message of an answer that is no object.
NO_OBJECT = "Browserless returned a non-object response"


def scrapes(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Answers of a page renderer as ok, status_code, content, content_type, message, markdown, links; one that is no JSON object is not ok."""
    v = df.withColumn("_v", F.expr(f"try_parse_json({raw})")).withColumn("_o", F.coalesce(F.expr("schema_of_variant(_v) LIKE 'OBJECT%'"), F.lit(False)))
    get = lambda p, t: F.expr(f"try_variant_get(_v, '$.{p}', '{t}')")
    message = F.when(F.col("_o"), get("message", "string")).otherwise(NO_OBJECT)
    return v.select(
        *df.columns, (F.col("_o") & F.coalesce(get("ok", "boolean"), F.lit(False))).alias("ok"), get("statusCode", "int").alias("status_code"), get("content", "string").alias("content"), get("contentType", "string").alias("content_type"),
        message.alias("message"), get("markdown", "string").alias("markdown"), get("links", "array<string>").alias("links"),
    )


def site_map(df: DataFrame, raw: str = "raw", limit: int = 5000) -> DataFrame:
    """Answers of a site map as urls: links are texts or objects with url; http and https only, first occurrence, at most 1 to 5000."""
    links = F.expr(f"try_variant_get(try_parse_json({raw}), '$.links', 'array<variant>')")
    url = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.try_variant_get(x, "$.url", "string"))
    return mapped_urls(df.withColumn("urls", F.coalesce(F.transform(links, url), F.array().cast("array<string>"))), "urls", limit)


def preflights(targets_df: DataFrame, answers: DataFrame) -> DataFrame:
    """Targets with final_url, status_code, content_type and error of their homepage's first request; without an answer the URL stands for itself."""
    got = answers.select(F.col("url").alias("homepage_url"), F.col("final_url"), "status_code", "content_type", "error")
    return targets_df.join(got, "homepage_url", "left").withColumn("final_url", F.coalesce("final_url", "homepage_url"))


def pdf_texts(files: DataFrame) -> DataFrame:
    """Binary files (path, content) with text: that of their pages, blank lines between; null where it cannot be read, or no PDF library is installed."""
    from ..functions.udfs import pdf_text

    return files.select("path", pdf_text(F.col("content")).alias("text"))


def front_matter(df: DataFrame, ddl: str, text: str = "value") -> DataFrame:
    """Markdown with front matter as typed columns, body and problem; the form is that of ``writers.front_matter``: one JSON value a line.

    Keys that ``ddl`` has and a document has not are null. A document without front matter, with a line that is no
    ``key: value``, with a value that is no JSON or one of another type than its column's, is set aside: problem says why,
    its columns are null, and the text stays as body.
    """
    head, body = (F.regexp_extract(text, r"(?s)\A---\r?\n(.*?)\r?\n?---\r?\n(.*)\z", k) for k in (1, 2))
    fenced = F.col(text).rlike(r"(?s)\A---\r?\n(?:.*?\r?\n)?---\r?\n")
    lines = F.filter(F.split(head, r"\r?\n"), lambda x: F.trim(x) != "")
    odd = F.filter(lines, lambda x: ~x.rlike(r"^[A-Za-z_]\w*:\s*\S"))
    pairs = F.transform(lines, lambda x: F.concat(F.lit('"'), F.regexp_extract(x, r"^(\w+):", 1), F.lit('":'), F.regexp_replace(x, r"^\w+:", "")))
    parsed = df.withColumn("_json", F.when(fenced & (F.size(odd) == 0), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))).withColumn("_odd", F.get(odd, F.lit(0)))
    parsed = parsed.withColumn("_v", F.expr("try_parse_json(_json)")).withColumn("_row", F.from_json("_json", f"{ddl}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    problem = F.when(F.col(text).isNull() | ~fenced, "no front matter").when(F.col("_odd").isNotNull(), F.concat(F.lit("not key: value: "), F.col("_odd"))).when(F.col("_v").isNull(), "not JSON").when(F.col(f"_row.{CORRUPT}").isNotNull(), "wrong type")
    names = [f.name for f in parsed.schema["_row"].dataType.fields if f.name != CORRUPT]
    parsed = parsed.withColumn("problem", problem)
    return parsed.select(*[c for c in df.columns if c != text], *[F.when(F.col("problem").isNull(), F.col("_row")[n]).alias(n) for n in names], F.when(F.col("problem").isNull(), body).otherwise(F.col(text)).alias("body"), "problem")
