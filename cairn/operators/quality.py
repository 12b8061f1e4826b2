"""Quality reports and state summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crawl(rows: DataFrame, keys: list[str], min_chars: int, has_product: Column, has_about: Column, calls: Column | None = None, call_budget: int | None = None) -> DataFrame:
    """Quality of a crawl per key, in one aggregation: counts, text characters, reasons in order, status.

    Rows have status, kind and text_chars, and calls (paid calls of the key so far) if there is a call budget.
    ``has_product`` and ``has_about`` tell of a row whether its URL shows such a page. Six reasons in fixed order;
    status is failed without HTML pages, complete without reasons, else partial or, with too little text, review_required.
    """
    got, html = F.col("status") == "fetched", F.col("kind") == "html"
    g = rows.groupBy(*keys).agg(
        F.count_if(got & html).alias("fetched_pages"), F.count_if((F.col("status") == "failed") & html).alias("failed_pages"), F.count_if(got & (F.col("kind") == "document")).alias("fetched_documents"),
        F.count("*").alias("discovered_urls"), F.count_if(F.col("status").startswith("skipped")).alias("skipped_urls"), F.coalesce(F.sum("text_chars"), F.lit(0)).alias("total_text_chars"),
        F.coalesce(F.bool_or(got & has_product), F.lit(False)).alias("_product"), F.coalesce(F.bool_or(got & has_about), F.lit(False)).alias("_about"),
        F.coalesce(F.max(calls) if calls is not None else F.lit(0), F.lit(0)).alias("_calls"),
    )
    spent = F.lit(False) if call_budget is None else F.col("_calls") >= call_budget
    rules = [
        ("no_html", F.col("fetched_pages") == 0), ("little_text", F.col("total_text_chars") < min_chars), ("no_product", ~F.col("_product")),
        ("no_about", ~F.col("_about")), ("failed_pages", F.col("failed_pages") > 0), ("budget_exhausted", spent),
    ]
    reasons = F.array_compact(F.array(*[F.when(test, name) for name, test in rules]))
    g = g.withColumn("reasons", F.array_join(reasons, ","))
    status = F.when(F.col("fetched_pages") == 0, "failed").when(F.col("reasons") == "", "complete").when(F.col("total_text_chars") >= min_chars, "partial").otherwise("review_required")
    return g.withColumn("quality", status).drop("_product", "_about", "_calls")


def canonical(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Quality of a merged corpus: failed without HTML, partial with failures or skips, else complete."""
    got = F.col("status") == "fetched"
    g = rows.groupBy(*keys).agg(
        F.count_if(got & (F.col("kind") == "html")).alias("html"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(~F.col("status").isin("fetched", "queued")).alias("_not")
    )
    g = g.withColumn("skipped", F.col("_not") - F.col("failed")).drop("_not")
    return g.withColumn("quality", F.when(F.col("html") == 0, "failed").when((F.col("failed") > 0) | (F.col("skipped") > 0), "partial").otherwise("complete"))


def summary(rows: DataFrame, *dims: str) -> DataFrame:
    """Counts by each dimension apart and in all, in one pass over grouping sets."""
    sets = [[F.col(d)] for d in dims]
    g = rows.groupingSets([*sets, []], *[F.col(d) for d in dims]).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    label = F.coalesce(*[F.when(F.col("gid") == ((1 << len(dims)) - 1 - (1 << (len(dims) - 1 - k))), F.lit(d)) for k, d in enumerate(dims)], F.lit("all"))
    return g.select(label.alias("dimension"), F.coalesce(*[F.col(d).cast("string") for d in dims]).alias("value"), "n")


def page_class_counts(rows: DataFrame, cls: str = "page_class") -> DataFrame:
    return rows.groupBy(cls).agg(F.count("*").alias("n")).orderBy(cls)


def split_outcomes(rows: DataFrame, ok: Column) -> DataFrame:
    """Rows with outcome succeeded or failed; the reason stays with the failed ones."""
    return rows.withColumn("outcome", F.when(ok, "succeeded").otherwise("failed")).withColumn("reason", F.when(~ok, F.col("reason")))


def snapshot(files: DataFrame) -> DataFrame:
    """Files, vendors and bytes of a tree read as binaryFile metadata (path, length)."""
    return files.agg(F.count("*").alias("files"), F.count_distinct(F.regexp_extract("path", r"/vendors/([^/]+)/", 1)).alias("vendors"), F.sum("length").alias("bytes"))


def fetched(index: DataFrame) -> DataFrame:
    """Fetched entries with a resource; class and depth filled in."""
    return index.where((F.col("status") == "fetched") & F.col("resource_id").isNotNull()).withColumns({"page_class": F.coalesce("page_class", F.lit("other")), "depth": F.coalesce("depth", F.lit(0))})


def not_fetched(index: DataFrame) -> DataFrame:
    return index.where(~F.coalesce((F.col("status") == "fetched") & F.col("resource_id").isNotNull(), F.lit(False)))


def url_totals(rows: DataFrame, urls: str, *keys: str) -> DataFrame:
    """The most URLs that one row has, and all of theirs together; by ``keys``, or over the whole table."""
    n = F.coalesce(F.size(urls), F.lit(0))
    return rows.groupBy(*keys).agg(F.max(n).alias("most"), F.sum(n).alias("total"))


def sketches(rows: DataFrame, key: list[str], value: str, precision: int = 14) -> DataFrame:
    """A HyperLogLog sketch of ``value`` for each key, some kilobytes: runs are counted once and merged later without a rescan."""
    return rows.groupBy(*key).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def distinct_of(sketched: DataFrame, key: list[str]) -> DataFrame:
    """The distinct values that the sketches of a key have together, within one or two per cent."""
    return sketched.groupBy(*key).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
