"""Citations: key remap, snippet hydration, drift, and integrity constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

MAX_WORDS = 60


def remap(citations: DataFrame, id_to_url: DataFrame, url_to_id: DataFrame, run: list[str], target: list[str]) -> DataFrame:
    """``citations`` (run, target, resource_id, ...) with url, new_id and outcome through two lookups; unresolved ones stay, flagged.

    ``id_to_url`` has run, resource_id, url; ``url_to_id`` has target, url, canonical_id.
    """
    a = citations.join(id_to_url.select(*run, "resource_id", "url"), [*run, "resource_id"], "left")
    b = a.join(url_to_id.select(*target, "url", "canonical_id"), [*target, "url"], "left")
    new = t.resource_id(F.col("canonical_id"))
    outcome = F.when(F.col("url").isNull(), "unknown_resource").when(F.col("canonical_id").isNull(), "url_not_canonical").when(F.col("resource_id") == new, "already_canonical").otherwise("migrated")
    return b.withColumn("new_id", F.when(F.col("canonical_id").isNotNull(), new)).withColumn("outcome", outcome)


def remap_runs(citations: DataFrame, corpora: DataFrame, id_to_url: DataFrame, url_to_id: DataFrame, strict: bool = False) -> DataFrame:
    """Citations of merged documents (target_id, run_id, resource_id, ...) to canonical ids, by way of one run's index.

    The index is that of the target's oldest run, through which the reference resolves all its citations; with
    ``strict`` it is that of the run which gave the citation. ``corpora`` has target_id, run_id, seq.
    """
    if strict:
        by = citations.withColumn("_run", F.col("run_id"))
    else:
        by = citations.join(corpora.groupBy("target_id").agg(F.min_by("run_id", "seq").alias("_run")), "target_id", "left")
    index = id_to_url.select("target_id", F.col("run_id").alias("_run"), "resource_id", "url")
    return remap(by, index, url_to_id, ["target_id", "_run"], ["target_id"]).drop("_run")


def hydrate(citations: DataFrame, texts: DataFrame, keys: list[str], max_words: int = MAX_WORDS) -> DataFrame:
    """``citations`` with snippet, words and problem: equality on the resource, then a slice of its lines; no range join.

    problem: missing_text, out_of_range, empty or too_long (over ``max_words`` words); null where the citation holds.
    """
    joined = citations.join(texts.select(*keys, F.col("text").alias("_text")), keys, "left").withColumn("snippet", t.snippet(F.col("_text"), F.col("line_start"), F.col("line_end")))
    n = t.word_count(F.col("snippet"))
    problem = F.when(F.col("_text").isNull(), "missing_text").when(F.col("snippet").isNull(), "out_of_range").when(n == 0, "empty").when(n > max_words, "too_long")
    return joined.withColumn("words", F.when(F.col("snippet").isNotNull(), n)).withColumn("problem", problem).drop("_text")


def drift(hydrated: DataFrame, recorded: str = "recorded", refuse: bool = False) -> DataFrame:
    """Compare snippets with those recorded; a drifted citation is rewritten all the same, unless ``refuse``."""
    moved = ~F.col("snippet").eqNullSafe(F.col(recorded))
    return hydrated.withColumn("drifted", moved).withColumn("rewritten", F.col("snippet").isNotNull() & ~(moved & F.lit(refuse)))


def request_violations(requests: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Fetch requests that disagree with the crawl index: said to be in it but is not, is in it unsaid, or was fetched already."""
    j = requests.join(index.select(*keys, "url", F.col("status").alias("_status"), F.lit(True).alias("_known")), [*keys, "url"], "left")
    rule = F.when(F.col("in_corpus_index") & F.col("_known").isNull(), "not_in_index").when(~F.col("in_corpus_index") & F.col("_known").isNotNull(), "unmarked_in_index").when(F.col("_status") == "fetched", "already_fetched")
    return j.withColumn("violation", rule).where(F.col("violation").isNotNull()).drop("_status", "_known")


def violations(rows: DataFrame, key: list[Column], rules: dict[str, Column]) -> DataFrame:
    """One row (key, violation) for each rule that a row breaks; rules are predicates that must hold, null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return rows.select(*key, F.explode(broken).alias("violation"))


def locator_ok(start: Column, end: Column) -> Column:
    return (start >= 1) & (end >= start)


def answered_has_evidence(status: Column, evidence: Column) -> Column:
    return (status != "answered") | (F.size(evidence) > 0)


def one_primary(status: Column, flags: Column) -> Column:
    """An answered category list has exactly one primary."""
    return (status != "answered") | (F.size(F.filter(flags, lambda x: x)) == 1)


def requested(status: Column, field: str, requests: Column) -> Column:
    """A field that needs more fetches is listed by some request."""
    return (status != "needs_more_fetches") | F.exists(requests, lambda r: F.array_contains(r["expected_evidence"], field))


def rewrite_ids(evidence: Column, mapping: Column) -> Column:
    """Evidence arrays with resource ids replaced by a map's values."""
    return F.transform(evidence, lambda e: e.withField("resource_id", F.coalesce(mapping[e["resource_id"]], e["resource_id"])))


def report(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Totals by outcome for each key."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return outcomes.groupBy(*keys).agg(F.count("*").alias("citations"), n("migrated").alias("migrated"), n("already_canonical").alias("already_canonical"), n("url_not_canonical").alias("url_not_canonical"), n("unknown_resource").alias("unknown_resource"))
