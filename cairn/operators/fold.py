"""Folds over runs in closed form: ordered aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as v


def newest(value: Column, seq: Column, where: Column) -> Column:
    """The value of the highest ``seq`` among the rows that satisfy ``where``."""
    return F.max_by(F.when(where, F.struct(value.alias("v"))), F.when(where, seq))["v"]


def oldest(value: Column, seq: Column, where: Column) -> Column:
    return F.min_by(F.when(where, F.struct(value.alias("v"))), F.when(where, seq))["v"]


def answer(value: Column, status: Column, seq: Column, present: Column | None = None) -> Column:
    """One answer from all runs: the newest that is answered, else the oldest that is not unknown, else the oldest.

    ``present`` marks the rows in which a run has the field at all; a run without it changes nothing.
    """
    present = value.isNotNull() if present is None else present
    first = F.lit(True)
    return F.coalesce(newest(value, seq, present & (status == "answered")), oldest(value, seq, present & (status != "unknown")), oldest(value, seq, first))


def forward_looking(value: Column, seq: Column) -> Column:
    """The newest value that is there."""
    return newest(value, seq, value.isNotNull())


def first_filled(value: Column, seq: Column) -> Column:
    return oldest(value, seq, F.coalesce(value, F.lit("")) != "")


def best_status(status: Column) -> Column:
    """The status of highest rank; unknown where there is none."""
    return F.coalesce(F.max_by(status, v.status_rank(status)), F.lit("unknown"))


def ordered_union(rows: DataFrame, keys: list[str], array: str, seq: str = "seq") -> DataFrame:
    """One row a key: the distinct elements of all its arrays, in order of first occurrence by ``seq``; no elements give an empty array.

    Elements are brought down to one row each before a key's are gathered.
    """
    each = rows.select(*keys, seq, F.posexplode_outer(array).alias("_i", "_e"))
    firsts = each.groupBy(*keys, "_e").agg(F.min(F.struct(seq, "_i")).alias("_f"))
    ordered = F.sort_array(F.collect_list(F.when(F.col("_e").isNotNull(), F.struct("_f", "_e"))))
    return firsts.groupBy(*keys).agg(F.transform(ordered, lambda x: x["_e"]).alias(array))


def urls(entries: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """One row per URL from its rows of all runs (status, resource, skip_reason, final_url, page_class, kind, depth, in_scope).

    A fetched row with a resource wins over any skip; the least depth holds; descriptive fields take the last value of
    the oldest row and the fetched rows. The skip reason of a URL never fetched is its newest row's; a later fetch does
    not clear the reason that stood before it.
    """
    s = F.col(seq)
    fetched = (F.col("status") == "fetched") & F.col("resource").isNotNull()
    w = Window.partitionBy(*keys).orderBy(s)
    marked = entries.withColumn("_first", F.row_number().over(w) == 1).withColumn("_before", F.lag("skip_reason").over(w)).withColumn("_got", F.col("status") == "fetched")
    heir = F.when(F.col("_first") | F.col("resource").isNull(), F.col("skip_reason")).otherwise(F.col("_before"))
    any_fetched = F.bool_or("_got")
    last = lambda c: F.max_by(F.col(c), F.when((F.col("_first") | fetched) & F.col(c).isNotNull(), s))
    return marked.groupBy(*keys).agg(
        F.max_by("resource", F.when(fetched, s)).alias("resource"),
        F.when(any_fetched, "fetched").otherwise(F.max_by("status", s)).alias("status"),
        F.when(any_fetched, F.min_by(F.struct(heir.alias("r")), F.when(F.col("_got"), s))["r"]).otherwise(F.max_by("skip_reason", s)).alias("skip_reason"),
        last("final_url").alias("final_url"), last("page_class").alias("page_class"), last("kind").alias("kind"),
        F.min("depth").alias("depth"), F.bool_or("in_scope").alias("in_scope"),
    )


def with_resources(entries: DataFrame, resources: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Crawl entries with resource, a struct of the resource of the same corpus that their resource_id names; of several with one id the last by ``pos``, null where there is none or the entry names none."""
    body = [c for c in resources.columns if c not in (*keys, "resource_id", pos)]
    last = resources.where("resource_id IS NOT NULL").groupBy(*keys, "resource_id").agg(F.max_by(F.struct(*body), pos).alias("resource"))
    return entries.join(last, [*keys, "resource_id"], "left").select(*entries.columns, "resource")


def products(rows: DataFrame, keys: list[str], name: str, content: list[str], seq: str = "seq", pos: str = "pos") -> DataFrame:
    """Union of the products of all runs: newest content, first-seen place; one run alone passes through with its repeats."""
    at, all_runs = F.struct(seq, pos), Window.partitionBy(*keys)
    marked = rows.withColumn("_own", F.when(F.min(seq).over(all_runs) == F.max(seq).over(all_runs), F.col(pos)))  # grouped by the same keys below: one shuffle
    body = F.struct(*content)
    out = marked.groupBy(*keys, name, "_own").agg(F.max_by(body, at).alias("b"), F.min(at).alias("_first"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_first"))
    return out.select(*keys, name, "b.*", place.alias("position"))


def requests(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Fetch requests, one per URL: first reason, evidence fields in order of first mention, first hint that is filled, and whether any run had the URL in its index."""
    s = F.col("seq")
    one = rows.groupBy(*keys).agg(F.min_by("reason", s).alias("reason"), first_filled(F.col("source_hint"), s).alias("source_hint"), F.bool_or("in_corpus_index").alias("in_corpus_index"))
    return one.join(ordered_union(rows, keys, "expected_evidence"), keys).select(*keys, "reason", "expected_evidence", "source_hint", "in_corpus_index")


def links(rows: DataFrame, key: list[str]) -> DataFrame:
    """Distinct links; where ``pos`` is there the first occurrence's place stays."""
    return rows.groupBy(*key).agg(F.min("pos").alias("pos")) if "pos" in rows.columns else rows.dropDuplicates(key)
