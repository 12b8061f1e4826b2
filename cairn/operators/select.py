"""Budgeted selection: windows in place of greedy loops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import url as u
from ..functions import vocab as v


def class_budget(cls: Column, profile: str, max_news: int | None = None, max_career: int | None = None) -> Column:
    """Pages of a class that a profile keeps; news and careers may be capped further."""
    caps = dict(zip(v.PAGE_CLASSES, v.PROFILE_BUDGETS[profile], strict=True))
    if max_news is not None:
        caps["news"] = min(caps["news"], max_news)
    if max_career is not None:
        caps["career"] = min(caps["career"], max_career)
    return reduce(lambda c, kv: c.when(cls == kv[0], kv[1]), list(caps.items())[1:], F.when(cls == "homepage", caps["homepage"])).otherwise(0)


def class_order(cls: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in v.PAGE_CLASSES]), cls)


def budgeted(candidates: DataFrame, key: list[str], group: list[str], cls: str, order: list[Column], budget: Column, class_rank: Column, max_total: int, seeds_in_class: Column | None = None, seeds: int = 0) -> DataFrame:
    """``candidates`` with selected and status: the best of each class within its budget, then of all within ``max_total``.

    Seeds are chosen beforehand and count against both limits. Left-over rows are skipped_class_budget where their
    class has no budget at all, else skipped_budget. No row beyond ``max_total`` in its class can be selected, so each
    task keeps that many of a class before the shuffle, and a group of any size is ranked from a bounded rest; the
    choice comes back by ``key``, which is unique and not null.
    """
    own = Window.partitionBy(*group, cls).orderBy(*order)
    best = candidates.withColumn("_budget", budget - (F.lit(0) if seeds_in_class is None else seeds_in_class)).withColumn("_rn", F.row_number().over(own)).where(F.col("_rn") <= max_total)
    overall = Window.partitionBy(*group).orderBy(class_rank, "_rn", *order)
    picked = best.where(F.col("_rn") <= F.col("_budget")).withColumn("_place", F.row_number().over(overall)).where(F.col("_place") <= max_total - seeds)
    marked = candidates.join(picked.select(*key, F.lit(True).alias("selected")), key, "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    return marked.withColumn("status", F.when(F.col("selected"), "selected").when(budget <= 0, "skipped_class_budget").otherwise("skipped_budget"))


def top_k(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` of each group; the planner limits each group before the shuffle."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")


def ordered_distinct(array: Column, limit: int | None = None) -> Column:
    out = F.array_distinct(array)
    return out if limit is None else F.slice(out, 1, limit)


def map_limit(pages: Column, multiplier: Column, most: int = 5000) -> Column:
    return F.least(F.greatest(pages * multiplier, pages), F.lit(most))


def pages_of_site(pages: DataFrame, profile: str, url: str = "url", site: str = "site", home: str = "home") -> DataFrame:
    """Classify, score and select the pages of each site under a profile; out-of-scope and asset URLs are rejected before ranking."""
    c = pages.withColumn("page_class", u.classify_page(F.col(url), F.col(home))).withColumn("score", u.page_score(F.col(url))).withColumn("kind", u.resource_kind(F.col(url)))
    fit = c.where(u.in_scope(F.col(url), F.col(home)) & (F.col("kind") == "html") & (F.col("page_class") != "homepage"))
    order = [F.col("score").desc(), F.length(u.path(F.col(url))), F.col(url)]
    return budgeted(fit, [url], [site], "page_class", order, class_budget(F.col("page_class"), profile), class_order(F.col("page_class")), v.PROFILE_LIMITS[profile][0] - 1)


def index_order(index: DataFrame) -> DataFrame:
    """A crawl index as it is written: by depth, then URL."""
    return index.orderBy("depth", "url")
