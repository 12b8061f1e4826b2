"""News sources and items: path families, dates, deltas, digests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import url as u
from ..functions.trims import strip
from .walk import walk

PRIMARY_MIN = 3


def families(entries: DataFrame, key: list[str], url: str = "url") -> DataFrame:
    """One row per key and news family: items, rank (the primary first), bare_index_seen, index_path.

    Primary is the family of best rank among those with three items or more, or among all if none has. ``entries``
    carries pos, the crawl order.
    """
    p = u.path(F.col(url))
    e = entries.withColumn("family", u.classify_path(p)).where(F.col("family").isNotNull()).withColumn("npath", u.normalize_path(p))
    e = e.withColumn("bare", u.bare_index(F.col("npath"), F.col("family")))
    g = e.groupBy(*key, "family").agg(
        F.count("*").alias("items"), F.min_by("npath", F.when(F.col("bare"), F.col("pos"))).alias("_bare"),
        common_prefix(F.col("npath")).alias("_prefix"), F.min_by("npath", F.struct(F.size(F.split("npath", "/")), F.length("npath"), "pos")).alias("_short"),
    )
    parent = F.regexp_replace("_short", "/[^/]*$", "")
    index = F.coalesce(
        "_bare", F.when(u.bare_index(F.col("_prefix"), F.col("family")), F.col("_prefix")), F.when(u.bare_index(parent, F.col("family")), parent), F.concat(F.lit("/"), "family")
    )
    g = g.withColumn("bare_index_seen", F.col("_bare").isNotNull()).withColumn("index_path", index).withColumn("family_rank", u.family_rank(F.col("family")))
    return rank_families(g.drop("_bare", "_prefix", "_short"), key)


def rank_families(g: DataFrame, key: list[str], items: str = "items", rank: str = "family_rank", out: str = "rank") -> DataFrame:
    """Rank within a key: the primary first, the rest by their family's rank."""
    w = Window.partitionBy(*key)
    best = F.coalesce(F.min(F.when(F.col(items) >= PRIMARY_MIN, F.col(rank))).over(w), F.min(rank).over(w))
    first = F.col(rank) == best
    return g.withColumn("_first", first).withColumn(out, F.row_number().over(w.orderBy(F.col("_first").desc(), rank))).drop("_first")


def common_prefix(paths: Column) -> Column:
    """Aggregate: the longest common prefix of whole segments; empty paths do not count.

    It is that of the least and the greatest path, compared segment by segment: as texts they would not do, since
    ``-`` and ``.`` sort before ``/``.
    """
    segments = F.when(strip("/", paths) != "", F.split(strip("/", paths), "/"))
    return F.coalesce(common_segments(F.min(segments), F.max(segments)), F.lit(""))


def common_segments(a: Column, b: Column) -> Column:
    """Leading segments that two arrays share, as a path; empty where they share none."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    n = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0).cast("long")), F.size(same) + 1) - 1
    return F.when(n > 0, F.concat(F.lit("/"), F.array_join(F.slice(a, F.lit(1), n.cast("int")), "/"))).otherwise("")


def repeats(rows: DataFrame, key: list[str], most: int = 3) -> DataFrame:
    """Rows whose key occurs at most ``most`` times; counted apart, so no group is gathered."""
    common = rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    return rows.join(common, key, "left_anti")


def with_dates(items: DataFrame, jsonld: DataFrame | None, as_of: Column, url: str = "url", text: str = "date_text") -> DataFrame:
    """``items`` with date: from JSON-LD by URL, else the URL's path, else the text beside it."""
    out = items if jsonld is None else items.join(jsonld.select(url, F.col("date").alias("_ld")), url, "left")
    ld = F.lit(None).cast("date") if jsonld is None else F.col("_ld")
    return out.withColumn("date", F.coalesce(ld, d.from_url(u.path(F.col(url)), as_of), d.in_text(F.col(text), as_of))).drop("_ld")


def jsonld_dates(pages: DataFrame, as_of: Column, html: str = "html", key: list[str] | None = None, order: Column | None = None, free: bool = False) -> DataFrame:
    """(key, url, date) of all JSON-LD entries: objects in lists and @graph lists, nested as they may be; broken blocks are passed over.

    The last of a URL wins: in a page by place, across the pages of a ``key`` by ``order``, then by the greater date.
    With ``free`` dates that no strict form reads are sought in free text.
    """
    key = key or []
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    b = pages.select(*key, (F.lit(0) if order is None else order).alias("_page"), F.posexplode(blocks).alias("_block", "_json")).withColumn("_v", F.expr("try_parse_json(_json)")).where("_v IS NOT NULL")
    items = "coalesce(try_variant_get(v, '$', 'array<variant>'), try_variant_get(v, '$[\"@graph\"]', 'array<variant>'))"
    kids = f"transform({items}, (x, i) -> struct(concat(at, array(i)) AS at, x AS v))"
    rows = walk(b.select(*key, "_page", F.array("_block").alias("at"), F.col("_v").alias("v")), [*key, "_page"], kids).withColumnsRenamed({"at": "_at", "v": "_v"})
    kind = lambda p: F.expr(f"schema_of_variant(try_variant_get(_v, '{p}', 'variant'))")
    text = lambda p: F.when(kind(p) == "STRING", F.nullif(F.expr(f"try_variant_get(_v, '{p}', 'string')"), F.lit("")))
    odd = F.coalesce(~kind("$.url").isin("STRING", "VOID"), F.lit(False))
    url = F.when(~odd, F.coalesce(text("$.url"), text('$["@id"]'), text('$.mainEntityOfPage["@id"]'), text("$.mainEntityOfPage.url"), text("$.mainEntityOfPage")))
    published = F.coalesce(text("$.datePublished"), text("$.dateCreated"))
    entries = rows.where("schema_of_variant(_v) LIKE 'OBJECT%'").select(*key, "_page", "_at", url.alias("url"), published.alias("_said"))
    dated = d.with_free_date(entries, "_said", as_of) if free else entries.withColumn("date", d.parse_value(F.col("_said"), as_of))
    found = dated.where("url IS NOT NULL AND date IS NOT NULL")
    return found.groupBy(*key, "url").agg(F.max_by("date", F.struct("_page", "_at", "date")).alias("date"))


def delta(items: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """``items`` with is_new: its key is not in ``seen``."""
    return items.join(seen.select(*key, F.lit(True).alias("_seen")).distinct(), key, "left").withColumn("is_new", F.col("_seen").isNull()).drop("_seen")


def first_seen(items: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``items`` with is_new: the first of its key in order; the batch form of the streaming delta."""
    return items.withColumn("is_new", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) == 1)


def merge_state(state: DataFrame, items: DataFrame, now: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(state, rendered): the newsletter state after a poll, and its items, newest first (place), with is_new and first_seen_at.

    ``state`` has slug, seen_urls, last_polled_at, polls_completed and, if ``strict``, first_seen (url to time);
    ``items`` has slug, url, date, one row a URL. Every item is stamped with the time of this poll, as the
    reference does; with ``strict`` one seen before keeps the time at which it was first seen. A vendor without a
    state starts from an empty one; one without items in this poll keeps its own. The state is a row a vendor, as its
    file is; ``streaming.poll`` keeps it as rows, where vendors list URLs by the million.
    """
    # What was seen meets the items URL by URL, as rows: no list is searched for each item.
    before = F.col("first_seen")[F.col("url")] if strict else F.lit(None)
    seen = state.select("slug", F.explode(F.array_distinct("seen_urls")).alias("url"), *(["first_seen"] if strict else [])).select("slug", "url", F.lit(True).alias("_seen"), before.alias("_before"))
    j = items.join(seen, ["slug", "url"], "left")
    new = F.col("_seen").isNull()
    first = F.coalesce("_before", now) if strict else now
    place = F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("date"), F.desc("url")))
    rendered = j.withColumns({"is_new": new, "first_seen_at": first, "place": place}).drop("_seen", "_before")
    polled = rendered.groupBy("slug").agg(F.collect_set("url").alias("_urls"), F.map_from_entries(F.collect_list(F.struct("url", "first_seen_at"))).alias("_first"))
    m = state.join(polled, "slug", "full_outer")
    none = F.array().cast("array<string>")
    met = F.col("_urls").isNotNull()
    columns = {
        "seen_urls": F.sort_array(F.array_union(F.coalesce("seen_urls", none), F.coalesce("_urls", none))),
        "last_polled_at": F.when(met, now).otherwise(F.col("last_polled_at")), "polls_completed": F.coalesce("polls_completed", F.lit(0)) + met.cast("int"),
    }
    if strict:
        columns["first_seen"] = F.when(F.col("first_seen").isNull(), F.col("_first")).when(met, F.map_concat("first_seen", F.map_filter("_first", lambda k, _: ~F.map_contains_key("first_seen", k)))).otherwise(F.col("first_seen"))
    return m.withColumns(columns).drop("_urls", "_first"), rendered


def poll(pages: DataFrame, parse: Callable[[str, str], list[tuple[str, str]]], key: str = "slug") -> tuple[DataFrame, DataFrame]:
    """(items, errors) of a poll. ``pages`` has ``key``, source_url, source_pos, ok, message and content; ``parse`` gives (url, title) pairs of a page.

    A source that failed to load, is empty, or makes ``parse`` raise leaves an error and no other trace: all other
    sources go on. Of a URL that several sources of a vendor list the first source's item stays.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, source, pos, ok, message, content in zip(*(pdf[c] for c in (key, "source_url", "source_pos", "ok", "message", "content")), strict=True):
                if not ok or not content:
                    rows.append((k, source, pos, 0, None, None, message or "no content"))
                    continue
                try:
                    rows += [(k, source, pos, n, url, title, None) for n, (url, title) in enumerate(parse(content, source))]
                except Exception as e:  # one source must not end the poll
                    rows.append((k, source, pos, 0, None, None, f"parse error: {type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "source_url", "source_pos", "n", "url", "title", "error"])

    out = pages.select(key, "source_url", "source_pos", "ok", "message", "content").mapInPandas(run, f"{key} {kind}, source_url string, source_pos long, n long, url string, title string, error string")
    good = out.where("error IS NULL").groupBy(key, "url").agg(F.min_by(F.struct("source_url", "title"), F.struct("source_pos", "n")).alias("_f")).select(key, "url", "_f.*")
    return good, out.where("error IS NOT NULL").select(key, "source_url", "error")


def recent(items: DataFrame, as_of: Column, days: int, date: str = "date") -> DataFrame:
    """Undated items and those older than ``days`` are dropped."""
    return items.where(F.col(date) >= F.date_sub(as_of, days))


def bundle(items: DataFrame, resources: DataFrame, key: str = "url") -> DataFrame:
    """``items`` with the text of the resource that has its URL, final or not, trailing slashes aside; a placeholder where none has.

    ``resources`` has url, final_url, seq and text; the last of a URL wins.
    """
    ways = resources.select("seq", "text", F.explode(F.array_distinct(F.array_compact(F.array("url", "final_url")))).alias("_u"))
    by_url = ways.groupBy(u.slash_key(F.col("_u")).alias("_k")).agg(F.max_by("text", "seq").alias("_text"))
    j = items.join(by_url, u.slash_key(F.col(key)) == F.col("_k"), "left")
    body = F.coalesce("_text", F.lit("NOT MIRRORED"))
    return j.withColumn("section", F.concat(F.lit("==== "), F.col(key), F.lit(" ====\n"), body)).drop("_k", "_text")


def not_mirrored(items: DataFrame, resources: DataFrame, key: str = "url") -> DataFrame:
    """Items that no fetched resource covers by URL or final URL."""
    got = resources.where("status = 'fetched'").select(F.explode(F.array("url", "final_url")).alias("_u")).where("_u IS NOT NULL").select(u.slash_key(F.col("_u")).alias("_k"))
    return items.join(got, u.slash_key(F.col(key)) == F.col("_k"), "left_anti")


def poll_counters(items: DataFrame, errors: DataFrame) -> DataFrame:
    """Six counters of a poll."""
    a = items.agg(F.count_distinct("slug").alias("vendors"), F.count_distinct("source_url").alias("sources"), F.count("*").alias("items"), F.count_if("is_new").alias("new_items"), F.count_if(F.col("date").isNull()).alias("undated"))
    return a.crossJoin(errors.agg(F.count("*").alias("errors")))  # one row each


def cohort(sources: DataFrame) -> DataFrame:
    """Primary kinds over all vendors, most frequent first; vendors without a source count as none."""
    return sources.where(F.col("rank") == 1).groupBy("family").agg(F.count("*").alias("vendors")).orderBy(F.desc("vendors"), "family")
