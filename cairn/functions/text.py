"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .trims import rstrip, strip


def slugify(text: Column, limit: int = 80, default: str = "item") -> Column:
    """Runs of anything but ASCII letters and digits become one hyphen; lower case, at most ``limit`` characters."""
    bare = F.lower(strip("-", F.regexp_replace(text, r"[^A-Za-z0-9]+", "-")))
    return F.coalesce(F.nullif(F.left(bare, F.lit(limit)), F.lit("")), F.lit(default))


def slug_key(text: Column) -> Column:
    return F.replace(F.lower(F.trim(text)), F.lit("_"), F.lit("-"))


def collapse(text: Column) -> Column:
    """White space runs as single spaces, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncate_words(text: Column, n: int = 100) -> Column:
    """At most ``n`` words; a cut text loses trailing punctuation and gains an ellipsis."""
    w = words(text)
    cut = F.concat(rstrip(",.;:", F.array_join(F.slice(w, 1, n), " ")), F.lit("…"))
    return F.when(text.isNull(), text).when(F.size(w) > n, cut).otherwise(text)


def title_label(text: Column) -> Column:
    """Hyphens and underscores as spaces, each word with an initial capital."""
    return F.initcap(F.translate(text, "-_", "  "))


def markdown_to_text(text: Column) -> Column:
    """Lines without trailing blanks, blank lines dropped."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: F.trim(x) != ""), "\n")


def html_to_text(html: Column) -> Column:
    """Text nodes, one a line, without script, style, noscript and svg; entities of the five basic kinds are resolved.

    The pattern form keeps to built-in functions; ``cairn.functions.udfs.html_to_text`` parses properly.
    """
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript|svg)\b[^>]*>.*?</\1\s*>", "\n")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->", "\n"), r"(?s)<[^>]*>", "\n")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    lines = F.transform(F.split(bare, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def best_text(markdown: Column, html: Column) -> Column:
    """Text of the markdown, else of the HTML, else empty."""
    return F.coalesce(F.nullif(markdown_to_text(markdown), F.lit("")), F.nullif(html_to_text(html), F.lit("")), F.lit(""))


def snippet(text: Column, line_start: Column, line_end: Column) -> Column:
    """Lines ``line_start`` to ``line_end``, counted from 1; null where the range leaves the text."""
    lines = F.split(text, "\n")
    inside = (line_start >= 1) & (line_end >= line_start) & (line_end <= F.size(lines))
    return F.when(inside, F.array_join(F.slice(lines, line_start, line_end - line_start + 1), "\n"))


def resource_id(n: Column) -> Column:
    return F.concat(F.lit("resource-"), F.lpad(n.cast("string"), F.greatest(F.lit(4), F.length(n.cast("string"))), F.lit("0")))


def resource_number(rid: Column) -> Column:
    return F.regexp_extract(rid, r"-(\d+)$", 1).try_cast("int")


def search_string(*parts: Column) -> Column:
    """Non-empty parts, spaces between, lower case."""
    return F.lower(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def matches_tokens(text: Column, tokens: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(t.replace(".", r"\.") for t in tokens))
