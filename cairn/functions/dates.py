"""Dates in URLs and text; ``as_of`` stands in for today, so that runs repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR = "2010-01-01"
# The month names that a date may be written with.
MONTHS = r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
# The four strict forms, in order.
FORMS = (rf"\b{MONTHS}\s+\d{{1,2}},?\s+20\d{{2}}\b", rf"\b\d{{1,2}}\s+{MONTHS}\s+20\d{{2}}\b", r"\b20\d{2}-\d{1,2}-\d{1,2}\b", r"\b\d{1,2}/\d{1,2}/20\d{2}\b")


def plausible(d: Column, as_of: Column) -> Column:
    """The date, unless it lies before 2010 or more than two days ahead."""
    return F.when(d.between(F.lit(FLOOR).cast("date"), F.date_add(as_of, 2)), d)


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")


def from_url(path: Column, as_of: Column) -> Column:
    """/YYYY/MM or /YYYY/MM/DD in a path; the day is 1 where it lacks."""
    p = r"/(20\d{2})/(\d{1,2})(?:/(\d{1,2}))?(?=/|$)"
    y, m, d = (F.regexp_extract(path, p, k) for k in (1, 2, 3))
    return F.when(y != "", plausible(_ymd(y, m, F.coalesce(F.nullif(d, F.lit("")), F.lit("1"))), as_of))


def _month_number(name: Column) -> Column:
    at = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.left(F.lower(name), F.lit(3)))
    return ((at + 2) / 3).cast("int").cast("string")


def parse_form(text: Column, k: int) -> Column:
    """The first match of the k-th form as a date, or null."""
    m = F.regexp_substr(text, F.lit("(?i)" + FORMS[k]))
    n = lambda i: F.regexp_extract(m, r"(\d+)\D+(\d+)(?:\D+(\d+))?", i)
    month = F.regexp_extract(m, r"([A-Za-z]+)", 1)
    if k == 0:
        return _ymd(n(2), _month_number(month), n(1))
    if k == 1:
        return _ymd(n(2), _month_number(month), n(1))
    if k == 2:
        return _ymd(n(1), n(2), n(3))
    # Month first; where that gives no month, day first.
    return F.when(n(1).try_cast("int") <= 12, _ymd(n(3), n(1), n(2))).otherwise(_ymd(n(3), n(2), n(1)))


def in_text(text: Column, as_of: Column) -> Column:
    """The first plausible date of the four forms, tried in order."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.coalesce(*[plausible(parse_form(flat, k), as_of) for k in range(4)])


def parse_value(text: Column, as_of: Column) -> Column:
    """A single date value: year, month and day with or without time, else one of the strict forms."""
    part = lambda k: F.regexp_extract(F.trim(text), r"^(20\d{2})([-/.]?)(\d{2})\2(\d{2})(?:$|[T ])", k)
    return F.coalesce(plausible(_ymd(part(1), part(3), part(4)), as_of), in_text(text, as_of))


def with_free_date(df: DataFrame, text: str, as_of: Column, out: str = "date") -> DataFrame:
    """``df`` with a date of a value in any form: what the strict forms do not read goes through a parser of free text, and nothing else does."""
    from .udfs import fuzzy_date

    strict = df.withColumn(out, parse_value(F.col(text), as_of))
    loose = strict.withColumn("_loose", fuzzy_date(F.when(F.col(out).isNull(), F.col(text))))
    return loose.withColumn(out, F.coalesce(out, plausible(F.col("_loose"), as_of))).drop("_loose")


def strip_leading(text: Column) -> Column:
    """A title without the date at its head."""
    head = "|".join(f[2:] if f.startswith(r"\b") else f for f in FORMS)
    return F.regexp_replace(text, rf"(?i)^(?:{head})[ :\-—]*", "")


def age_days(at: Column, now: Column) -> Column:
    """Fractional days between two timestamps."""
    return (F.unix_micros(now) - F.unix_micros(at)) / F.lit(8.64e10)


def freshness(d: Column, as_of: Column, stale_after: int = 30) -> Column:
    return F.when(d.isNull(), "unknown").when(F.date_diff(as_of, d) > stale_after, "stale").otherwise("fresh")


def short_date(d: Column) -> Column:
    return F.upper(F.date_format(d, "dd MMM"))


def iso_seconds(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def reviewed_at(report_ts: Column, profile_ts: Column, products_ts: Column, default: str = "2026-05-03") -> Column:
    """First ten characters of the first non-empty source."""
    return F.left(F.coalesce(*[F.nullif(c, F.lit("")) for c in (report_ts, profile_ts, products_ts)], F.lit(default)), F.lit(10))
