"""Quality rules (9): a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fold_case, free_prefix, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on not he his are this at from an or have "
    "der die das und ist in zu den von mit ein eine nicht auf für dem des sich als auch "
    "de la le les et des un une du que en est pour dans qui par sur au avec pas il elle "
    "el los las y que en un una por con para se del al su es no lo como"
).split()


class Rule(NamedTuple):
    """Keep a document only while ``low * per <= 100 * metric <= high * per``; a bound of None does not bind."""

    name: str
    metric: str
    per: str
    low: int | None
    high: int | None


#: The threshold table. Metrics and denominators are integer columns, so no rounding takes part.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("stop_words", "n_stop_words", "n_words", 3, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
)


def _measures(text: Column) -> dict[str, Column]:
    body = F.coalesce(text, F.lit(""))
    return {
        "_words": words(body),
        "_lines": F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != ""),
        "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
    }


def _joined(hashes: Column, by: int) -> Column:
    """Hash of each element with the one ``by`` places on; ``by`` elements fewer."""
    n = F.greatest(F.size(hashes) - by, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(by + 1), n), lambda a, b: F.xxhash64(a, b))


def _twins(windows: Column) -> Column:
    """The windows as (hash, place), sorted, where any hash repeats; else an empty array, so most texts sort nothing."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(pairs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeat_words(ordered: Column) -> Column:
    """Words covered by windows that occur at least twice: equal hashes are neighbours in ``ordered``, a column of its own so that no element sorts it anew."""
    ends = F.size(ordered) - 1

    def twin(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(ordered, k - 1)["h"] == x["h"]).otherwise(False)
        after = F.when(k < ends, F.get(ordered, k + 1)["h"] == x["h"]).otherwise(False)
        return before | after

    starts = F.array_sort(F.transform(F.filter(ordered, twin), lambda x: x["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Append the integer measures that the rules read, each name with ``prefix``; columns of ``docs`` stay.

    A null text counts as empty. A window is compared by a 64-bit hash of its eight words.
    Working columns are named apart from those of ``docs`` and dropped; nothing is shuffled.
    """
    m = _measures(F.col(f"`{text}`"))
    t = free_prefix(docs, "_q_")
    first = docs.withColumns({f"{t}words": m["_words"], f"{t}lines": m["_lines"], f"{prefix}word_chars": m["word_chars"], f"{prefix}n_symbols": m["n_symbols"]})
    w, lines = F.col(f"{t}words"), F.col(f"{t}lines")
    n = F.size(w)
    second = first.withColumns(
        {
            f"{prefix}n_words": n.cast("long"),
            f"{prefix}n_lines": F.size(lines).cast("long"),
            f"{prefix}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            f"{prefix}n_stop_words": F.size(F.filter(w, lambda x: fold_case(x).isin(*sorted(set(STOP_WORDS))))).cast("long"),
            f"{t}windows": _joined(w, 1),
        }
    )
    # Windows of two words, then of four, then of eight, each from two of the size before.
    for by in (2, 4):
        second = second.withColumn(f"{t}windows", _joined(F.col(f"{t}windows"), by))
    third = second.withColumn(f"{t}ordered", _twins(F.col(f"{t}windows")))
    fourth = third.withColumn(f"{prefix}n_repeat_words", _repeat_words(F.col(f"{t}ordered")).cast("long"))
    return fourth.drop(f"{t}words", f"{t}lines", f"{t}windows", f"{t}ordered")


def base_failed(prefix: str = "") -> Column:
    n = F.col(f"{prefix}n_words")
    return (n < 20) | (100 * F.col(f"{prefix}n_repeat_words") > 30 * n)


def compile_rules(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """The whole table as one boolean expression; true keeps the document."""
    tests = []
    for r in rules:
        value, per = 100 * F.col(f"{prefix}{r.metric}"), F.col(f"{prefix}{r.per}")
        if r.low is not None:
            tests.append(value >= r.low * per)
        if r.high is not None:
            tests.append(value <= r.high * per)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of ``docs`` (null text: empty, fails the base test).

    Repeated rows are judged one by one; an empty table gives an empty result.
    """
    m = measure(docs.select("doc_id", "text")).withColumn("base_failed", base_failed())
    return m.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & compile_rules(rules)).alias("kept"), "n_lines", "n_stop_words",
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` only; no shuffle."""
    p = free_prefix(docs, "_q_m_")
    judged = measure(docs, prefix=p).withColumn(f"{p}kept", ~base_failed(p) & compile_rules(rules, p))
    # The verdict passes through a generator, else the filter would be pushed below and measure the text again for each rule.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return judged.select(*columns, F.explode(F.array(f"{p}kept")).alias(f"{p}verdict")).where(F.col(f"{p}verdict")).select(*columns)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same projection in DuckDB SQL."""
    tests = []
    for r in rules:
        if r.low is not None:
            tests.append(f"100 * {r.metric} >= {r.low} * {r.per}")
        if r.high is not None:
            tests.append(f"100 * {r.metric} <= {r.high} * {r.per}")
    stops = ", ".join("'" + s + "'" for s in sorted(set(STOP_WORDS)))
    blank = r"[\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
w AS (
  SELECT rid, doc_id, body,
    list_filter(regexp_split_to_array(body, '{blank}'), lambda x: x <> '') AS ws,
    list_filter(string_split(body, chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') AS ls
  FROM d
),
g AS (
  SELECT *, CASE WHEN len(ws) >= {WINDOW}
    THEN list_transform(range(1, len(ws) - {WINDOW - 2}), lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' ')) ELSE [] END AS wins
  FROM w
),
u AS (SELECT rid, unnest(wins) AS win, unnest(range(len(wins))) AS i FROM g WHERE len(list_distinct(wins)) < len(wins)),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM u),
p AS (SELECT rid, i, lag(i, 1, -{WINDOW}) OVER (PARTITION BY rid ORDER BY i) AS prev FROM t WHERE c > 1),
s AS (SELECT rid, sum(least({WINDOW}, i - prev)) AS rep FROM p GROUP BY rid),
r AS (SELECT g.*, coalesce(s.rep, 0) AS rep FROM g LEFT JOIN s USING (rid)),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(body, '{blank}', '', 'g'))::BIGINT AS word_chars,
    (length(body) - length(translate(body, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    rep::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
    len(list_filter(ws, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ({stops})))::BIGINT AS n_stop_words
  FROM r
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(tests)} AS kept, n_lines, n_stop_words
FROM b"""
