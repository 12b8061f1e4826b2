"""Benchmark decontamination (6): spaced-seed hashing with built-in functions only.

A mask such as 1101001011 slides over the words; the words under its ones are hashed, those under its zeros may
differ. Hashes of documents meet those of the benchmark in a join; each hit fixes an alignment, in which the whole
item is compared word by word. Matched places of all alignments of an item in a document are united, so inserted and
deleted words cost no more than substituted ones. Of hits that follow one another in an alignment only the first is
looked at, so repetitive texts give as many alignments as they have words, not as many as they have hits.

Light masks serve items of under 60 words, the lightest those of 7 to 14. Of items with just the 60 % of their words left,
in random places, the masks find 0.98 and more at every length from 7 words on. Shorter items are sought whole and
unaltered: of three words in place out of five nobody can tell whether they were copied.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_case, free_prefix, row_key, stored, words

MASKS = ("1101001011", "1110010101", "1010110011")
LIGHT = ("1111", "11011", "1100101", "1010011")
SHORT = ("111", "1101", "1011")
LIGHT_BELOW, SHORT_BELOW, WHOLE_BELOW = 60, 15, 7
LEAST = 60  # matched words of an item in percent
#: The benchmark's hashes are broadcast, and its words, which are fewer. Beyond so many hashes (some 50 bytes each) it is
#: cut into parts by item, and the documents are read once for each.
BROADCAST_ROWS = 2_000_000


def _hashed_words(text: Column) -> Column:
    return F.transform(words(fold_case(text)), lambda w: F.xxhash64(w))


def _seed(hw: Column, i: Column, n: Column, mask: str, tag: int) -> Column:
    """Hash of the words under the mask's ones from place i; null where the mask runs over an end."""
    under = [F.get(hw, i + k) for k, c in enumerate(mask) if c == "1"]
    return F.when((i >= 0) & (i + len(mask) <= n), F.xxhash64(F.lit(tag), *under))


def _seeds(rows: DataFrame, masks: dict[int, str]) -> DataFrame:
    """One row (_i, _m, _h) for each mask and place; the words array stays a column, read in place and never copied per row."""
    n = F.size("_hw")
    least = min(len(m) for m in masks.values())
    # Rows too short give a null sequence and so no row; a filter would be pushed to the scan and hash all words twice.
    placed = rows.withColumn("_i", F.explode(F.when(n >= least, F.sequence(F.lit(0), n - least))))
    keys = F.array(*[F.struct(F.lit(tag).alias("_m"), _seed(F.col("_hw"), F.col("_i"), n, m, tag).alias("_h")) for tag, m in masks.items()])
    return placed.withColumn("_k", F.explode(keys)).select(*placed.columns, "_k._m", "_k._h").where(F.col("_h").isNotNull())


def _before(masks: dict[int, str]) -> Column:
    """The seed of the place before, by the same mask."""
    out = F.lit(None).cast("long")
    for tag, m in masks.items():
        out = F.when(F.col("_m") == tag, _seed(F.col("_hw"), F.col("_i") - 1, F.size("_hw"), m, tag)).otherwise(out)
    return out


def item_masks(lengths: list[int]) -> list[tuple[int, int, dict[int, str]]]:
    """(from, to, masks by tag) of items by their number of words: heavy masks, light ones, the lightest, and whole items below."""
    heavy, light, short = dict(enumerate(MASKS)), dict(enumerate(LIGHT, 10)), dict(enumerate(SHORT, 20))
    out = [(LIGHT_BELOW, 1 << 31, heavy), (SHORT_BELOW, LIGHT_BELOW - 1, light), (WHOLE_BELOW, SHORT_BELOW - 1, short), *((n, n, {1000 + n: "1" * n}) for n in range(1, WHOLE_BELOW))]
    return [x for x in out if any(x[0] <= n <= x[1] for n in lengths)]


def matches(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, by_key: bool = False) -> DataFrame:
    """doc_id, item_id, item_words, matched_words, first_word for every document that holds ``least`` percent of an item's words in place.

    Items of fewer than WHOLE_BELOW words are sought whole and unaltered; items without words match nothing. Null texts
    have no words. Every row is judged by itself, whatever others share its id; rows equal in id and text count as one,
    on either side. An empty table on either side gives an empty result. With ``by_key`` the row key stands in for doc_id.
    """
    items = stored(benchmark.select("item_id", row_key(F.col("item_id"), F.col("text")).alias("_item"), _hashed_words(F.col("text")).alias("_hw")).where(F.size("_hw") > 0).dropDuplicates(["_item"]), "bench-items")
    # Lengths matter up to LIGHT_BELOW only, so this is a list of bounded size.
    lengths = [r[0] for r in items.select(F.least(F.size("_hw"), F.lit(LIGHT_BELOW))).distinct().collect()]
    ranges = item_masks(lengths)
    if not ranges:
        kinds = [f"doc_id {'long' if by_key else docs.schema['doc_id'].dataType.simpleString()}", f"item_id {benchmark.schema['item_id'].dataType.simpleString()}", "item_words int", "matched_words int", "first_word int"]
        return docs.sparkSession.createDataFrame([], ", ".join(kinds))
    table = {tag: m for _, _, masks in ranges for tag, m in masks.items()}
    parts = [_seeds(items.where(F.size("_hw").between(low, min(high, (1 << 31) - 1))), masks).select("_h", "_item", F.col("_i").alias("_p"), _before(masks).alias("_b")) for low, high, masks in ranges]
    seeds = stored(reduce(DataFrame.unionByName, parts), "bench-seeds")
    slices = -(-seeds.count() // BROADCAST_ROWS)
    key = row_key(F.col("doc_id"), F.col("text"))
    own = docs.select(key.alias("_key"), (key if by_key else F.col("doc_id")).alias("doc_id"), _hashed_words(F.col("text")).alias("_hw"))
    found = None
    for k in range(slices):
        mine = (lambda df, k=k: df.where(F.pmod(F.col("_item"), F.lit(slices)) == k)) if slices > 1 else (lambda df: df)
        part = _matches(own, table, mine(seeds), mine(items), least)
        found = part if found is None else found.unionByName(part)
    return found


def _matches(own: DataFrame, table: dict[int, str], seeds: DataFrame, items: DataFrame, least: int) -> DataFrame:
    hits = _seeds(own, table).join(F.broadcast(seeds), "_h")
    # A hit after a hit of the same mask and alignment adds nothing.
    begins = hits.where(~F.coalesce(_before(table) == F.col("_b"), F.lit(False))).withColumn("_at", F.col("_i") - F.col("_p"))
    facts = items.select("_item", "item_id", F.col("_hw").alias("_iw"))
    joined = begins.select("_key", "doc_id", "_item", "_at", "_hw").join(F.broadcast(facts), "_item")
    placed = joined.withColumn("_k", F.explode(F.sequence(F.lit(0), F.size("_iw") - 1)))
    same = F.when(F.col("_at") + F.col("_k") >= 0, F.get("_hw", F.col("_at") + F.col("_k"))) == F.get("_iw", F.col("_k"))
    ids = ["_key", "doc_id", "_item", "item_id", "item_words"]
    met = placed.where(same).select("_key", "doc_id", "_item", "item_id", F.size("_iw").alias("item_words"), "_k", F.greatest(F.col("_at"), F.lit(0)).alias("_start"))
    once = met.groupBy(*ids, "_k").agg(F.min("_start").alias("_start"))
    per = once.groupBy(*ids).agg(F.count("*").cast("int").alias("matched_words"), F.min("_start").alias("first_word"))
    return per.where(100 * F.col("matched_words") >= least * F.col("item_words")).select("doc_id", "item_id", "item_words", "matched_words", "first_word")


def remove(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows and columns are else unchanged."""
    k = free_prefix(docs, "_d_") + "key"
    found = stored(matches(docs, benchmark, least, by_key=True).select(F.col("doc_id").alias(k)).distinct(), "contaminated")
    return docs.join(found, row_key(docs["doc_id"], docs["text"]) == found[k], "left_anti")


def _keys_sql(array: str, i: str, n: str, whole: bool) -> str:
    """Seeds of a document, or with ``whole`` of an item, by the masks of its length."""
    parts = []
    for masks, tag0, when in ((MASKS, 0, f"{n} >= {LIGHT_BELOW}"), (LIGHT, 10, f"{n} BETWEEN {SHORT_BELOW} AND {LIGHT_BELOW - 1}"), (SHORT, 20, f"{n} BETWEEN {WHOLE_BELOW} AND {SHORT_BELOW - 1}")):
        for tag, m in enumerate(masks, tag0):
            under = " || ' ' || ".join(f"{array}[{i} + {k + 1}]" for k, c in enumerate(m) if c == "1")
            parts.append(f"CASE WHEN {i} + {len(m)} <= {n}{' AND ' + when if whole else ''} THEN '{tag}:' || {under} END")
    return f"[{', '.join(parts)}]"


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SPAN = min(map(len, MASKS + LIGHT + SHORT))
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM (SELECT DISTINCT doc_id, text FROM documents)),
b AS (SELECT row_number() OVER () AS bid, item_id, {_WORDS} AS iw FROM (SELECT DISTINCT item_id, text FROM benchmark)),
dp AS (SELECT rid, ws, len(ws) AS n, unnest(range(0, greatest(len(ws) - {_SPAN} + 1, 0))) AS i FROM d),
ds AS (SELECT rid, i, unnest({_keys_sql('ws', 'i', 'n', False)}) AS h FROM dp),
bp AS (SELECT bid, iw, len(iw) AS n, unnest(range(0, greatest(len(iw) - {_SPAN} + 1, 0))) AS i FROM b),
bs AS (SELECT bid, i, unnest({_keys_sql('iw', 'i', 'n', True)}) AS h FROM bp),
sd AS (SELECT rid, unnest(range(0, len(ws) - s.n + 1)) AS i, ws, s.n FROM d, (SELECT DISTINCT len(iw) AS n FROM b WHERE len(iw) BETWEEN 1 AND {WHOLE_BELOW - 1}) s WHERE len(ws) >= s.n),
hits AS (
  SELECT DISTINCT rid, bid, ds.i - bs.i AS dg FROM ds JOIN bs USING (h)
  UNION SELECT DISTINCT rid, bid, sd.i AS dg FROM sd JOIN b ON len(b.iw) = sd.n AND array_to_string(b.iw, ' ') = array_to_string(sd.ws[sd.i + 1:sd.i + sd.n], ' ')
),
al AS (SELECT rid, bid, d.doc_id, b.item_id, len(b.iw) AS item_words, h.dg, d.ws, b.iw FROM hits h JOIN d USING (rid) JOIN b USING (bid)),
mt AS (
  SELECT rid, bid, doc_id, item_id, item_words, greatest(dg, 0) AS first_word,
    list_filter(range(0, item_words), lambda k: dg + k >= 0 AND dg + k < len(ws) AND ws[dg + k + 1] = iw[k + 1]) AS same FROM al
)
SELECT doc_id, item_id, item_words::INTEGER AS item_words, matched_words::INTEGER AS matched_words, first_word::INTEGER AS first_word
FROM (SELECT rid, bid, doc_id, item_id, item_words, len(list_distinct(flatten(list(same)))) AS matched_words, min(first_word) AS first_word FROM mt GROUP BY ALL)
WHERE 100 * matched_words >= {LEAST} * item_words"""
