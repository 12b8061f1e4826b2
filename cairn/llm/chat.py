"""Chat formatting (7): multi-party perspective rotation.

A conversation is rendered once for each participant: that speaker's turns become the assistant's, which alone are
trained on; all others become turns of named users, and system turns stay system turns. Masks are character spans of
the rendered text. A conversation is rendered in parts by turn number, which concatenate to the whole, so no task holds
a long one and a part depends on its turns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 512
SYSTEM = "system"
_SYSTEM_HEAD, _OWN_HEAD = "<|system|>\n", "<|assistant|>\n"


def _user_head(role: Column) -> Column:
    return F.when(role.eqNullSafe(F.lit(SYSTEM)), F.lit(_SYSTEM_HEAD)).otherwise(F.concat(F.lit("<|user name="), F.coalesce(role, F.lit("unknown")), F.lit("|>\n")))


def _body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _views(t: DataFrame) -> DataFrame:
    """_c, _t (conversation and part), perspective, char_offset: for each participant each part, and where it starts in the whole.

    Lengths are summed by role first, so these are a few numbers a part; texts take no part.
    """
    sums = t.groupBy("conv_id", "part", "role").agg(F.count("*").alias("n"), F.sum(F.length(_body(F.col("text")))).alias("chars"))
    head = F.length(_user_head(F.col("role")))
    parts = sums.groupBy("conv_id", "part").agg(F.sum(F.col("chars") + F.col("n") * head).alias("chars"))
    own = sums.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(F.col("conv_id").alias("_oc"), F.col("part").alias("_op"), F.col("role").alias("_or"), (F.col("n") * (F.lit(len(_OWN_HEAD)) - head)).alias("less"))
    speakers = own.select(F.col("_oc").alias("_c"), F.col("_or").alias("perspective")).distinct()
    each = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_c")))
    each = each.join(own, F.col("conv_id").eqNullSafe(F.col("_oc")) & F.col("part").eqNullSafe(F.col("_op")) & (F.col("perspective") == F.col("_or")), "left")
    before = Window.partitionBy("conv_id", "perspective").orderBy(F.col("part").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("chars") + F.coalesce("less", F.lit(0))).over(before), F.lit(0))
    return each.select(F.col("conv_id").alias("_c"), F.col("part").alias("_t"), "perspective", offset.cast("long").alias("char_offset"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, text, masks (array of start, end in the part), n_turns, n_masked, char_offset (of the part in the whole).

    Participants are the distinct roles but system; a null role speaks as ``unknown`` and is no participant, so a
    conversation without participants has no rows. Turns are ordered by turn (null last), then role and text; repeated
    rows are repeated turns. Turns 0 to ``part_turns`` - 1 are part 0, and so on; turns without a number are a part of
    their own, null, the last. A null text is empty, a null conv_id a conversation of its own; an empty table gives an
    empty result. However many turns there are, a part holds only those that share its numbers.
    """
    t = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.floor(F.col("turn") / part_turns).cast("long").alias("part"))
    order = F.struct(F.col("turn").isNull().alias("late"), "turn", F.col("role").isNull().alias("anon"), "role", F.col("text").isNull().alias("mute"), "text")
    # Turns are gathered once; each perspective then takes them where they are.
    gathered = t.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    one = gathered.join(_views(t), F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("part").eqNullSafe(F.col("_t"))).drop("_c", "_t")

    def line(x: Column) -> Column:
        own = x["role"].eqNullSafe(F.col("perspective"))
        return F.struct(F.when(own, F.lit(_OWN_HEAD)).otherwise(_user_head(x["role"])).alias("head"), _body(x["text"]).alias("body"), own.alias("own"))

    one = one.withColumn("lines", F.transform("turns", line))
    text = F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "")
    span = "array<struct<start:bigint,end:bigint>>"
    masks = F.aggregate(
        "lines",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("m")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["head"]) + F.length(x["body"])).cast("long").alias("at"),
            F.when(x["own"], F.concat(a["m"], F.array(F.struct((a["at"] + F.length(x["head"])).cast("long").alias("start"), (a["at"] + F.length(x["head"]) + F.length(x["body"])).cast("long").alias("end"))))).otherwise(a["m"]).cast(span).alias("m"),
        ),
        lambda a: a["m"],
    )
    made = one.select("conv_id", "perspective", "part", text.alias("text"), masks.alias("masks"), F.size("turns").alias("n_turns"), "char_offset")
    return made.select("conv_id", "perspective", "part", "text", "masks", "n_turns", F.size("masks").alias("n_masked"), "char_offset")


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, role, text, floor(turn / {PART_TURNS}.0)::BIGINT AS part FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role IS NOT NULL AND role <> 'system'),
l AS (
  SELECT t.conv_id, perspective, turn, role, text, part,
    CASE WHEN role = 'system' THEN '<|system|>' WHEN role = perspective THEN '<|assistant|>' ELSE '<|user name=' || coalesce(role, 'unknown') || '|>' END || chr(10) AS head,
    coalesce(text, '') || '<|end|>' || chr(10) AS body, coalesce(role = perspective, false) AS own
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
),
w AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM l),
o AS (SELECT *, min(pos) OVER (PARTITION BY conv_id, perspective, part) AS base FROM w)
SELECT conv_id, perspective, part, string_agg(head || body, '' ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS text,
  coalesce(string_agg((pos - base + length(head))::BIGINT || '-' || (pos - base + length(head) + length(body))::BIGINT, ',' ORDER BY pos) FILTER (own), '') AS masks,
  count(*)::INTEGER AS n_turns, (count(*) FILTER (own))::INTEGER AS n_masked, base::BIGINT AS char_offset
FROM o GROUP BY conv_id, perspective, part, base"""


def result(turns: DataFrame) -> DataFrame:
    """rotate() with the masks as text, start-end and commas between."""
    flat = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return rotate(turns).withColumn("masks", flat)
