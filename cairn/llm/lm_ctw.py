"""LM scoring (8): context-tree weighting over bytes, beside a unigram base.

A byte is eight binary decisions. For each decision there is a tree of contexts of 0 to ``DEPTH`` preceding bytes;
every node has a Krichevsky-Trofimov estimate, and the weighted probability of a node is half its own estimate plus
half the product of its children's. Counts come from all training texts, and all nodes count.

The tree is never stored as nodes. Grams (a context and the byte after it) are counted over the corpus and dealt by the
last ``SPLIT`` bytes of their context; the part of the tree below such a context is weighed at once in the task that
has its grams, at most 2^24 of them. What leaves the task is eight mixed chances a gram, and the sums that the levels
above need, which are few and are built by grouped sums. Grams of held-out texts are in the tables with a count of
zero: they change no estimate and are scored as all others are. Texts are scored by their grams: frequent ones, of
bounded number, are looked up in a broadcast array, the rest by a join to the same values.
The base counts all words: frequent ones, of bounded number, are looked up in a broadcast dictionary, the rest by a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, remainder, stored, whole_groups

DEPTH, SPLIT = 5, 3
FREQUENT_GRAMS = 3_000_000  # 16 bytes each
END = 0xFF  # no byte of UTF-8; ends each text
PIECE = 1 << 20
FREQUENT_WORDS = 200_000
MODULUS, HELD_OUT = 7, 2
_LOG_PI = 1.1447298858494002


def pieces(raw: bytes) -> Iterator[bytes]:
    """A text and its end in pieces, each with the DEPTH bytes before it (zeros at the start)."""
    whole = len(raw) + 1
    for at in range(0, whole, PIECE):
        head = raw[max(0, at - DEPTH) : at]
        yield b"\0" * (DEPTH - len(head)) + head + raw[at : at + PIECE] + (bytes([END]) if at + PIECE >= whole else b"")


def grams(piece: bytes) -> np.ndarray:
    """DEPTH bytes of context and the byte coded, as one integer for each place; the latest byte is the lowest."""
    b = np.frombuffer(piece, np.uint8)
    key = np.zeros(len(b) - DEPTH, np.int64)
    for k in range(DEPTH + 1):
        key = (key << 8) | b[k : len(b) - DEPTH + k]
    return key


def _tally(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys = np.concatenate([k for k, _ in held])
    codes, unique = pd.factorize(keys)
    return [(unique, np.bincount(codes, np.concatenate([n for _, n in held]), len(unique)).astype(np.int64))]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n) and (gram, n), summed up over the task as far as memory allows, then again by Spark. Held-out texts give grams with n = 0."""
    words: Counter[bytes] = Counter()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    raw_keys: dict[bool, list[np.ndarray]] = {True: [], False: []}
    pending = docs = 0

    def rows(word: list[bytes] | None, gram: np.ndarray | None, n) -> pa.RecordBatch:
        size = len(n)
        cols = [pa.array(word, pa.binary()) if word is not None else pa.nulls(size, pa.binary()), pa.array(gram, pa.int64()) if gram is not None else pa.nulls(size, pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, ["word", "gram", "n"])

    def tally_pending() -> None:
        nonlocal pending
        for counted, some in raw_keys.items():
            if some:
                codes, unique = pd.factorize(np.concatenate(some))
                held.append((unique, np.bincount(codes, minlength=len(unique)) * counted))
                some.clear()
        pending = 0

    for b in batches:
        for text, counted in zip(b.column("text"), b.column("counted").to_pylist(), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if counted:
                docs += 1
                words.update(raw.lower().split())
            for piece in pieces(raw):
                raw_keys[counted].append(grams(piece))
                pending += len(raw_keys[counted][-1])
            if pending > PIECE:
                tally_pending()
                if sum(len(k) for k, _ in held) > 1_500_000:
                    held = _tally(held)
                    if len(held[0][0]) > 800_000:
                        yield rows(None, *held[0])
                        held = []
            if len(words) > 400_000:
                yield rows(list(words), None, list(words.values()))
                words = Counter()
    tally_pending()
    if held:
        yield rows(None, *_tally(held)[0])
    if words:
        yield rows(list(words), None, list(words.values()))
    if docs:
        # The end token: a row without word or gram.
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([docs], pa.int64())], ["word", "gram", "n"])


def counts(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """word counts, gram counts (zero for grams of held-out texts alone), and the number of training texts."""
    picked = docs.select("text", (remainder(F.col("doc_id"), MODULUS) != HELD_OUT).alias("counted"))
    rows = picked.mapInArrow(_count_batches, "word binary, gram long, n long")
    sums = stored(rows.groupBy("word", "gram").agg(F.sum("n").alias("n")), "lm-counts")
    ends = sums.where("word IS NULL AND gram IS NULL").agg(F.sum("n")).first()[0] or 0
    return sums.where("word IS NOT NULL").select("word", "n"), sums.where("gram IS NOT NULL").select("gram", "n"), ends


def _lgamma(x: Column) -> Column:
    """log gamma for x >= 0.5: Stirling's series six places further on."""
    y = x + 6
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return series - F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def _kt(a: Column, b: Column) -> Column:
    """log of the KT estimate of a zeros and b ones in any order."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - _LOG_PI


_TABLE = 1 << 10
_LOG_GAMMA = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _TABLE)))])  # of n + 1
_LOG_GAMMA_HALF = np.concatenate([[_LOG_PI / 2], _LOG_PI / 2 + np.cumsum(np.log(np.arange(1, _TABLE) - 0.5))])  # of n + 1/2


def _log_gamma(n: np.ndarray, table: np.ndarray, add: float) -> np.ndarray:
    """log gamma of n + add: from the table, or by Stirling's series beyond it."""
    y = np.maximum(n, _TABLE) + add
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3)
    return np.where(n < _TABLE, table[np.minimum(n, _TABLE - 1).astype(np.int64)], series)


def kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the KT estimate of a zeros and b ones in any order."""
    return _log_gamma(a, _LOG_GAMMA_HALF, 0.5) + _log_gamma(b, _LOG_GAMMA_HALF, 0.5) - _log_gamma(a + b, _LOG_GAMMA, 1.0) - _LOG_PI


def subtree(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Of sorted, distinct grams, all that share their last SPLIT bytes of context: the chance of a one for each of the
    eight bits, all depths from DEPTH to SPLIT mixed, and for each bit (context, prefix, n0, n1, log_pw) of the nodes at SPLIT.
    """
    mixed = np.empty((8, len(key)))
    n = n.astype(np.float64)
    at = np.arange(len(key))  # the row of each gram at the present depth
    up, below, top = at, [], []
    for depth in range(DEPTH, SPLIT - 1, -1):
        if depth < DEPTH:
            key, up = np.unique(key & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
            n, at = np.bincount(up, n), up[at]
        here = []
        for j in range(8):
            part = key >> (8 - j)
            begins = np.append(True, part[1:] != part[:-1])
            starts, node = np.flatnonzero(begins), np.cumsum(begins) - 1
            bit = key >> (7 - j) & 1
            n0, n1 = np.add.reduceat(n * (1 - bit), starts), np.add.reduceat(n * bit, starts)
            own, log_pe = (n1 + 0.5) / (n0 + n1 + 1), kt(n0, n1)
            if depth == DEPTH:
                log_pw, mixed[j] = log_pe, own[node]
            else:
                from_, weighted = below[j]
                kids = np.bincount(node[up[from_]], weighted, len(starts))
                share = 1 / (1 + np.exp(-np.clip(log_pe - kids, -700, 700)))
                log_pw = np.logaddexp(log_pe, kids) - np.log(2)
                mixed[j] = (share * own)[node[at]] + (1 - share)[node[at]] * mixed[j]
            here.append((starts, log_pw))
            if depth == SPLIT:
                first = key[starts]
                top.append((first >> 8, 1 << j | (first & 255) >> (8 - j), n0, n1, log_pw))
        below = here
    return mixed, top


_BITS = [f"q{j}" for j in range(8)]


def _tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of grams with their eight chances, and rows of nodes at SPLIT, with the columns of the others null."""
    names = ["gram", "n", *_BITS, "context", "prefix", "n0", "n1", "log_pw"]
    for t in whole_groups(batches, "part", 150_000):
        key, n = t.column("gram").to_numpy(), t.column("n").to_numpy()
        order = np.argsort(key)
        key, n = key[order], n[order]
        mixed, top = subtree(key, n)
        size = len(key)
        empty = [pa.nulls(size, k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), *map(pa.array, mixed), *empty], names)
        context, prefix, n0, n1, log_pw = (np.concatenate(x) for x in zip(*top, strict=True))
        size = len(context)
        empty = [pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), *[pa.nulls(size, pa.float64())] * 8]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(context, pa.int32()), pa.array(prefix, pa.int32()), pa.array(n0.astype(np.int64)), pa.array(n1.astype(np.int64)), pa.array(log_pw)], names)


def values(gram_counts: DataFrame) -> DataFrame:
    """gram, n, s (log10 probability of the byte after its context, all depths mixed) for each of the distinct grams given."""
    part = F.shiftright("gram", 8).bitwiseAND((1 << 8 * SPLIT) - 1).cast("int")
    dealt = gram_counts.select("gram", "n", part.alias("part")).repartition("part").sortWithinPartitions("part")
    schema = f"gram long, n long, {', '.join(f'{q} double' for q in _BITS)}, context int, prefix int, n0 long, n1 long, log_pw double"
    low = stored(dealt.mapInArrow(_tree_batches, schema), "ctw-low")
    cells = mixed_above(low.where("context IS NOT NULL").select("context", "prefix", "n0", "n1", "log_pw"))
    pair = F.map_from_entries(F.collect_list(F.struct("prefix", F.struct("s", "r").alias("v"))))
    slots = cells.groupBy(F.col("context").alias("c")).agg(pair.alias("m")).select("c", F.transform(F.sequence(F.lit(0), F.lit(255)), lambda k: F.col("m")[k]).alias("v"))
    own = F.shiftright("gram", 8).bitwiseAND((1 << 8 * (SPLIT - 1)) - 1).cast("int")
    rows = low.where("gram IS NOT NULL").select("gram", "n", *_BITS, own.alias("c")).join(slots, "c")

    def log_of(j: int) -> Column:
        v = F.col("v")[F.expr(f"cast(shiftleft(1L, {j}) | shiftright(gram & 255, {8 - j}) AS int)")]
        p = v["s"] + v["r"] * F.col(f"q{j}")
        return F.log10(F.when(F.expr(f"shiftright(gram & 255, {7 - j}) & 1") == 1, p).otherwise(1 - p))

    out = stored(rows.select("gram", "n", sum((log_of(j) for j in range(8)), F.lit(0.0)).alias("s")), "lm-grams")
    drop(low, cells)
    return out


def mixed_above(level: DataFrame) -> DataFrame:
    """context, prefix, s and r of the nodes at SPLIT - 1, by their children: with t the chance of a one below such a
    node, all depths mixed give s + r * t. At most 2^16 contexts of 255 nodes each, whatever the corpus.
    """
    levels: list[DataFrame] = []
    for depth in range(SPLIT - 1, -1, -1):
        up = level.groupBy(F.col("context").bitwiseAND((1 << 8 * depth) - 1).alias("context"), "prefix").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_pw").alias("kids"))
        own = up.withColumn("log_pe", _kt(F.col("n0"), F.col("n1"))).withColumn("gap", F.least(F.greatest(F.col("log_pe") - F.col("kids"), F.lit(-700.0)), F.lit(700.0)))
        weighted = F.greatest("log_pe", "kids") + F.log1p(F.exp(-F.abs("gap"))) - float(np.log(2))
        level = stored(own.select("context", "prefix", "n0", "n1", weighted.alias("log_pw"), "gap"), f"ctw-{depth}")
        levels.append(level)
    out = None
    for depth, level in enumerate(reversed(levels)):
        own = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
        share = 1 / (1 + F.exp(-F.col("gap")))
        if out is not None:
            above = out.select(F.col("context").alias("up"), F.col("prefix").alias("at"), F.col("s").alias("s0"), F.col("r").alias("r0"))
            level = level.join(above, (F.col("context").bitwiseAND((1 << 8 * (depth - 1)) - 1) == F.col("up")) & (F.col("prefix") == F.col("at")))
        else:
            level = level.select("*", F.lit(0.0).alias("s0"), F.lit(1.0).alias("r0"))
        out = level.select("context", "prefix", (F.col("s0") + F.col("r0") * share * own).alias("s"), (F.col("r0") * (1 - share)).alias("r"))
    out = stored(out, "ctw-mixed")
    drop(*levels)
    return out


def _bucket(n: Column) -> Column:
    """Counts by quarter powers of two: some 250 buckets at most."""
    return F.floor(F.log2(n) * 4).cast("int")


def _cut(histogram: list, most: int) -> int:
    """The lowest bucket down to which at most ``most`` members lie; ``histogram`` has (b, v), highest first."""
    least, taken = 1 << 20, 0
    for r in histogram:
        taken += r.v
        if taken > most:
            break
        least = r.b
    return least


def cached(unique: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the grams among the sorted ``keys`` (zero for others), and which those are."""
    if not len(keys):
        return np.zeros(len(unique)), np.zeros(len(unique), bool)
    order = np.argsort(unique)  # in order, since neighbours are then found in the cache
    at = np.empty(len(unique), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, unique[order]), len(keys) - 1)
    met = keys[at] == unique
    return np.where(met, values[at], 0.0), met


def _score_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, frequent = model.value
        get = frequent.get
        for b in batches:
            n = len(b)
            score, base = np.zeros(n), np.zeros(n)
            tokens, known, sizes, rare = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), []
            held: list[np.ndarray] = []
            owner: list[int] = []
            seldom: list[list[np.ndarray]] = [[] for _ in range(n)]
            pending = 0

            def flush(held=held, owner=owner, score=score, seldom=seldom) -> None:
                codes, unique = pd.factorize(np.concatenate(held))
                each, met = cached(unique, keys, values)
                starts = np.concatenate([[0], np.cumsum([len(x) for x in held])[:-1]])
                np.add.at(score, owner, np.add.reduceat(each[codes], starts))
                if not met.all():
                    missed = np.split(~met[codes], starts[1:])
                    for k, x, m in zip(owner, held, missed, strict=True):
                        if m.any():
                            seldom[k].append(x[m])
                held.clear()
                owner.clear()

            for k, text in enumerate(b.column("text")):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                ws = raw.lower().split()
                found = list(map(get, ws))
                hit = [x for x in found if x is not None]
                tokens[k], known[k], base[k], sizes[k] = len(ws) + 1, len(hit), sum(hit), len(raw) + 1
                rare.append([x for x, y in zip(ws, found, strict=True) if y is None] if len(hit) < len(found) else [])
                for piece in pieces(raw):
                    held.append(grams(piece))
                    owner.append(k)
                    pending += len(held[-1])
                    if pending > PIECE:
                        flush()
                        pending = 0
            if held:
                flush()
            cols = [b.column("id"), b.column("doc_id"), b.column("held_out"), pa.array(tokens), pa.array(known), pa.array(sizes), pa.array(base), pa.array(score), pa.array(rare, pa.list_(pa.binary())), pa.array([np.concatenate(x) if x else np.empty(0, np.int64) for x in seldom], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "doc_id", "held_out", "n_tokens", "known", "n_bytes", "base", "score", "rare", "seldom"])

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of ``docs``.

    bits_per_byte is the code length of a text under the model, by its bytes and its end.

    A null text is empty: one token, the end. A null doc_id is not held out. Repeated rows count as often as they
    occur in training and get equal scores. Without training texts every token is unknown and every bit costs one bit.
    """
    spark = docs.sparkSession
    words, gram_counts, ends = counts(docs)
    bucket = _bucket(F.col("n"))
    sizes = words.groupBy(bucket.alias("b")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).orderBy(F.desc("b")).collect()
    vocabulary, total = sum(r.v for r in sizes) + (ends > 0), sum(r.n for r in sizes) + ends
    share = total + vocabulary + 1
    least = _cut(sizes, FREQUENT_WORDS)
    logs = F.log10((F.col("n") + 1) / F.lit(float(share)))
    known = words.where(bucket >= least).select("word", logs.alias("s")).toArrow()
    frequent = dict(zip(known.column(0).to_pylist(), known.column(1).to_pylist(), strict=True))
    del known
    seen = values(gram_counts)
    some = seen.where("n > 0")
    bound = _cut(some.groupBy(bucket.alias("b")).agg(F.count("*").alias("v")).orderBy(F.desc("b")).collect(), FREQUENT_GRAMS)
    often = some.where(bucket >= bound).select("gram", "s").toArrow()
    keys = often.column(0).to_numpy()
    order = np.argsort(keys)
    model = spark.sparkContext.broadcast((keys[order], often.column(1).to_numpy()[order], frequent))
    del often, keys, order

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"), "text")
    schema = f"id long, doc_id {kind}, held_out boolean, n_tokens long, known long, n_bytes long, base double, score double, rare array<binary>, seldom array<long>"
    scored = stored(rows.mapInArrow(_score_batches(model), schema), "lm-scored")
    model.destroy()
    rest = words.where(bucket < least)
    loose = scored.select("id", F.explode("rare").alias("word")).join(rest, "word", "left")
    unseen = F.lit(float(np.log10(1 / share)))
    per = loose.groupBy("id").agg(F.sum(F.coalesce(logs, unseen)).alias("rare_base"), F.count("n").alias("rare_known"))
    end = float(np.log10((ends + 1) / share))
    grams_of = scored.select("id", F.explode("seldom").alias("gram"))
    rest_of = seen.where((F.col("n") == 0) | (bucket < bound)).select("gram", "s")
    per_gram = grams_of.join(rest_of, "gram").groupBy("id").agg(F.sum("s").alias("seldom_score"))
    log_probability = F.col("score") + F.coalesce("seldom_score", F.lit(0.0))
    return scored.drop("rare", "seldom").join(per, "id", "left").join(per_gram, "id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + F.lit(end)).alias("base_score"), log_probability.alias("score"), (-log_probability * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
