"""Source divergence audit (12): how the term frequencies of each source differ from those of the others of its language.

Each task counts the terms of its documents in a byte trie whose leaves hold a counter per source. A key is a term, a
zero byte and the language; terms hold no byte below 0x41, so the key order is the UTF-8 order of terms. Tries leave a
task in key order and are merged by prefix range: ranges of keys are dealt to tasks, each of which merges the tries that
reach into its range, and streams the merged trie. Traversal of the kept terms then yields sums for each pair of sources
and the first candidates of each source, both of a size that depends on the number of sources alone.
All arithmetic is in integers.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole_groups

LEAST_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Counters after which a task hands on its trie and starts another; bytes of an edge; bytes of text counted at once, or one text.
LEAVES, STRIDE, SLICE_BYTES = 600_000, 6, 8 << 20
#: Groups of a language and a source whose totals are broadcast at once, some 100 bytes each; languages beyond are taken in further passes.
GROUPS = 200_000
#: Cells of terms by sources that a task handles at once.
CELLS = 2_000_000
#: ASCII letters in lower case and all bytes of other characters stay; the rest separates terms.
_TERM_BYTES = bytes(b if b > 127 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_LISTS = "array<string>", "array<bigint>"


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts in UTF-8, repeats included, and the number of the text that each is from."""
    texts = texts.cast(pa.binary())
    start, end = (texts.offset, texts.offset + len(texts))
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[start : end + 1]
    plain = memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]].tobytes().translate(_TERM_BYTES)
    lists = pc.split_pattern(pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(plain)]), b" ")
    found = lists.flatten()
    filled = pc.greater(pc.binary_length(found), 0)
    return found.filter(filled), np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[filled.to_numpy(zero_copy_only=False)]


class Trie:
    """A radix trie over bytes; an edge carries STRIDE bytes, the last one of a key fewer. A node is [number of its leaf or None, {edge: node}]."""

    def __init__(self) -> None:
        self.root: list = [None, {}]

    def put(self, key: bytes, leaf: int) -> None:
        node = self.root
        for at in range(0, len(key), STRIDE):
            edges, part = node[1], key[at : at + STRIDE]
            if edges is None:
                edges = node[1] = {}
            node = edges.get(part)
            if node is None:
                node = edges[part] = [None, None]
        node[0] = leaf

    def leaves(self) -> Iterator[int]:
        """Leaves in byte order of their keys."""
        stack = [self.root]
        while stack:
            leaf, edges = stack.pop()
            if leaf is not None:
                yield leaf
            if edges:
                stack += [edges[part] for part in sorted(edges, reverse=True)]


class Counts:
    """Occurrences and documents of terms by language and source, kept as columns until the trie is due."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, b: pa.RecordBatch) -> None:
        group = np.array([self.groups.setdefault(k, len(self.groups)) for k in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)])
        found, doc = terms(b.column(0))
        coded = found.dictionary_encode()
        n = max(1, len(coded.dictionary))
        of_doc, times = np.unique(doc * n + coded.indices.to_numpy(), return_counts=True)
        of_group, back = np.unique(group[of_doc // n] * n + of_doc % n, return_inverse=True)
        self._keep(coded.dictionary.take(pa.array(of_group % n)), of_group // n, np.bincount(back, minlength=len(of_group)), np.bincount(back, times, len(of_group)))

    def _keep(self, term: pa.Array, group: np.ndarray, docs: np.ndarray, times: np.ndarray) -> None:
        self.parts.append((term, group, docs.astype(np.int64), times.astype(np.int64)))
        self.size += len(term)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The trie's leaves in byte order: key, documents, and each source with its occurrences."""
        if not self.size:
            return
        coded = pa.concat_arrays([x[0] for x in self.parts]).dictionary_encode()
        group, docs, times = (np.concatenate([x[k] for x in self.parts]) for k in (1, 2, 3))
        langs, lang_of = np.unique([lang for lang, _ in self.groups], return_inverse=True)
        # A counter is a leaf (term and language) and a group.
        leaf = coded.indices.to_numpy().astype(np.int64) * len(langs) + lang_of[group]
        counters, back = np.unique(leaf * len(self.groups) + group, return_inverse=True)
        docs, times = (np.bincount(back, x, len(counters)).astype(np.int64) for x in (docs, times))
        leaf, group = np.divmod(counters, len(self.groups))
        own, starts = np.unique(leaf, return_index=True)
        keys = pc.binary_join_element_wise(coded.dictionary.take(pa.array(own // len(langs))), pa.array([x.encode() for x in langs], pa.binary()).take(pa.array(own % len(langs))), b"\0")
        trie = Trie()
        for k, key in enumerate(keys.to_pylist()):
            trie.put(key, k)
        order = np.fromiter(trie.leaves(), np.int64, len(own))
        sizes = np.diff(np.append(starts, len(leaf)))
        sources = pa.array([s for _, s in self.groups], pa.string())
        for at in range(0, len(order), 50_000):
            part = order[at : at + 50_000]
            n = sizes[part]
            ends = np.cumsum(n)
            cells = np.repeat(starts[part] - ends + n, n) + np.arange(ends[-1])
            offsets = pa.array(np.append(0, ends), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, v) for v in (sources.take(pa.array(group[cells])), pa.array(times[cells]))]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(part)), pa.array(np.add.reduceat(docs[cells], ends - n)), *lists], ["key", "docs", "sources", "counts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gc.disable()  # a trie is many small lists without cycles, which the collector would walk again and again
    counts = Counts()
    for b in batches:
        at = 0
        upto = np.cumsum(pc.binary_length(b.column(0)).to_numpy(zero_copy_only=False))
        while at < len(b):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE_BYTES, "right")))
            counts.add(b.slice(at, end - at))
            at = end
            if counts.size > LEAVES:
                yield from counts.rows()
                counts = Counts()
    yield from counts.rows()
    gc.enable()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tries that reach into one range of keys arrive leaf by leaf in key order; leaves of one key become one, counters of a source are summed."""
    for t in whole_groups(batches, "key", 50_000):
        keys = t.column("key").combine_chunks()
        new = np.concatenate([[True], pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)])
        enough = np.add.reduceat(t.column("docs").to_numpy(), np.flatnonzero(new)) >= LEAST_DOCS
        kept = enough[np.cumsum(new) - 1]
        t = t.filter(pa.array(kept))
        if not len(t):
            continue
        leaf = np.cumsum(new[kept]) - 1  # a kept leaf keeps its first row
        sources, counts = t.column("sources").combine_chunks(), t.column("counts").combine_chunks()
        names = sources.flatten().dictionary_encode()
        cell = np.repeat(leaf, pc.list_value_length(sources).to_numpy(zero_copy_only=False)) * len(names.dictionary) + names.indices.to_numpy()
        cells, back = np.unique(cell, return_inverse=True)
        sums = np.zeros(len(cells), np.int64)
        np.add.at(sums, back, counts.flatten().to_numpy())
        owner, name = np.divmod(cells, len(names.dictionary))
        at = pa.array(np.searchsorted(owner, np.arange(leaf[-1] + 2)), pa.int32())
        parts = [k.split(b"\0", 1) for k in t.column("key").filter(pa.array(new[kept])).to_pylist()]
        lists = [pa.ListArray.from_arrays(at, v) for v in (names.dictionary.take(pa.array(name)), pa.array(sums))]
        yield pa.RecordBatch.from_arrays([pa.array([lang.decode() for _, lang in parts], pa.string()), pa.array([term.decode() for term, _ in parts], pa.string()), *lists], ["lang", "term", "sources", "counts"])


def kept_terms(docs: DataFrame) -> DataFrame:
    """lang, term, sources, counts: each term in LEAST_DOCS documents or more of its language, with its occurrences in each source that has any."""
    leaves = stored(docs.mapInArrow(_count, f"key binary, docs bigint, sources {_LISTS[0]}, counts {_LISTS[1]}"), "trie-leaves")
    ranges = leaves.repartitionByRange("key").sortWithinPartitions("key")
    return stored(ranges.mapInArrow(_merge, f"lang string, term string, sources {_LISTS[0]}, counts {_LISTS[1]}"), "trie-kept")


def shares(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total) by long division, three digits at a time, so that nothing leaves 64 bits."""
    rest, out = counts + 2, 0
    for _ in range(3):
        q, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + q
    return 1 + out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Language:
    """What a task gathers of one language."""

    def __init__(self, totals: tuple[int, list[str], np.ndarray]) -> None:
        self.v, self.names, own = totals
        self.index = {s: k for k, s in enumerate(self.names)}
        self.all, self.own = int(own.sum()) + 2 * self.v, own + 2 * self.v
        self.none = shares(np.zeros(len(own), np.int64), self.own)
        self.base = distance(self.none[:, None], self.none[None, :])
        n = len(own)
        # one: over terms that the first source has; both: over terms that both have. Each is above what a pair gets for a term that neither has.
        self.one, self.both = np.zeros((n, n), np.int64), np.zeros((n, n), np.int64)
        self.best: list[list[tuple[int, str]]] = [[] for _ in own]

    def add(self, names: list[str], c: np.ndarray) -> None:
        """Terms and their counts by source."""
        p, q = shares(c, self.own), shares(c.sum(axis=1), self.all)
        for s in np.flatnonzero(c.any(axis=0)):
            rows = np.flatnonzero(c[:, s])
            above = distance(p[rows], p[rows, s][:, None]) - self.base[s]
            self.one[s] += above.sum(axis=0)
            self.both[s] += (above * (c[rows] > 0)).sum(axis=0)
            rows = rows[p[rows, s] > q[rows]]
            value = distance(p[rows, s], q[rows])
            if len(rows) > TOP:
                near = value >= np.partition(value, -TOP)[-TOP]
                rows, value = rows[near], value[near]
            self.best[s] = sorted(self.best[s] + [(-int(v), names[r]) for r, v in zip(rows, value, strict=True)])[:TOP]


def _traverse(totals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, _Language] = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for lang in dict.fromkeys(langs):
                if lang not in totals.value:
                    continue
                if lang not in of:
                    of[lang] = _Language(totals.value[lang])
                x = of[lang]
                mine = b.take(pa.array(np.flatnonzero(langs == lang)))
                step = max(1, CELLS // len(x.names))
                for at in range(0, len(mine), step):
                    part = mine.slice(at, step)
                    sizes = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
                    columns = [x.index[s] for s in part.column(2).flatten().to_pylist()]
                    c = np.zeros((len(part), len(x.names)), np.int64)
                    c[np.repeat(np.arange(len(part)), sizes), columns] = part.column(3).flatten().to_numpy()
                    x.add(part.column(1).to_pylist(), c)
        for lang, x in of.items():
            for s, name in enumerate(x.names):
                rows = [(x.names[h], int(x.one[s, h]), int(x.both[s, h])) for h in range(len(x.names)) if h != s and (x.one[s, h] or x.both[s, h])]
                rows += [(term, -v, None) for v, term in x.best[s]]
                item, value, both = zip(*rows, strict=True) if rows else ((), (), ())
                columns = [pa.array([lang] * len(rows), pa.string()), pa.array([name] * len(rows), pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64()), pa.array(both, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "value", "both"])

    return run


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language, with the summed distance of the two over all kept terms. Part
    ``term``: the first TOP kept terms that the source uses more than its language does. Null text, lang and source are
    empty strings; a group without terms, or a language without kept terms, has its pairs all the same; equal values
    rank by the item's UTF-8 bytes; repeated rows count as often as they stand; an empty table gives an empty result.
    A source with a third of all rows is counted where its rows lie; only tries leave the tasks.
    Languages are taken in passes of some GROUPS groups each; one language of more sources has more than GROUPS^2 pairs.
    """
    spark = docs.sparkSession
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = kept_terms(plain)
    words = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    groups = plain.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one").join(words, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    groups = stored(groups.join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").withColumn("v", F.coalesce("v", F.lit(0))), "trie-groups")
    passes = 1 + groups.count() // GROUPS
    block = F.pmod(F.xxhash64("lang"), F.lit(passes))
    found = None
    for k in range(passes):
        totals: dict[str, tuple[int, list[str], list[int]]] = {}
        for r in groups.where((block == k) & (F.col("v") > 0)).orderBy("lang", "source").toLocalIterator():
            totals.setdefault(r.lang, (r.v, [], []))
            totals[r.lang][1].append(r.source)
            totals[r.lang][2].append(r.n)
        sent = spark.sparkContext.broadcast({lang: (v, names, np.array(n, np.int64)) for lang, (v, names, n) in totals.items()})
        rows = kept.where(block == k).mapInArrow(_traverse(sent), "lang string, source string, item string, value bigint, both bigint")
        found = rows if found is None else found.unionByName(rows)
    found = stored(found, "trie-found")
    # A pair's sum is that over the terms of the one, plus that over the terms of the other, less that over the terms of both.
    half = found.where("both IS NOT NULL")
    sums = half.select("lang", "source", "item", F.expr("value - both").alias("value")).unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("above"))
    none = lambda n, v: F.expr(f"1 + ({SCALE} * 2L) div ({n} + 2 * {v})")
    own = groups.withColumn("p", F.when(F.col("v") > 0, none("n", "v")))
    other = own.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = own.join(other, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    value = F.when(F.col("v") > 0, F.col("v") * F.expr("((p - q) * (p - q)) div (p + q)") + F.coalesce("above", F.lit(0))).otherwise(0)
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(first))
    top = found.where("both IS NULL").select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP)
    return pairs.unionByName(top)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY ALL HAVING count(DISTINCT i) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
full_c AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + ({SCALE}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM full_c JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT *, 1 + ({SCALE}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM l JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item, coalesce(pairs.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
top AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM top QUALIFY rank <= {TOP})
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
