"""Toxicity (11): weak supervision. Many voters, a generative label model over their votes, a linear classifier on its posterior.

Voters are lexicons and patterns. Some lexicons are fixed; others are mined from labelled documents: whole words,
beginnings of words, and beginnings that two or three different words of a text share, as inflected forms do. Each is
mined from all folds of the labelled documents but one, so that a voter's faults on the fold it has not seen are honest. A voter fires or not, so a document's votes are a bit mask; how often each mask occurs, over
all documents that may be learned from, is all that the label model needs, and is bounded by the number of masks.
The label model has two classes. In each, voters form a tree: a voter depends on one other, the one with which it shares
most information given the class, so correlated voters do not count twice. It is estimated by expectation maximisation;
labels start it and stand as they are, all other documents follow the model. The classifier is a logistic regression on
the cues that a document holds, fitted to the posterior of a bounded sample of documents.
Texts are read twice: those of the labelled sample to mine cues, and all of them once for cues and votes.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import remainder, stored

#: Cues are mined from so many labelled documents at most, those of smallest hash; the best so many reach the driver.
TRAIN_DOCS, CANDIDATES = 16_384, 20_000
#: The classifier is fitted to so many documents at most, and knows so many mined cues.
FIT_DOCS, CUES = 16_384, 480
FOLDS, SHORTEST, LONGEST, LEVELS, SHINGLE = 5, 3, 8, 3, 3
#: A mined cue is in so many toxic documents and such a share of them at least, is so many times likelier in them, and so unlikely by chance (G2 statistic).
#: The share keeps out rare words of a toxic text with near copies; documents whose least shingle is the same count once.
LEAST_TOXIC, LEAST_SHARE, LEAST_RATIO, LEAST_G2 = 3, 0.01, 16.0, 15.0
ROUNDS, SMOOTH, PENALTY, FIXED_WEIGHT = 40, 0.5, 0.02, 4.0
MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Words remembered by a task, with their cues.
CACHE = 300_000

#: Lexicons of abuse.
LEXICONS = {
    "stupidity": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile fool dimwit halfwit brainless".split(),
    "worth": "worthless useless trash garbage scum filth vermin loser losers parasite nobody".split(),
    "contempt": "pathetic disgusting clown clowns ridiculous disgrace repulsive despicable".split(),
    "other languages": "imbécile crétin ordure débile abruti dummkopf trottel abschaum widerlich vollidiot imbécil estúpido basura asqueroso inútil".split(),
}
PATTERNS = ("disguised", "stretched", "spelled")
VOTERS = [*LEXICONS, *PATTERNS, *[f"mined {form} without fold {k}" for k in range(FOLDS) for form in ("cues", "shared beginnings")], "several"]
_KNOWN = {w: k for k, ws in enumerate(LEXICONS.values()) for w in ws}
_LETTERS = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"(?:[^\W\d_][.\-_*])+[^\W\d_]")
_STRETCHED = re.compile(r"(.)\1{2,}")
_SIGNS = ".,;:?#*%&\"'()[]{}<>|-_~`"
_DISGUISE = str.maketrans("013457@$!", "oieastasi")
_FIRST_MINED = len(LEXICONS) + len(PATTERNS)
_SEVERAL = 1 << len(VOTERS) - 1
_WORD_END, _TIMES = "$", "*"


def tokens(text: str | None) -> set[str]:
    return set((text or "").lower().split())


def cues_of(word: str) -> list[str]:
    """The beginnings of a word, and the whole word with a mark at its end."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [word + _WORD_END]


def levels(counts: Counter) -> Iterator[str]:
    """Cues of a text, from how many different words show each: the cue, and ``cue*2``, ``cue*3`` if so many do."""
    for cue, n in counts.items():
        yield cue
        for k in range(2, min(n, LEVELS) + 1):
            yield f"{cue}{_TIMES}{k}"


def shared(cue: str) -> bool:
    """Whether a cue is a beginning that several words must show."""
    return _TIMES in cue


def patterns(token: str) -> list[int]:
    """Which of PATTERNS a token shows: a known word with other signs for letters, with stretched letters, or letter by letter."""
    bare = token.rstrip(_SIGNS + "$!").lstrip(_SIGNS)
    if not bare or bare.isalpha() and not _STRETCHED.search(bare):
        return []
    undone = bare.translate(_DISGUISE)
    once, twice = _STRETCHED.sub(r"\1", bare), _STRETCHED.sub(r"\1\1", bare)
    spelled = _SPELLED.fullmatch(bare)
    found = [undone != bare and undone in _KNOWN, bare not in _KNOWN and (once in _KNOWN or twice in _KNOWN), bool(spelled) and "".join(_LETTERS.findall(bare)) in _KNOWN]
    return [k for k, hit in enumerate(found) if hit]


class Cues:
    """Numbered cues and the voters that each of them makes fire. Fixed words and patterns have the first numbers."""

    def __init__(self, mined: list[tuple[str, int]]) -> None:
        fixed = [(w + _WORD_END, 1 << k) for w, k in _KNOWN.items()]
        self.names = [*PATTERNS, *[w for w, _ in fixed]]
        self.of = {w: (len(PATTERNS) + k, bit) for k, (w, bit) in enumerate(fixed)}
        self.fixed = len(self.names)
        for cue, bits in mined:
            number, had = self.of.get(cue, (len(self.names), 0))
            if number == len(self.names):
                self.names.append(cue)
            self.of[cue] = number, had | bits
        self.plain = {w.split(_TIMES)[0] for w in self.of}
        self.cache: dict[str, tuple[tuple[int, ...], tuple[tuple[str, list[str]], ...]]] = {}

    def token(self, token: str) -> tuple[tuple[int, ...], tuple[tuple[str, list[str]], ...]]:
        """Patterns that a token shows, and its words with those of their cues that count."""
        words = ((w, [c for c in cues_of(w) if c in self.plain]) for w in _LETTERS.findall(token))
        return tuple(patterns(token)), tuple((w, c) for w, c in words if c)

    def document(self, text: str | None) -> tuple[int, list[int]]:
        """Votes as a bit mask, and the numbers of the cues found."""
        shown: set[int] = set()
        words: dict[str, list[str]] = {}
        cache = self.cache
        for t in tokens(text):
            got = cache.get(t)
            if got is None:
                if len(cache) >= CACHE:
                    cache.clear()
                got = cache[t] = self.token(t)
            if got[1]:
                words.update(got[1])
            if got[0]:
                shown.update(got[0])
        if not words and not shown:
            return 0, []
        mask = sum(1 << len(LEXICONS) + k for k in shown)
        found = set(shown)
        sure = len(shown)
        for cue in levels(Counter(c for cues in words.values() for c in cues)):
            number, bits = self.of.get(cue, (None, 0))
            if number is not None:
                found.add(number)
                mask |= bits
        sure += sum(any(c in self.of for c in cues) for cues in words.values())
        return mask | (_SEVERAL if sure > 1 else 0), sorted(found)


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of a text's shingles of SHINGLE words: exact copies share it, near copies most often."""
    for b in batches:
        least = []
        for text in b.column(0):
            ws = (text.as_py() or "").lower().split()
            least.append(min(xxh64_intdigest(" ".join(ws[k : k + SHINGLE])) for k in range(max(1, len(ws) - SHINGLE + 1))) - (1 << 63))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.int64())], [*b.schema.names, "signature"])


def _mining_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cue, in how many documents of each fold and label it is: a list of 2 * FOLDS counts."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0] * (2 * FOLDS))

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.list_(pa.int64()))], ["cue", "n"])

    for b in batches:
        for text, at in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            words = {w for t in tokens(text.as_py()) for w in _LETTERS.findall(t)}
            for cue in levels(Counter(c for w in words for c in cues_of(w))):
                counts[cue][at] += 1
            if len(counts) > 200_000:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def g2(n1: np.ndarray, n0: np.ndarray, all1: float, all0: float) -> np.ndarray:
    """Log likelihood ratio of a cue's counts in toxic and clean documents against equal shares."""
    share = (n1 + n0) / max(all1 + all0, 1)
    own = lambda n, a: n * np.log(np.maximum(n, 1e-9) / np.maximum(a * share, 1e-9))
    rest = lambda n, a: (a - n) * np.log(np.maximum(a - n, 1e-9) / np.maximum(a * (1 - share), 1e-9))
    return 2 * (own(n1, all1) + own(n0, all0) + rest(n1, all1) + rest(n0, all0))


def telling(cues: list[str], n1: np.ndarray, n0: np.ndarray, all1: float, all0: float) -> list[str]:
    """Cues that tell of toxic documents, best first; one is left out if a better one that begins it, or that it begins, tells about as surely."""
    ratio = ((n1 + 0.5) / (all1 + 1)) / ((n0 + 0.5) / (all0 + 1))
    score = g2(n1, n0, all1, all0)
    kept: dict[str, dict[str, float]] = defaultdict(dict)  # by first letters: cue, clean documents a toxic one
    out = []
    for k in sorted(np.flatnonzero((n1 >= max(LEAST_TOXIC, LEAST_SHARE * all1)) & (ratio >= LEAST_RATIO) & (score >= LEAST_G2)), key=lambda k: (-score[k], len(cues[k]), cues[k])):
        (start, _, times), impure, near = cues[k].partition(_TIMES), n0[k] / n1[k], kept[cues[k][:SHORTEST]]
        for other, clean in near.items():
            begin, _, least = other.partition(_TIMES)
            if (start.startswith(begin) or begin.startswith(start)) and (least or "1") <= (times or "1") and clean <= impure + 0.02:
                break
        else:
            near[cues[k]] = impure
            out.append(cues[k])
    return out


def mined_cues(sample: DataFrame) -> list[tuple[str, int]]:
    """Cues with the voters they belong to. ``sample``: text, cell (fold, or FOLDS + fold if toxic)."""
    size = dict(sample.groupBy("cell").count().collect())
    all0, all1 = ([size.get(k + at, 0) for k in range(FOLDS)] for at in (0, FOLDS))
    sums = [F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(2 * FOLDS)]
    toxic, clean = (sum((F.col(f"n{k + at}") for k in range(FOLDS)), F.lit(0)) for at in (FOLDS, 0))
    found = sample.select("text", "cell").mapInArrow(_mining_batches, "cue string, n array<bigint>").groupBy("cue").agg(*sums)
    found = found.where(toxic >= LEAST_TOXIC).orderBy((toxic / max(sum(all1), 1) - clean / max(sum(all0), 1)).desc(), "cue").limit(CANDIDATES).collect()
    if not found:
        return []
    cues, n = [r.cue for r in found], np.array([r[1:] for r in found], float)
    n0, n1 = n[:, :FOLDS], n[:, FOLDS:]
    bits: dict[str, int] = dict.fromkeys(telling(cues, n1.sum(axis=1), n0.sum(axis=1), sum(all1), sum(all0))[:CUES], 0)
    for k in range(FOLDS):
        rest = [f for f in range(FOLDS) if f != k]
        for cue in telling(cues, n1[:, rest].sum(axis=1), n0[:, rest].sum(axis=1), sum(all1[f] for f in rest), sum(all0[f] for f in rest))[:CUES]:
            bits[cue] = bits.get(cue, 0) | 1 << _FIRST_MINED + 2 * k + shared(cue)
    return list(bits.items())


class LabelModel:
    """Two classes; in each a tree of voters. ``masks`` are distinct vote masks, with how many unlabelled, toxic and clean documents show each."""

    def __init__(self, masks: np.ndarray, unlabelled: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> None:
        self.masks = masks
        self.votes = masks[:, None] >> np.arange(len(VOTERS)) & 1
        fired = self.votes[:, :-1].sum(axis=1)
        guess = np.choose(np.minimum(fired, 2), [0.02, 0.6, 0.95])
        self.posterior = (toxic + 4 * guess) / (toxic + clean + 4)
        for _ in range(ROUNDS):
            self._maximise(unlabelled * self.posterior + toxic, unlabelled * (1 - self.posterior) + clean)
            log = [np.log(self.prior[c]) + self._log_likelihood(c) for c in (0, 1)]
            self.posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))

    def _maximise(self, toxic: np.ndarray, clean: np.ndarray) -> None:
        """Class shares, the tree, and the chances of a voter given its parent's vote, in each class."""
        m = len(VOTERS)
        weight = np.array([clean, toxic])
        self.prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        pair = np.zeros((2, 2, 2, m, m))  # class, votes of the two
        for c in (0, 1):
            for a in (0, 1):
                for b in (0, 1):
                    pair[c, a, b] = (weight[c][:, None] * (self.votes == a)).T @ (self.votes == b).astype(float)
        pair = (pair + SMOOTH / 4) / (weight.sum(axis=1) + SMOOTH)[:, None, None, None, None]
        own = np.array([[np.diagonal(pair[c, a, a]) for a in (0, 1)] for c in (0, 1)])
        own /= own.sum(axis=1, keepdims=True)
        independent = own[:, :, None, :, None] * own[:, None, :, None, :]
        common = (self.prior[:, None, None, None, None] * pair * np.log(pair / independent)).sum(axis=(0, 1, 2))
        self.accuracy, self.pair = own, pair
        self.parent = np.full(m, -1)
        inside = [0]
        while len(inside) < m:  # Prim: the strongest link that leaves the tree
            rest = [k for k in range(m) if k not in inside]
            part = common[np.ix_(inside, rest)]
            i, j = np.unravel_index(part.argmax(), part.shape)
            self.parent[rest[j]] = inside[i]
            inside.append(rest[j])

    def _log_likelihood(self, c: int) -> np.ndarray:
        out = np.zeros(len(self.votes))
        for k, parent in enumerate(self.parent):
            chance = self.accuracy[c][:, k]
            if parent < 0:
                out += np.log(chance[self.votes[:, k]])
            else:
                table = self.pair[c, :, :, parent, k]
                out += np.log(table / table.sum(axis=1, keepdims=True))[self.votes[:, parent], self.votes[:, k]]
        return out

    def report(self) -> list[tuple[str, float, float, str | None, float | None]]:
        """voter, chance to fire on toxic and on clean documents, the voter it depends on, their correlation among toxic documents."""
        out = []
        for k, name in enumerate(VOTERS):
            parent, correlation = int(self.parent[k]), None
            if parent >= 0:
                p, q = self.accuracy[1][1, parent], self.accuracy[1][1, k]
                correlation = float((self.pair[1, 1, 1, parent, k] - p * q) / max(np.sqrt(p * (1 - p) * q * (1 - q)), 1e-9))
            out.append((name, float(self.accuracy[1][1, k]), float(self.accuracy[0][1, k]), VOTERS[parent] if parent >= 0 else None, correlation))
        return out


def fit(found: list[list[int]], posterior: np.ndarray, cues: int, fixed: int = 0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps: a weight for each cue and, last, the bias, which is hardly penalised.

    Weights are drawn to 0, those of the first ``fixed`` cues to FIXED_WEIGHT: a fixed cue that no text of the sample shows keeps that.
    """
    x = np.zeros((len(found), cues + 1), np.float32)
    x[:, -1] = 1
    for k, f in enumerate(found):
        x[k, f] = 1
    seen = np.flatnonzero(x.any(axis=0))
    w = np.zeros(cues + 1)
    w[:fixed] = FIXED_WEIGHT
    if not len(found):
        return w
    x, drawn, penalty = x[:, seen], w[seen], np.where(seen == cues, 1e-3, PENALTY)
    v = drawn.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        slope = x.T @ (p - posterior) + penalty * (v - drawn)
        curve = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve.astype(np.float64), slope)
        v -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    w[seen] = v
    return w


def _vote_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = Cues(shared.value)
        for b in batches:
            masks, found = [], []
            for text in b.column(0):
                mask, own = cues.document(text.as_py())
                masks.append(mask)
                found.append(own)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(masks, pa.int64()), pa.array(found, pa.list_(pa.int32()))], [*b.schema.names[1:], "mask", "cues"])

    return run


def votes(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Cues]:
    """doc_id, held_out, toxic (of the labelled sample, else null), mask, cues of every document, stored; and what the numbers of cues mean."""
    spark = docs.sparkSession
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), MODULUS) != HELD_OUT))
    own = own.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = stored(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS), "voter-labels")
    chosen = F.broadcast(chosen)  # TRAIN_DOCS rows at most
    plain = docs.select(F.col("text").cast("string").alias("text"), "doc_id")
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) + FOLDS * F.col("toxic")
    sample = plain.join(chosen, "doc_id").select("text", cell.cast("int").alias("cell"))
    signed = sample.mapInArrow(_signature_batches, "text string, cell int, signature bigint")
    mined = mined_cues(stored(signed.groupBy("signature").agg(F.min(F.struct("cell", "text")).alias("x")).select("x.text", "x.cell"), "voter-sample"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = plain.join(chosen, "doc_id", "left").select("text", "doc_id", (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"), "toxic")
    found = rows.mapInArrow(_vote_batches(spark.sparkContext.broadcast(mined)), f"doc_id {kind}, held_out boolean, toxic int, mask bigint, cues array<int>")
    return stored(found, "votes"), Cues(mined)


def train(voted: DataFrame, cues: Cues) -> tuple[LabelModel, np.ndarray]:
    """The label model over all documents that are not held out, and the classifier's weights."""
    own = voted.where("NOT held_out")
    counted = own.groupBy("mask").agg(*[F.count(F.when(F.col("toxic").isNull() if t is None else F.col("toxic") == t, 1)).alias(n) for n, t in (("u", None), ("one", 1), ("zero", 0))])
    counted = counted.orderBy("mask").collect()  # 2^len(VOTERS) masks at most
    columns = np.array([tuple(r) for r in counted], np.int64).reshape(-1, 4).T
    model = LabelModel(*columns)
    by_mask = dict(zip(model.masks.tolist(), model.posterior.tolist(), strict=True))
    sample = own.orderBy(F.xxhash64("doc_id", "mask", "cues"), "doc_id").limit(FIT_DOCS).select("mask", "cues").collect()
    return model, fit([r.cues for r in sample], np.array([by_mask[r.mask] for r in sample]), len(cues.names), cues.fixed)


def label_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """voter, fires_on_toxic, fires_on_clean, depends_on, correlation: what the label model has found out about each voter."""
    model, _ = train(*votes(docs, labels))
    return docs.sparkSession.createDataFrame(model.report(), "voter string, fires_on_toxic double, fires_on_clean double, depends_on string, correlation double")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, cues (those found in the text) for every row of ``docs``.

    Labels of held-out documents are never read, nor do these take part in the label model or the fit; labels, lang,
    source and doc_id are never inputs of a score. A null or empty text has no cues and gets the score of such texts; a
    null doc_id is not held out and has no label; a document with several labels counts as toxic if one says so;
    repeated rows get equal scores; without labels the fixed voters alone decide. Texts of any length are read whole.
    """
    voted, cues = votes(docs, labels)
    _, weights = train(voted, cues)
    table = F.array(*[F.lit(float(w)) for w in weights[:-1]])
    z = F.aggregate("cues", F.lit(float(weights[-1])), lambda s, c: s + F.element_at(table, c + 1))
    names = F.array(*[F.lit(n) for n in cues.names])
    out = voted.select("doc_id", "held_out", (1 / (1 + F.exp(-z))).alias("score"), F.transform("cues", lambda c: F.element_at(names, c + 1)).alias("cues"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "cues")
