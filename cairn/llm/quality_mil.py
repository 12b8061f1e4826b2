"""Quality classifier (2): attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded; gated attention weighs the encodings, the weights being
learned from document labels alone; the weighted sum is scored. Training uses a bounded sample on the driver with
numpy; scoring streams over the documents with the broadcast weights, some 30 kB.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored
from .mixing import size_of

PASSAGE_WORDS = 64
#: The classifier is fitted on this many labelled documents at most, those with the smallest hash, and of these on those
#: that fit, in that order, into so many passages together. This bounds what the driver holds, whatever the length of the texts.
TRAIN_DOCS, TRAIN_PASSAGES = 4096, 200_000
HIDDEN, GATE, EPOCHS, RATE, DECAY = 32, 16, 250, 0.01, 1e-4
MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.7

_GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&<>", "|", "!?", ".,;:", "\"'()-", " \t\x0b\x0c\r", "\n", "@/\\_=+[]{}~^`")
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _k, _chars in enumerate(_GROUPS):
    _CLASS[list(_chars.encode())] = _k
CLASSES = len(_GROUPS) + 1
BIGRAMS = 64
FEATURES = CLASSES + BIGRAMS + 6


def passages(text: str | None) -> np.ndarray:
    """One row of features for each passage of 64 words; a text without words is one passage of zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = -(-len(words) // PASSAGE_WORDS)
    if not n:
        return np.zeros((1, FEATURES), np.float32)
    b = np.frombuffer(raw, np.uint8)
    kind = _CLASS[b]
    inside = (kind != 8) & (kind != 9)
    begins = inside & ~np.concatenate([[False], inside[:-1]])
    of = np.maximum(np.cumsum(begins) - 1, 0) // PASSAGE_WORDS
    by_class = np.bincount(of * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    size = by_class.sum(axis=1, keepdims=True)
    pair = (b[:-1].astype(np.int64) * 31 + b[1:]) * 0x9E3779B1 >> 20 & (BIGRAMS - 1)
    bigram = np.bincount(of[1:] * BIGRAMS + pair, minlength=n * BIGRAMS).reshape(n, BIGRAMS)
    rest = np.zeros((n, 6))
    seen_lines: set[bytes] = set()
    at = 0
    for line in raw.split(b"\n"):
        bare = line.strip()
        if bare in seen_lines:  # a line that stood before counts where it begins
            rest[of[at + line.index(bare)], 5] += len(bare)
        elif bare:
            seen_lines.add(bare)
        at += len(line) + 1
    for k in range(n):
        w = words[k * PASSAGE_WORDS : (k + 1) * PASSAGE_WORDS]
        rest[k, :4] = len(w) / PASSAGE_WORDS, len(set(w)) / len(w), sum(map(eq, w, w[1:])) / len(w), sum(map(len, w)) / len(w) / 10
    rest[:, 4] = by_class[:, 9] / PASSAGE_WORDS
    rest[:, 5] = np.minimum(rest[:, 5] / size[:, 0], 4)
    return np.concatenate([by_class / size, 8 * bigram / size, rest], axis=1).astype(np.float32)


class Model:
    """Gated attention: h = tanh(xE), a = softmax(w . (tanh(hV) * sigmoid(hU))) over the bag, p = sigmoid(c . sum(a h) + b)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        shapes = {"E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": (1,)}
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * s) @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        m = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"z": z, "h": h, "t": t, "s": s, "a": a, "m": m, "sizes": sizes, "y": 1 / (1 + np.exp(-(m @ p["c"] + p["b"][0])))}

    def gradients(self, f: dict[str, np.ndarray], y: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.p, f["sizes"]
        d = (f["y"] - y) / len(y)
        dm = np.repeat(d[:, None] * p["c"], sizes, axis=0)
        da = (dm * f["h"]).sum(axis=1)
        da = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), sizes))
        dg = da[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dm + dt @ p["V"].T + ds @ p["U"].T
        dz = dh * (1 - f["h"] ** 2)
        return {"E": f["z"].T @ dz, "e": dz.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ da, "c": f["m"].T @ d, "b": np.array([d.sum()])}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.concatenate([[0], np.cumsum([len(x) for x in bags])[:-1]]).astype(np.int64)
        return self.forward(np.concatenate(bags), starts)["y"]


def fit(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """Adam on the whole sample, a fixed number of steps from a fixed seed; no bags give a model that scores 0.5."""
    if not bags:
        model = Model(np.zeros(FEATURES), np.ones(FEATURES))
        model.p["c"][:] = 0
        return model
    x = np.concatenate(bags)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
    model = Model(x.mean(axis=0), x.std(axis=0) + np.float32(1e-3))
    model.p = {k: w.astype(np.float32) for k, w in model.p.items()}
    y = y.astype(np.float32)
    share = np.clip(y.mean(), 0.01, 0.99)
    model.p["b"][0] = np.log(share / (1 - share))
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    for step in range(1, EPOCHS + 1):
        g = model.gradients(model.forward(x, starts), y, starts)
        for k, w in model.p.items():
            gk = g[k] + DECAY * w
            m[k] = 0.9 * m[k] + 0.1 * gk
            v[k] = 0.999 * v[k] + 0.001 * gk**2
            w -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of each text, and how many; a text of more passages than the sample may have leaves none."""
    for b in batches:
        for at in range(0, len(b), 64):
            part = b.slice(at, 64)
            n = [max(1, -(-k // PASSAGE_WORDS)) for k in part.column("words").to_pylist()]
            bags = [passages(t.as_py()).tobytes() if k <= TRAIN_PASSAGES else None for t, k in zip(part.column("text"), n, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("order"), part.column("quality"), pa.array(n, pa.int64()), pa.array(bags, pa.large_binary())], ["order", "quality", "n", "bag"])


def fitting(sizes: list[int], most: int) -> list[int]:
    """Which of the sizes are taken, in order, while they fit: one that does not is passed over, and those after it may still fit."""
    taken, left = [], most
    for k, n in enumerate(sizes):
        if n <= left:
            taken.append(k)
            left -= n
    return taken


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``limit`` labelled documents that are not held out; which ones depends on their hash alone, and on whether they fit."""
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), MODULUS) != HELD_OUT))
    chosen = F.broadcast(stored(own.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit), "mil-labels"))  # ``limit`` rows at most
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select(F.xxhash64("doc_id", "text").alias("order"), F.col("quality").cast("int").alias("quality"), size_of(F.col("text")).alias("words"), "text")
    bags = stored(rows.mapInArrow(_feature_batches, "order long, quality int, n long, bag binary"), "mil-bags")
    # Repeated doc_ids could make the join larger than the sample, and long texts the passages: sizes first, ``limit`` rows at most.
    sizes = bags.select("order", "quality", "n").distinct().orderBy("order", "quality").limit(limit).collect()
    taken = [tuple(sizes[k]) for k in fitting([r.n for r in sizes], TRAIN_PASSAGES)]
    picked = F.broadcast(docs.sparkSession.createDataFrame(taken, "order long, quality int, n long"))
    got = bags.join(picked, ["order", "quality", "n"]).dropDuplicates(["order", "quality"]).select("order", "quality", "bag").orderBy("order", "quality").toArrow()
    return fit([np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in got.column("bag").to_pylist()], got.column("quality").to_numpy().astype(np.float64))


def _score_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, scale, weights = model.value
        m = Model(mean, scale)
        m.p = weights
        for b in batches:
            if not len(b):
                continue
            scores, bags, held = [], [], 0
            for t in b.column("text"):
                bags.append(passages(t.as_py()))
                held += len(bags[-1])
                if held > 20_000:
                    scores.append(m.score(bags))
                    bags, held = [], 0
            if bags:
                scores.append(m.score(bags))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(np.concatenate(scores).astype(np.float64), pa.float64())], ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels of held-out documents are never read; labels, lang, source and doc_id are never inputs of a score. A null
    or empty text is one passage of zeros and is scored like any other; a null doc_id is not held out and has no label;
    repeated rows get equal scores; without any label all scores are 0.5.
    """
    fitted = train(docs, labels, limit)
    model = docs.sparkSession.sparkContext.broadcast((fitted.mean, fitted.scale, fitted.p))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"), "text")
    scored = rows.mapInArrow(_score_batches(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
