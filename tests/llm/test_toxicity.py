"""Toxicity: held-out accuracy, the label model against simulated votes, scores by hand, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from cairn.llm import toxicity

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def scored(docs, labels):
    return {r.doc_id: r for r in toxicity.score(docs, labels).collect()}


def test_held_out(docs, labels, scored):
    assert len(scored) == docs.count() and all(r.held_out == held(k) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for k, r in scored.items())
    pairs = [(scored[r.doc_id], r.toxic) for r in labels.collect() if r.toxic is not None and r.doc_id in scored and held(r.doc_id)]
    assert np.mean([r.predicted == t for r, t in pairs]) > 0.98
    ones, zeros = [r.score for r, t in pairs if t], [r.score for r, t in pairs if not t]
    assert np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros]) > 0.96
    assert np.mean([r.predicted for r, t in pairs if not t]) < 0.01


def test_labels_of_held_out_documents_are_not_read(spark, labels):
    from pyspark.sql import functions as F

    some = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = lambda x: sorted((r.doc_id, r.score) for r in toxicity.score(some, x).collect())
    assert rows(flipped) == rows(labels)


def test_scores_are_the_sum_of_their_cues(docs, labels, scored):
    """Cues found by their definition, weights of the classifier, one text at a time."""
    voted, cues = toxicity.votes(docs, labels)
    _, weights = toxicity.train(voted, cues)
    for r in docs.orderBy("doc_id").limit(150).collect():
        words = {w for t in (r.text or "").lower().split() for w in toxicity._LETTERS.findall(t)}
        found = set()
        for name, k in zip(cues.names, range(len(cues.names)), strict=True):
            start, _, times = name.partition("*")
            if k < len(toxicity.PATTERNS):
                continue
            if name in toxicity._KNOWN:
                hit = name in words
            elif start.endswith("$"):
                hit = start[:-1] in words
            else:
                hit = sum(w.startswith(start) for w in words) >= int(times or 1)
            found |= {k} if hit else set()
        z = sum(weights[k] for k in found) + weights[-1]
        assert math.isclose(scored[r.doc_id].score, 1 / (1 + math.exp(-z)), rel_tol=1e-6)


def test_label_model_on_simulated_votes():
    """Chances to fire, a pair of voters that copy each other, and the posterior, from votes whose classes are known to the test alone."""
    rng = np.random.default_rng(7)
    n, m = 20_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.2
    fires = np.where(y[:, None], rng.uniform(0.5, 0.9, m), rng.uniform(0.01, 0.1, m))
    votes = rng.random((n, m)) < fires
    votes[:, 4] = np.where(rng.random(n) < 0.95, votes[:, 3], votes[:, 4])
    masks, back = np.unique((votes << np.arange(m)).sum(axis=1), return_inverse=True)
    model = toxicity.LabelModel(masks, np.bincount(back), np.zeros(len(masks)), np.zeros(len(masks)))
    assert abs(model.prior[1] - y.mean()) < 0.01
    for k, (name, one, zero, on, correlation) in enumerate(model.report()):
        assert abs(one - votes[y, k].mean()) < 0.03 and abs(zero - votes[~y, k].mean()) < 0.03 and name == toxicity.VOTERS[k]
        if {k, toxicity.VOTERS.index(on) if on else -1} == {3, 4}:
            assert correlation > 0.8
    assert {(k, int(p)) for k, p in enumerate(model.parent)} & {(3, 4), (4, 3)}
    assert np.mean((model.posterior[back] > 0.5) == y) > 0.98


def test_posterior_is_that_of_the_tree():
    """The posterior of each mask, from the chances of the model, voter by voter."""
    rng = np.random.default_rng(3)
    masks = np.unique(rng.integers(0, 1 << len(toxicity.VOTERS), 60))
    model = toxicity.LabelModel(masks, rng.integers(1, 50, len(masks)), rng.integers(0, 5, len(masks)), rng.integers(0, 5, len(masks)))
    for i, mask in enumerate(masks.tolist()):
        p = [model.prior[c] for c in (0, 1)]
        for c in (0, 1):
            for k, parent in enumerate(model.parent.tolist()):
                v, w = mask >> k & 1, mask >> max(parent, 0) & 1
                joint = model.pair[c, :, :, parent, k]
                p[c] *= model.accuracy[c][v, k] if parent < 0 else joint[w, v] / (joint[w, 0] + joint[w, 1])
        assert math.isclose(p[1] / (p[0] + p[1]), model.posterior[i], rel_tol=1e-6)


def test_fit_has_no_slope_left():
    rng = np.random.default_rng(2)
    found = [sorted(rng.choice(12, rng.integers(0, 5), replace=False).tolist()) for _ in range(300)]
    soft = rng.random(300)
    w = toxicity.fit(found, soft, 14, 3)
    p = np.array([1 / (1 + math.exp(-(w[-1] + sum(w[k] for k in f)))) for f in found])
    for k in range(12):
        assert abs(sum((p - soft)[[k in f for f in found]]) + toxicity.PENALTY * (w[k] - (toxicity.FIXED_WEIGHT if k < 3 else 0))) < 1e-2
    assert w[12] == w[13] == 0 and toxicity.fit([], np.zeros(0), 3, 1).tolist() == [toxicity.FIXED_WEIGHT, 0, 0, 0]


def test_patterns_and_levels():
    names = lambda t: [toxicity.PATTERNS[k] for k in toxicity.patterns(t)]
    assert names("1d10t") == names("$tup1d") == ["disguised"] and names("idioooot!") == ["stretched"] and names("i.d.i.o.t") == ["spelled"]
    assert [names(t) for t in ("idiot###", "house", "12345", "the!!", "a.b.c", "", "...")] == [[]] * 7
    cues = toxicity.Cues([("abc*2", 1 << 9), ("xyz$", 1 << 8)])
    name = lambda t: [cues.names[k] for k in cues.document(t)[1]]
    assert name("abcd, abcd. other") == [] and name("abcd Abce") == ["abc*2"] and name("XYZ!") == ["xyz$"] and name("xyzz") == []
    assert cues.document("abcd abce")[0] & 1 << 9 and cues.document("nothing")[0] == 0 and cues.document(None) == (0, [])
    assert cues.document("you idiot")[0] & 1 and not cues.document("you idiot")[0] & toxicity._SEVERAL and cues.document("idiot and moron")[0] & toxicity._SEVERAL


def test_stems_are_learned_from_labels(spark):
    """Invented words whose stem alone is shared are caught in texts that were never labelled; copies of one text teach nothing."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("bdgklmnprst", k=3)) + "".join(rng.choices("aeiou", k=2)) + rng.choice("bdgk")
    copy = " ".join(word() for _ in range(60)) + " qzaxor qzaxel qzaxim"
    rows, marks = [], []
    for k in range(1200):
        toxic = k % 8 == 0
        text = [word() for _ in range(40)]
        if toxic:
            text[3:3] = rng.sample([f"qzax{e}" for e in ("a", "or", "el", "im", "untu", "ery", "ostr", "abl")], 3)
        rows.append((k, copy if 0 < k < 200 and toxic else " ".join(text), None, None))
        marks.append((k, int(toxic)))
    docs = spark.createDataFrame([*rows, (9000, "un qzaxorum " + word() + " qzaxelim", None, None), (9001, " ".join(copy.split()[:60]), None, None)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in toxicity.score(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    assert np.mean([got[k].predicted == t for k, t in marks if held(k)]) > 0.98 and got[9000].predicted == 1 and got[9001].predicted == 0


def test_odd_rows(spark, odd, clashing, empty):
    marks = spark.createDataFrame([(1, 0, "x"), (1, 1, "x"), (2, 0, "x"), (5, None, "x"), (7, 0, None), (None, 1, "x"), (77, 1, "x")], "doc_id long, toxic int, text string")
    plain = sorted(map(str, toxicity.score(odd, marks).collect()))
    assert len(plain) == odd.count() and plain == sorted(map(str, toxicity.score(clashing, marks).collect()))
    assert toxicity.score(empty, marks).collect() == []
    none = toxicity.score(odd, marks.limit(0)).collect()
    assert len(none) == odd.count() and [r.held_out for r in none if r.doc_id is None] == [False, False] and all(0 <= r.score <= 1 for r in none)
    abuse = spark.createDataFrame([(k, "you stupid worthless idiot" if k == 7 else "a fine day") for k in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(abuse, marks.limit(0)).collect()}
    assert max(got, key=got.get) == 7
