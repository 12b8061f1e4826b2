"""Quality classifier, language ID and LM scoring: held-out accuracy and brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cairn.llm import langid, lm_ctw, quality_mil

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_quality_held_out(docs, labels):
    got = {r.doc_id: r for r in quality_mil.score(docs, labels).collect()}
    assert all(r.held_out == held(k, 4, 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for k, r in got.items())
    pairs = [(got[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in pairs]) > 0.95
    ones, zeros = [r.score for r, q in pairs if q], [r.score for r, q in pairs if not q]
    assert np.mean([a > b for a in ones for b in zeros]) > 0.95


def test_labels_of_held_out_documents_are_not_read(docs, labels):
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    some = docs.where("doc_id < 100")
    assert sorted(map(tuple, quality_mil.score(some, flipped).collect())) == sorted(map(tuple, quality_mil.score(some, labels).collect()))


def by_hand(model, text):
    """Passages, encodings, gated attention and score of one text, in plain loops over the fitted weights."""
    p = model.p
    sig = lambda v: 1 / (1 + math.exp(-v))
    dot = lambda v, w: sum(float(a) * float(b) for a, b in zip(v, w, strict=True))
    hs, energy = [], []
    for x in quality_mil.passages(text):
        z = [min(8.0, max(-8.0, (float(v) - float(m)) / float(s))) for v, m, s in zip(x, model.mean, model.scale, strict=True)]
        h = [math.tanh(dot(z, p["E"][:, j]) + float(p["e"][j])) for j in range(quality_mil.HIDDEN)]
        gate = [math.tanh(dot(h, p["V"][:, j])) * sig(dot(h, p["U"][:, j])) for j in range(quality_mil.GATE)]
        hs.append(h)
        energy.append(dot(gate, p["w"]))
    total = sum(math.exp(e - max(energy)) for e in energy)
    mix = [sum(math.exp(e - max(energy)) / total * h[j] for e, h in zip(energy, hs, strict=True)) for j in range(quality_mil.HIDDEN)]
    return sig(dot(mix, p["c"]) + float(p["b"][0]))


def test_quality_scores_by_hand(spark, docs, labels):
    some = docs.orderBy("doc_id").limit(60)
    model = quality_mil.train(docs, labels)
    got = {r.doc_id: r.score for r in quality_mil.score(docs, labels).where("doc_id < 60").collect()}
    texts = {r.doc_id: r.text for r in some.collect()}
    assert len(got) > 40 and all(abs(by_hand(model, texts[k]) - v) < 1e-4 for k, v in got.items())


def test_passages_tell_of_themselves_alone():
    """Features of a passage come from its own words, but for lines that stood before."""
    ws = [f"Word{k % 50}," for k in range(200)]
    found = quality_mil.passages(" ".join(ws))
    assert len(found) == 4 and np.allclose(found[1], quality_mil.passages("x " * 64 + " ".join(ws[64:128]) + " y" * 10)[1], atol=0.02)
    again = quality_mil.passages("a line of words\n" + " ".join(["other"] * 124) + "\na line of words")
    assert again[0, -1] == 0 and again[-1, -1] > 0


def test_quality_sample_is_bounded_by_passages(spark, docs, labels, monkeypatch):
    long_text = " ".join(f"w{k % 99}" for k in range(150_000))
    more = docs.unionByName(spark.createDataFrame([(10**6 + k, long_text + str(k), "en", "a", 1) for k in range(3)], docs.schema))
    marked = labels.select("doc_id", "quality").unionByName(spark.createDataFrame([(10**6 + k, 1) for k in range(3)], "doc_id long, quality int"))
    monkeypatch.setattr(quality_mil, "TRAIN_PASSAGES", 500)
    sizes = []
    monkeypatch.setattr(quality_mil, "fit", lambda bags, y: (sizes.append((sum(map(len, bags)), len(bags) == len(y))), quality_mil.Model(np.zeros(quality_mil.FEATURES), np.ones(quality_mil.FEATURES)))[1])
    quality_mil.train(more, marked)
    assert 0 < sizes[0][0] <= 500 and sizes[0][1]
    scored = quality_mil.score(more.where("doc_id >= 1000000"), marked).collect()
    assert len(scored) == 3 and all(0 <= r.score <= 1 for r in scored)


def test_long_texts_do_not_end_the_sample(spark, docs, labels, monkeypatch):
    """With a bound of forty passages all labelled texts that fit are used, wherever a long one stands among them."""
    assert quality_mil.fitting([3, 50, 4, 40, 1, 30], 40) == [0, 2, 4, 5] and quality_mil.fitting([], 5) == quality_mil.fitting([6, 7], 5) == []
    monkeypatch.setattr(quality_mil, "TRAIN_PASSAGES", 40)
    sizes = []
    monkeypatch.setattr(quality_mil, "fit", lambda bags, y: (sizes.extend(map(len, bags)), quality_mil.Model(np.zeros(quality_mil.FEATURES), np.ones(quality_mil.FEATURES)))[1])
    quality_mil.train(docs, labels)
    assert 30 < sum(sizes) <= 40 and len(sizes) > 5


def test_gradients():
    rng = np.random.default_rng(1)
    x, starts, y = rng.normal(size=(7, quality_mil.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    m = quality_mil.Model(np.zeros(quality_mil.FEATURES), np.ones(quality_mil.FEATURES))
    loss = lambda: -np.mean(np.log(np.where(y == 1, p := m.forward(x, starts)["y"], 1 - p)))  # noqa: E731, F841
    g = m.gradients(m.forward(x, starts), y, starts)
    for k, w in m.p.items():
        at = tuple(rng.integers(0, n) for n in w.shape)
        old, e = w[at], 1e-6
        w[at] = old + e
        up = loss()
        w[at] = old - e
        down = loss()
        w[at] = old
        assert abs((up - down) / (2 * e) - g[k][at]) < 1e-6


def test_language_held_out(docs):
    got = {r.doc_id: r for r in langid.predict(docs).collect()}
    rows = docs.collect()
    assert all(got[r.doc_id].held_out == held(r.doc_id, 3, 1) for r in rows)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out]) > 0.98


def test_language_counts_are_whole(spark):
    rows = [(k, t, x) for k, (t, x) in enumerate([("abc abc", "en"), ("xyz", "de"), ("abd", "en"), ("no", None), (None, "en"), ("", "de")] * 3)]
    langs, prior, table = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts, seen = defaultdict(Counter), Counter()
    for k, t, x in rows:
        if x is not None and not held(k, 3, 1):
            seen[x] += 1
            counts[x].update(langid.features(t or "").tolist())
    assert langs == ["de", "en"]
    for c, x in enumerate(langs):
        want = np.array([counts[x][f] + langid.ALPHA for f in range(langid.DIMS)])
        assert np.allclose(table[:, c], np.log(want / want.sum()), atol=1e-4) and math.isclose(np.exp(prior[c]), (seen[x] + 1) / (sum(seen.values()) + 2))


def test_many_languages(spark, monkeypatch):
    """Dirty values of lang: the most frequent are learned, whatever a task counts at once."""
    rows = [(k, f"text of words {k % 7}", f"l{k % 40:02d}" if k % 3 else "en") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = langid.train(df)
    monkeypatch.setattr(langid, "TASK_LANGS", 2)
    parts = langid.train(df)
    assert whole[0] == parts[0] and np.array_equal(whole[2], parts[2]) and len(whole[0]) > 30
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    few = langid.train(df)
    assert len(few[0]) == 3 and "en" in few[0] and few[2].shape == (langid.DIMS, 3)
    assert {r.lang_pred for r in langid.predict(df).collect()} <= set(few[0])


def language_by_hand(texts, text):
    """The posterior of each language by the definition: counts of hashed n-grams, smoothed, for one text."""
    counts, seen = defaultdict(Counter), Counter()
    for k, t, x in texts:
        if x is not None and not held(k, 3, 1):
            seen[x] += 1
            counts[x].update(langid.features(t or "").tolist())
    langs, logs = sorted(seen), []
    for x in langs:
        total = sum(counts[x].values()) + langid.ALPHA * langid.DIMS
        logs.append(math.log((seen[x] + 1) / (sum(seen.values()) + len(langs))) + sum(math.log((counts[x][f] + langid.ALPHA) / total) for f in langid.features(text).tolist()))
    best = max(range(len(langs)), key=lambda c: logs[c])
    return langs[best], 1 / sum(math.exp(v - logs[best]) for v in logs)


def test_language_predictions_by_hand(spark, docs):
    some = docs.orderBy("doc_id").limit(120)
    rows = [(r.doc_id, r.text, r.lang) for r in some.collect()]
    got = {r.doc_id: r for r in langid.predict(some).collect()}
    for k, t, _ in rows:
        if t and langid.LETTER.search(t):
            lang, score = language_by_hand(rows, t)
            assert (got[k].lang_pred == lang and abs(got[k].score - score) < 1e-3) or min(got[k].score, score) < 0.51


def ctw(text, training):
    """Context-tree weighting by its definition, over dictionaries: log10 probability of a text after training."""
    D = lm_ctw.DEPTH
    n = defaultdict(lambda: [0, 0])
    for t in training:
        b = b"\0" * D + t.encode() + bytes([lm_ctw.END])
        for i in range(D, len(b)):
            for j in range(8):
                prefix, bit = (1 << j) | (b[i] >> (8 - j)), b[i] >> (7 - j) & 1
                for d in range(D + 1):
                    n[(d, b[i - d : i], prefix)][bit] += 1
    kids = defaultdict(set)
    for d, c, p in n:
        if d:
            kids[(d - 1, c[1:], p)].add((d, c, p))
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, gap = {}, {}
    for node in sorted(n, key=lambda x: -x[0]):
        own = kt(*n[node])
        below = sum(weighted[k] for k in kids[node])
        gap[node] = own - below
        weighted[node] = own if node[0] == D else np.logaddexp(own, below) - math.log(2)
    total = 0.0
    b = b"\0" * D + text.encode() + bytes([lm_ctw.END])
    for i in range(D, len(b)):
        for j in range(8):
            prefix, bit = (1 << j) | (b[i] >> (8 - j)), b[i] >> (7 - j) & 1
            p = None
            for d in range(D, -1, -1):
                node = (d, b[i - d : i], prefix)
                a, z = n[node] if node in n else (0, 0)
                own = (z + 0.5) / (a + z + 1)
                w = 1 / (1 + math.exp(-min(700, max(-700, gap[node])))) if node in gap else 0.5
                p = own if p is None else w * own + (1 - w) * p
            total += math.log10(p if bit else 1 - p)
    return total


def test_lm_against_its_definition(spark):
    texts = ["the cat sat on the mat", "the dog sat on the cat", "", None, "ein Hund saß da", "the cat THE cat", "zzz", "the mat sat"]
    rows = [(k, t) for k, t in enumerate(texts * 2)]
    got = {r.doc_id: r for r in lm_ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    train = [t or "" for k, t in rows if not held(k, 7, 2)]
    count = Counter(w for t in train for w in t.encode().lower().split())
    total, share = sum(count.values()) + len(train), sum(count.values()) + len(train) + len(count) + 2
    assert len(got) == len(rows)
    for k, t in rows:
        r, ws = got[k], (t or "").encode().lower().split()
        base = sum(math.log10((count[w] + 1) / share) for w in ws) + math.log10((len(train) + 1) / share)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k, 7, 2), len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, ctw(t or "", train), rel_tol=1e-8)
        assert math.isclose(r.bits_per_byte * (len((t or "").encode()) + 1), -r.score / math.log10(2), rel_tol=1e-9)


def test_lm_probabilities_sum_to_one(spark):
    training = spark.createDataFrame([(k, "abab abba") for k in range(5)], "doc_id long, text string")
    _, grams, _ = lm_ctw.counts(training)
    contexts = (0, int.from_bytes(b"\0abab", "big"), int.from_bytes(b"zzzzz", "big"))
    sought = spark.createDataFrame([(c << 8 | b, 0) for c in contexts for b in range(256)], "gram long, n long")
    every = lm_ctw.values(grams.unionByName(sought).groupBy("gram").sum("n").withColumnRenamed("sum(n)", "n")).collect()
    for c in contexts:
        assert math.isclose(sum(10**r.s for r in every if r.gram >> 8 == c), 1, rel_tol=1e-9)


def test_kt_of_large_counts():
    a, b = np.array([0.0, 1, 5, 1023, 1024, 10**6]), np.array([0.0, 3, 1019, 1, 2000, 10**7])
    assert np.allclose(lm_ctw.kt(a, b), [math.lgamma(x + 0.5) + math.lgamma(y + 0.5) - math.lgamma(x + y + 1) - math.log(math.pi) for x, y in zip(a, b, strict=True)], rtol=1e-12, atol=1e-9)


def test_rare_words_go_through_the_join(spark, monkeypatch):
    rows = spark.createDataFrame([(k, f"common common word{k % 4}") for k in range(12)], "doc_id long, text string")
    whole = {r.doc_id: (r.base_score, r.n_known) for r in lm_ctw.score(rows).collect()}
    monkeypatch.setattr(lm_ctw, "FREQUENT_WORDS", 1)
    part = {r.doc_id: (r.base_score, r.n_known) for r in lm_ctw.score(rows).collect()}
    assert all(math.isclose(whole[k][0], part[k][0]) and whole[k][1] == part[k][1] for k in whole)


@pytest.mark.parametrize("most", [0, 40, 10**6])
def test_all_nodes_count_whatever_is_broadcast(spark, monkeypatch, most):
    """Grams beyond the broadcast ones score by the whole tree, with the same values."""
    texts = ["the cat sat on the mat", "the dog sat on the cat", "ein Hund saß da", "zzz", "the mat sat", "quite another text", "the cats"]
    rows = [(k, t) for k, t in enumerate(texts * 2)]
    monkeypatch.setattr(lm_ctw, "FREQUENT_GRAMS", most)
    got = {r.doc_id: r.score for r in lm_ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    train = [t for k, t in rows if not held(k, 7, 2)]
    assert all(math.isclose(got[k], ctw(t, train), rel_tol=1e-7) for k, t in rows)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(lm_ctw, "PIECE", 7)
    raw = bytes(range(97, 120))
    got = np.concatenate([lm_ctw.grams(p) for p in lm_ctw.pieces(raw)])
    monkeypatch.setattr(lm_ctw, "PIECE", 1 << 20)
    assert got.tolist() == np.concatenate([lm_ctw.grams(p) for p in lm_ctw.pieces(raw)]).tolist() and len(got) == len(raw) + 1


def test_odd_rows(spark, odd, empty, labels):
    for f in (lambda x: quality_mil.score(x, labels), langid.predict, lm_ctw.score):
        rows = f(odd).collect()
        assert len(rows) == odd.count() and f(empty).collect() == []
        assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    by = {(r.doc_id, r.lang_pred) for r in langid.predict(odd).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (8, "und")} <= by and (9, "und") not in by
    none = quality_mil.score(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
