import re

import pytest

from cairn.llm import decontaminate as d

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = " ".join(f"token{k}" for k in range(30))


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, "five words make this item"), (3, None), (4, ""), (None, " ".join(f"other{k}" for k in range(20)))], "item_id long, text string")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = set()
    for doc_id, text in docs:
        w = words(text)
        for item_id, item in items:
            iw = words(item)
            if not iw:
                continue
            hits = set()
            for i in range(len(w)):
                for p in range(len(iw)):
                    if len(iw) < 7:
                        if p == 0 and w[i : i + len(iw)] == iw:
                            hits.add(i)
                        continue
                    for m in d.MASKS if len(iw) >= 60 else d.LIGHT if len(iw) >= 15 else d.SHORT if len(iw) >= 7 else ['1' * len(iw)]:
                        if i + len(m) <= len(w) and p + len(m) <= len(iw) and all(c == "0" or w[i + k] == iw[p + k] for k, c in enumerate(m)):
                            hits.add(i - p)
            same = {k for at in hits for k in range(len(iw)) if 0 <= at + k < len(w) and w[at + k] == iw[k]}
            if same and 100 * len(same) >= d.LEAST * len(iw):
                out.add((doc_id, item_id, len(iw), len(same)))
    return out


def test_against_brute_force(spark, bench):
    swapped = ITEM.split()
    for k in (3, 9, 17, 24):
        swapped[k] = "changed"
    rows = [
        (1, f"before it {ITEM.upper()} after"), (2, "x " + " ".join(swapped) + " y"), (3, "x " + " ".join(ITEM.split()[:12] + ["added"] + ITEM.split()[12:])), (4, " ".join(ITEM.split()[:8])), (5, "so five  words\nmake this item here"),
        (6, "five words make that item"), (7, None), (8, ""), (9, " ".join(["the of and"] * 40)), (10, " ".join(f"other{k}" for k in range(20)) + " " + ITEM),
    ]
    got = {(r.doc_id, r.item_id, r.item_words, r.matched_words) for r in d.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == brute(rows, [(r.item_id, r.text) for r in bench.collect()])
    assert {(a, b) for a, b, _, _ in got} == {(1, 1), (2, 1), (3, 1), (5, 2), (10, 1), (10, None)}


def test_odd_rows(odd, clashing, empty, bench):
    assert d.matches(odd, bench).collect() == [] and d.matches(empty, bench).collect() == [] and d.matches(odd, bench.limit(0)).collect() == []
    out = d.remove(clashing, bench)
    assert out.columns == clashing.columns and out.count() == clashing.count() and d.remove(empty, bench).collect() == []


def test_removes_only_rows_with_items(spark, bench):
    rows = spark.createDataFrame([(1, ITEM), (1, "clean"), (None, ITEM), (None, "clean too")], "doc_id long, text string")
    assert sorted(r.text for r in d.remove(rows, bench).collect()) == ["clean", "clean too"]


def test_no_python_in_the_plan(small, bench):
    plan = d.matches(small, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan


def test_benchmark_in_parts(spark, bench, monkeypatch):
    """A benchmark beyond what is broadcast at once goes by parts, with the same result; no array of words is shuffled."""
    long_item = " ".join(f"long{k % 37}x{k}" for k in range(90))
    more = bench.unionByName(spark.createDataFrame([(7, long_item)], "item_id long, text string"))
    rows = spark.createDataFrame([(1, f"x {ITEM} y"), (2, long_item[:600] + " other"), (3, "clean")], "doc_id long, text string")
    whole = sorted(map(tuple, d.matches(rows, more).collect()))
    assert {(r[0], r[1]) for r in whole} == {(1, 1), (2, 7)}
    monkeypatch.setattr(d, "BROADCAST_ROWS", 20)
    out = d.matches(rows, more)
    assert sorted(map(tuple, out.collect())) == whole
    for line in out._jdf.queryExecution().executedPlan().toString().splitlines():
        if "Exchange hashpartitioning" in line:
            assert "_hw" not in line and "_iw" not in line


def test_rows_are_judged_by_themselves(spark):
    """Parts of an item in two rows of one id do not add up."""
    rows = [(None, " ".join(ITEM.split()[:12])), (None, " ".join(ITEM.split()[12:])), (4, " ".join(ITEM.split()[:15])), (4, " ".join(ITEM.split()[15:])), (5, ITEM), (5, ITEM), (5, "x " + ITEM)]
    got = d.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, ITEM), (1, "other " + ITEM)], "item_id long, text string"))
    assert sorted((r.doc_id or 0, r.item_words, r.matched_words) for r in got.collect()) == [(0, 30, 18), (5, 30, 30), (5, 30, 30), (5, 31, 30), (5, 31, 30)]


def test_repetitive_texts_end(spark):
    import time

    began = time.time()
    words_ = [f"w{k % 7}" for k in range(3000)]
    rows = spark.createDataFrame([(1, " ".join(words_)), (2, " ".join(["same"] * 3000)), (3, " ".join(f"n{k}" for k in range(3000)))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words_)), (2, " ".join(["same"] * 3000))], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.matched_words) for r in d.matches(rows, items).collect()} == {(1, 1, 3000), (2, 2, 3000)}
    assert time.time() - began < 120


def test_light_masks_find_short_items(spark):
    """Items of 20 words with 12 left in random places."""
    import random

    rng = random.Random(4)
    items, rows = [], []
    for k in range(200):
        words_ = [f"i{k}x{j}" for j in range(20)]
        items.append((k, " ".join(words_)))
        for j in rng.sample(range(20), 8):
            words_[j] = f"c{k}x{j}"
        rows.append((k, "before " + " ".join(words_) + " after"))
    got = d.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) >= 194 and all(r.doc_id == r.item_id and r.matched_words == 12 for r in got)


def test_short_items_are_found_at_every_length(spark):
    """Items of 7 to 15 words with just 60 % of them left, in random places: nine in ten and more at each length; below 7 whole items alone."""
    import math
    import random

    rng = random.Random(9)
    items, rows = [], []
    for n in range(3, 16):
        for k in range(40):
            words_ = [f"i{n}x{k}x{j}" for j in range(n)]
            items.append((100 * n + k, " ".join(words_)))
            if n >= 7 or k % 2:
                for j in rng.sample(range(n), n - math.ceil(0.6 * n)):
                    words_[j] = f"c{n}x{k}x{j}"
            rows.append((100 * n + k, "words before it " + " ".join(words_) + " and after"))
    got = d.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {n: sum(r.doc_id == r.item_id and r.doc_id // 100 == n for r in got) for n in range(3, 16)}
    assert all(found[n] >= 36 for n in range(7, 16)) and all(found[n] == 20 for n in range(3, 7))
