import re

import pytest

from cairn.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    body = text or ""
    ws = WORD.findall(body)
    wins = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
    covered = {i for k, w in enumerate(wins) if wins.count(w) > 1 for i in range(k, k + 8)}
    lines = [x for x in body.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in body), len(lines) - len(set(lines)), len(covered)


def test_measures_against_brute_force(small):
    docs = small.where("length(text) < 3000")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.score(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_odd_rows(odd):
    rows = q.score(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].n_words == by[3].n_words == by[4].n_words == 0 and by[2].base_failed and not by[2].kept
    assert by[1].kept and by[7].n_dup_lines == 1 and by[9].n_words == brute([r.text for r in odd.collect() if r.doc_id == 9][0])[0]


def test_keep_leaves_columns_alone(clashing, empty):
    out = q.keep(clashing)
    assert out.columns == clashing.columns and {r.doc_id for r in out.collect()} == {1, 5, 6}
    assert q.keep(empty).collect() == [] and q.score(empty).collect() == []


@pytest.mark.parametrize(("text", "kept"), [("the of and " * 3 + " ".join(f"house{k}" for k in range(20)), True), (" ".join(f"house{k}$$$ the" for k in range(20)), False), (" ".join(f"house{k}" for k in range(30)), False), ("the same eight words are in this line\n" * 9, False)])
def test_rules(spark, text, kept):
    assert q.score(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().kept is kept
