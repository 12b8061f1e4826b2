import re

import pytest

from cairn.llm import substring_dedup as s

PASSAGE = " ".join(f"Here the sentence number {k} of the shared passage says what it has to say." for k in range(6))


def own(k):
    return " ".join(" ".join(f"own{k}x{j}x{i}" for i in range(9)) + "." for j in range(6))


@pytest.fixture
def docs(spark):
    rows = [
        (10, f"{own(10)}\n{PASSAGE}\n{own(11)}"), (20, f"{own(20)} {PASSAGE} {own(21)}"), (30, PASSAGE.upper()), (40, own(40) + " Here the sentence number 1 of the shared passage says what it has to say."),
        (50, own(50)), (60, f"{own(60)}\nthe same line of text again, with a few words to fill it up\n" + "the same line of text again, with a few words to fill it up\n" * 6), (5, f"no end mark here {PASSAGE} {own(5)}"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def known(words, earlier, n=30):
    """Which words stand in ``n`` words in a row that one earlier text has in that order."""
    held = {tuple(t[k : k + n]) for t in earlier for k in range(len(t) - n + 1)}
    out = [False] * len(words)
    for k in range(len(words) - n + 1):
        if tuple(words[k : k + n]) in held:
            out[k : k + n] = [True] * n
    return out


def check(rows, got):
    """By the rule alone: what goes is a line that stood before or words known in that order; no line that stood before stays."""
    lines, texts = set(), []
    for doc_id, text in sorted(rows):
        spans = [(x.start, x.end) for x in got[doc_id].removed]
        assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False)) and len(got[doc_id].text) <= len(text) - sum(b - a for a, b in spans)
        words = [(m.start(), m.group().lower()) for m in re.finditer(r"\S+", text)]
        mine = [w for _, w in words]
        inside = [any(a <= at < b for a, b in spans) for at, _ in words]
        allowed = known(mine, texts)
        at = 0
        for line in text.split("\n"):
            plain, n = " ".join(line.lower().split()), len(line.split())
            if plain:
                if plain in lines:
                    assert all(inside[at : at + n])
                    allowed[at : at + n] = [True] * n
                lines.add(plain)
            at += n
        for k in [k for k, gone in enumerate(inside) if gone and not allowed[k]]:  # else the words stood in this text before
            assert known(mine[max(0, k - 30) : k + 30], [mine[:k]])[min(k, 30)], (doc_id, k)
        texts.append(mine)


def test_removes_all_but_the_earliest(docs):
    got = {r.doc_id: r for r in s.result(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, got)
    texts = dict(rows)
    assert got[5].text == texts[5] and got[50].text == texts[50] and got[40].text == texts[40]
    assert PASSAGE[80:] not in got[10].text and got[10].text.startswith(own(10)) and got[10].text.endswith(own(11))
    assert PASSAGE[80:] not in got[20].text and own(21) in got[20].text and got[60].text.count("the same line") == 1


def test_small_table_by_the_rule(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    got = {r.doc_id: r for r in s.result(small).collect()}
    check(rows, got)
    assert sum(r.n_removed for r in got.values()) > 20


def test_nothing_is_pieced_together(spark):
    """Forty one-word sentences, each known from another document, in an order that nobody used, stay."""
    one = [f"Word{k}." for k in range(40)]
    rows = [(k, f"{own(k)} {w} {own(k + 100)}") for k, w in enumerate(one)] + [(99, " ".join(one)), (100, " ".join(reversed(one))), (101, "Some text before. " + " ".join(one) + " Some text after.")]
    got = {r.doc_id: r for r in s.result(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k].n_removed == 0 and got[k].text == t for k, t in rows[:-1]) and got[101].n_removed == 1
    halves = [(0, " ".join(f"a{k}." for k in range(29))), (1, " ".join(f"b{k}." for k in range(29))), (2, " ".join([f"a{k}." for k in range(29)] + [f"b{k}." for k in range(29)]))]
    assert [r.n_removed for r in s.result(spark.createDataFrame(halves, "doc_id long, text string")).collect()] == [0, 0, 0]


@pytest.mark.parametrize(("kind", "n"), [("sentence", 4), ("line", 3), ("paragraph", 2)])
def test_units_keep_offsets(kind, n):
    text = "One two. Three!\n  four five \n\n six"
    found = s.units(text, kind)
    assert len(found) == n and all(text[a:b].strip() == text[a:b] != "" for a, b, _ in found) and sum(len(text[a:b].split()) for a, b, _ in found) == 6
    begins, digests = s.passages(text.split(), 2)
    assert set(begins.tolist()) <= set(range(5)) and len(digests) == len(begins) > 0 and not len(s.passages(text.split())[0]) and not len(s.passages([])[0]) and not len(s.passages(text.split(), 0)[0])


def test_shared_text_begins_passages_at_the_same_words():
    rng = __import__("random").Random(6)
    word = lambda: f"w{rng.randrange(50)}"
    for _ in range(200):
        shared = [word() for _ in range(s.PASSAGE + s.WINDOW - 1 + rng.randrange(30))]
        a, b = ([word() for _ in range(rng.randrange(60))] + shared + [word() for _ in range(rng.randrange(60))] for _ in "ab")
        assert set(s.passages(a)[1].tolist()) & set(s.passages(b)[1].tolist())
        for text in (a, b):
            begins, digests = s.passages(text)
            assert len({(d, tuple(text[k : k + s.PASSAGE])) for k, d in zip(begins, digests, strict=True)}) == len(set(digests)) and (len(begins) < 0.45 * len(text) or len(text) < 60)


def test_odd_rows(odd, empty):
    rows = s.result(odd).collect()
    assert len(rows) == odd.count() and s.result(empty).collect() == []
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].text is None and by[2].text == "" and by[4].text == " \t\n "
    assert by[6].text == "" and by[5].n_removed == 0 and by[7].n_removed == 1


def test_stage(clashing, docs, empty):
    out = s.apply(clashing)
    rows = out.collect()
    assert out.columns == clashing.columns and 6 not in {r.doc_id for r in rows} and len(rows) == clashing.count() - 1
    assert {r.doc_id for r in s.apply(docs).collect()} == {5, 10, 20, 40, 50, 60} and s.apply(empty).collect() == []


def test_passages_inside_sentences(spark):
    """Sixty words that begin and end inside sentences of both documents: all but a few at the ends go."""
    rng = __import__("random").Random(2)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    rows, passages = [], []
    for g in range(60):
        passage = filler(60)
        passages.append(passage)
        rows += [(2 * g, " ".join([*filler(20), *passage, *filler(20)])), (2 * g + 1, " ".join([*filler(33), *passage, *filler(7)]))]
    got = {r.doc_id: r for r in s.result(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    left = []
    for g, passage in enumerate(passages):
        assert got[2 * g].text == texts[2 * g] and not got[2 * g].removed
        kept = set(got[2 * g + 1].text.split())
        assert set(texts[2 * g + 1].split()) - set(passage) <= kept
        left.append(len(set(passage) & kept))
    assert max(left) <= 2 * (s.WINDOW - 1) and sum(left) / len(left) < 10


def test_repeated_lines_go_whatever_their_length(spark):
    rows = [(1, "first own line\nCookies: accept  all\nmore"), (2, "second own line\ncookies: ACCEPT all\nend"), (3, "cookies: accept all\ncookies: accept all\nthird")]
    got = {r.doc_id: r.text for r in s.result(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "second own line\nend", 3: "third"}


def test_ids_that_are_no_numbers(spark):
    rows = [("b", PASSAGE + " b"), ("a", PASSAGE + " a"), ("7", PASSAGE + " seven")]
    got = {r.doc_id: r.n_removed for r in s.result(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got["7"] == 0 and sorted(got.values()) == [0, 1, 1]
