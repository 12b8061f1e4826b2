"""The pipeline against a brute-force version of each stage, on that stage's own input."""

import re
from collections import Counter
from difflib import SequenceMatcher

import pytest

import corpus_pipeline as cp
from cairn.llm import quality_rules, substring_dedup
from cairn.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), re.sub(r"\W", "-", name)))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_named_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "near duplicates", "substring dedup", "decontamination", "mixing"]


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1]) and steps[-1].columns == [*steps[0].columns, "mix_copy"]


def good(text):
    """The verdict of the quality rules from their table, in plain loops."""
    body = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", body)
    wins = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
    often = Counter(wins)
    repeated = {i for k, w in enumerate(wins) if often[w] > 1 for i in range(k, k + 8)}
    lines = [x for x in body.split("\n") if x.strip(" \t\x0b\x0c\r")]
    seen = {
        "n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in body), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_stop_words": sum("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) in set(quality_rules.STOP_WORDS) for w in ws),
    }
    if len(ws) < 20 or 100 * len(repeated) > 30 * len(ws):
        return False
    return all((r.low is None or r.low * seen[r.per] <= 100 * seen[r.metric]) and (r.high is None or 100 * seen[r.metric] <= r.high * seen[r.per]) for r in quality_rules.RULES)


def test_quality_stage(steps):
    assert rows(steps[1]) == {k: r for k, r in rows(steps[0]).items() if good(r.text)} and len(rows(steps[1])) < len(rows(steps[0]))


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def test_near_duplicate_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    sets = {k: shingles(r.text) for k, r in before.items()}
    likeness = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert {k: before[k] for k in after} == after
    for k in before.keys() - after.keys():
        assert any(likeness(k, m) >= 0.8 for m in before if m != k)
    kept = sorted(after)
    assert not any(likeness(a, b) >= 0.8 for i, a in enumerate(kept) for b in kept[:i])


def test_substring_stage(steps):
    """Lines that stood before go, and thirty words or more that an earlier text has in that order; all else stays."""
    before, after = rows(steps[2]), rows(steps[3])
    lines, held = set(), set()
    for k in sorted(before):
        text, left = before[k].text, after[k].text if k in after else ""
        words = text.lower().split()
        new = [line for line in (" ".join(x.lower().split()) for x in text.split("\n")) if line and line not in lines]
        free = [w for line in new for w in line.split()]
        passages = [tuple(words[j : j + 30]) for j in range(len(words) - 29)]
        if not any(p in held for p in passages) and len(new) == len(set(new)) == len([x for x in text.split("\n") if x.strip()]) and len(set(passages)) == len(passages):
            assert left == text and after[k].n_chars == before[k].n_chars
        assert Counter(left.lower().split()) <= Counter(words) and (k not in after or after[k].n_chars == len(left) or left == text)
        covered = {w for p in passages if p in held for w in p}
        repeated = {w for p, n in Counter(passages).items() if n > 1 for w in p}
        gone = Counter(free) - Counter(left.lower().split())
        twice = {w for x, n in Counter(new).items() if n > 1 for w in x.split()}
        assert set(gone) <= covered | repeated | twice, k
        assert not any(" ".join(x.lower().split()) in lines for x in left.split("\n") if x.strip() and x in text.split("\n"))
        lines.update(new)
        held.update(passages)


def test_decontamination_stage(spark, steps):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before, after = rows(steps[3]), rows(steps[4])
    gone = before.keys() - after.keys()
    assert {k: before[k] for k in after} == after
    items = [r.text.lower().split() for r in bench.collect()]
    texts = {k: r.text.lower().split() for k, r in before.items()}
    for k in gone:  # some item's words stand in the text, in order, for the most part
        assert any(sum(b.size for b in SequenceMatcher(None, texts[k], i, autojunk=False).get_matching_blocks()) >= 0.55 * len(i) for i in items if len(set(i) & set(texts[k])) >= 0.4 * len(set(i)))
    leaky = {k for k, w in texts.items() if any(f" {' '.join(i)} " in f" {' '.join(w)} " for i in items if i)}
    assert leaky and leaky <= gone


def test_mixing_stage(steps):
    before, copies = rows(steps[4]), Counter(r.doc_id for r in steps[5].collect())
    assert set(copies) <= set(before) and max(copies.values()) <= 2 and copies
    size = {k: len(r.text.encode().split()) for k, r in before.items()}
    source = Counter()
    for k, n in size.items():
        source[before[k].source] += n
    taken = sum(size[k] * n for k, n in copies.items())
    assert abs(taken - 1.5 * sum(size.values())) < 0.1 * sum(size.values())
    for s in source:
        assert sum(size[k] * n for k, n in copies.items() if before[k].source == s) <= 2 * source[s]


def test_run_is_the_chain(spark, steps):
    key = lambda df: sorted((r.doc_id, r.mix_copy, r.text) for r in df.collect())
    assert key(cp.run(spark, SF)) == key(steps[-1])
