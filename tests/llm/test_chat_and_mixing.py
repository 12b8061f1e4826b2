import pytest

from cairn.llm import chat, mixing


@pytest.fixture
def turns(spark):
    rows = [(1, k, who, f"{who} says {k}") for k, who in enumerate(["system", "ann", "bob", "cy", "ann", "bob"])] + [(2, 0, "ann", None), (2, 1, None, "who?"), (2, None, "bob", "late"), (3, 0, "system", "only"), (None, 0, "ann", "x"), (4, 0, "ann", "same"), (4, 0, "ann", "same")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def brute(rows, conv, who):
    mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: (r.turn is None, r.turn or 0, r.role is None, r.role or "", r.text or ""))
    text, masks = "", []
    for r in mine:
        text += "<|system|>\n" if r.role == "system" else "<|assistant|>\n" if r.role == who else f"<|user name={r.role or 'unknown'}|>\n"
        start = len(text)
        text += (r.text or "") + "<|end|>\n"
        if r.role == who:
            masks.append((start, len(text)))
    return text, masks


@pytest.mark.parametrize("part_turns", [512, 2, 1])
def test_rotation(turns, part_turns):
    rows = turns.collect()
    whole = {}
    for r in sorted(chat.rotate(turns, part_turns).collect(), key=lambda r: (r.part is None, r.part)):
        text, masks = whole.get((r.conv_id, r.perspective), ("", []))
        assert r.char_offset == len(text) and r.n_masked == len(r.masks) and r.n_turns <= max(part_turns, 6)
        whole[(r.conv_id, r.perspective)] = (text + r.text, masks + [(m.start + r.char_offset, m.end + r.char_offset) for m in r.masks])
    assert whole == {(c, w): brute(rows, c, w) for c, w in {(r.conv_id, r.role) for r in rows if r.role not in (None, "system")}}


def test_parts_depend_on_turns_alone(spark):
    """3,000 turns and one very long one: the same rows however many partitions, and those of the oracle."""
    import duckdb

    rows = [(1, k, f"p{k % 3}", f"says {k}" * (1 + 50_000 * (k == 700))) for k in range(3000)] + [(2, k, "ann", f"t{k}") for k in range(3)] + [(1, None, "late", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = []
    for n in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(str, chat.result(df.repartition(int(n))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1] and len(got[0]) == 4 * 7 + 1
    conversations = df.toPandas().astype({"turn": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.register("conversations", conversations)
    names = chat.result(df).columns
    key = lambda r: (r[0], r[1], r[2] is None, r[2])
    assert sorted(con.execute(f"SELECT {', '.join(names)} FROM ({chat.ORACLE})").fetchall(), key=key) == sorted(map(tuple, chat.result(df).collect()), key=key)


def test_clashing_columns(turns):
    from pyspark.sql import functions as F

    more = turns.select("*", *[F.lit(n).alias(n) for n in "part n chars less perspective char_offset turns lines _c _t".split()])
    assert sorted(map(str, chat.rotate(more).collect())) == sorted(map(str, chat.rotate(turns).collect()))


def test_no_turns(turns):
    assert chat.rotate(turns.limit(0)).collect() == []


def fill(sizes, weights, budget, repeats):
    """Targets by sharing the excess again until none is above."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    w = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, open_, rest = {}, set(names), budget * sum(sizes.values())
    while open_:
        share = {n: rest * w[n] / sum(w[m] for m in open_) for n in open_}
        over = [n for n in open_ if share[n] > repeats * sizes[n]]
        if not over:
            return target | share
        for n in over:
            target[n] = repeats * sizes[n]
            rest -= target[n]
            open_.remove(n)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 500, "c": 30, None: 60}, {"a": 10}, {"a": 5, "b": 5, "c": 5, "d": 5000}, {"a": 0, "b": 7}, {"é": 3, "z": 90, "A": 50}])
def test_targets_equal_the_loop(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(fill(sizes, (5, 2, 1), 1.5, 2))


def test_mix(small):
    rows = mixing.mix(small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(small).collect()))
    by = {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        by.setdefault(r.source, []).append(r)
    want = fill({s: sum(r.size for r in v) for s, v in by.items()}, (5, 2, 1), 1.5, 2)
    for source, v in by.items():
        assert v[0].target == pytest.approx(want[source]) and v[0].source_size == sum(r.size for r in v)
        assert abs(sum(r.taken for r in v) - want[source]) <= max(r.size for r in v) / 2 + 1


def test_take_and_odd_rows(odd, clashing, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and {r.doc_id for r in rows if r.size == 0 and r.doc_id is not None} == {2, 3, 4}
    out = mixing.take(clashing)
    assert out.columns[: len(clashing.columns)] == clashing.columns and len(set(out.columns)) == len(out.columns)
    assert out.count() == sum(r.taken // r.size for r in rows if r.size) + sum(1 for r in out.collect() if not (r.text or "").split())
    assert mixing.mix(empty).collect() == [] and mixing.take(empty).collect() == []
