"""Streaming forms give what the batch forms give."""

import pytest
from pyspark.sql import functions as F

from cairn.operators import news, registry
from cairn.streaming import delta, runs

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture
def source(spark, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(EVENTS).withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(3, "ts").sortWithinPartitions("ts", "event_id").write.parquet(str(src))
    return spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))


def collect(df, tmp_path, mode="append"):
    out = []
    delta.run_available(df, str(tmp_path / "cp"), lambda batch, _: out.extend(batch.collect()), mode)
    return out


def test_first_sight_equals_batch(spark, source, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    got = collect(delta.first_sight(source, "user_id", "event_type", ["event_id", "user_id", "event_type"]), tmp_path)
    batch = news.first_seen(spark.read.parquet(EVENTS), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).collect()
    assert len(got) == len(batch)
    new = lambda rows: {(r.user_id, r.event_type) for r in rows if r.is_new}
    assert new(got) == new(batch) and sum(r.is_new for r in got) == sum(r.is_new for r in batch)


def test_distinct_within(source, tmp_path):
    got = collect(delta.distinct_within(source.select("ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "90 days"), tmp_path)
    assert len(got) == len({(r.user_id, r.event_type) for r in got})


def test_windows(spark, source, tmp_path):
    out = collect(delta.tumbling(source, "ts", "1 day", "0 seconds", ["event_type"]), tmp_path, "update")
    last = {(r.window.start, r.event_type): r.n for r in out}
    assert sum(last.values()) == spark.read.parquet(EVENTS).count()


def test_latest_state(spark, source, tmp_path):
    log = source.select("user_id", F.col("event_type").alias("status"), "ts")
    last = {r.user_id: r.status for r in collect(delta.latest_state(log, ["user_id"]), tmp_path, "update")}
    batch = {r.user_id: r.status for r in spark.read.parquet(EVENTS).groupBy("user_id").agg(F.max_by("event_type", "ts").alias("status")).collect()}
    assert set(last) == set(batch)


def test_upsert_sink(spark):
    ddl = "k string, quality_status string, updated_at int"
    table = [spark.createDataFrame([("a", "complete", 1)], ddl)]
    sink = delta.upsert_sink(lambda: table[0], lambda df: table.__setitem__(0, spark.createDataFrame(df.collect(), ddl)), ["k"])
    batch = spark.createDataFrame([("a", "complete", 2), ("a", "complete", 3), ("b", "partial", 2), ("c", "complete", 2)], ddl)
    for _ in range(2):  # a batch that runs again changes nothing
        sink(batch, 0)
        assert sorted(map(tuple, table[0].collect())) == [("a", "complete", 3), ("c", "complete", 2)]
    assert registry.upsert(table[0], batch.limit(0), ["k"]).count() == 2


def test_punctual(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2025-01-01",), ("2026-01-04",), (None,)], "d string").select(F.to_date("d").alias("date"))
    assert delta.punctual(df, F.lit("2026-01-01").cast("date"), 30).count() == 1


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
END = "2100-01-01 00:00:00"


def feed(spark, path, name, rows, ddl):
    """One more file for a stream to find; ``rows`` begin with key, time, nr."""
    spark.createDataFrame(rows, ddl).withColumn("time", F.to_timestamp("time")).coalesce(1).write.parquet(f"{path}/{name}")


def stream(spark, path, ddl, lateness="0 seconds"):
    schema = spark.createDataFrame([], ddl).withColumn("time", F.to_timestamp("time")).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    return s.withWatermark("time", lateness) if lateness else s


def work(n, seed):
    rng = __import__("random").Random(seed)
    out = []
    for k in range(n):
        minute = 3 * k + rng.randrange(3)
        at = f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"
        start = max(0, minute - rng.randrange(12))
        out.append((rng.choice("abcd"), at, k, f"2024-01-01 {start // 60:02d}:{start % 60:02d}:00", rng.randrange(10), rng.random() < 0.6))
    return out


def by_loop(rows, budget, seconds, window):
    import datetime as dt

    when = lambda t: dt.datetime.fromisoformat(t)
    out = []
    for key in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        clock, cost, recent, stop = when(mine[0][1]) + dt.timedelta(seconds=seconds), 0, [], None
        for _, at, nr, started, price, failed in mine:
            if stop is None and when(at) >= clock:
                stop = clock, "stop_wallclock"
                out.append((key, None, "stop", stop[1], cost))
            if stop and when(started) > stop[0]:
                out.append((key, nr, "refused", stop[1], cost))
                continue
            cost, recent = cost + price, (recent + [failed])[-window:]
            out.append((key, nr, "in flight" if stop else "run", stop and stop[1], cost))
            if stop is None and (cost >= budget or len(recent) == window and all(recent)):
                stop = when(at), "stop_budget" if cost >= budget else "stop_failures"
                out.append((key, None, "stop", stop[1], cost))
        if stop is None:
            out.append((key, None, "stop", "stop_wallclock", cost))
    return sorted(out, key=str)


WORK = "k string, time string, nr long, started string, cost long, failed boolean"


@pytest.mark.parametrize(("budget", "seconds", "window"), [(120, 10**6, 9), (10**6, 6000, 9), (10**6, 10**6, 3)])
def test_stop_rules_and_a_restart(spark, tmp_path, budget, seconds, window):
    """Files in three runs of the query, each going on from the checkpoint: the first breach stops, whatever batch it is in."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = work(120, seed=window)
    got = []

    def run():
        s = stream(spark, f"{tmp_path}/in", WORK).withColumn("started", F.to_timestamp("started"))
        delta.run_available(runs.stop_rules(s, "k", budget, seconds, window), f"{tmp_path}/cp", lambda b, _: got.extend(b.collect()))

    for part, (a, b) in enumerate(((0, 50), (50, 51), (51, 120))):
        feed(spark, f"{tmp_path}/in", f"p{part}", rows[a:b], WORK)
        run()
    feed(spark, f"{tmp_path}/in", "end", [("end", END, 0, END, 0, False)], WORK)
    run()
    assert sorted(((r.k, r.nr, r.verdict, r.reason, r.cost) for r in got if r.k != "end"), key=str) == by_loop(rows, budget, seconds, window)
    assert {r.verdict for r in got} >= {"run", "stop", "refused"}


def test_stop_rules_equal_the_batch_forms(spark, tmp_path):
    from cairn.operators import journal

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = work(150, seed=8)
    feed(spark, f"{tmp_path}/in", "p", rows + [("end", END, 0, END, 0, False)], WORK)
    s = stream(spark, f"{tmp_path}/in", WORK).withColumn("started", F.to_timestamp("started"))
    stops = {r.k: (r.reason, r.cost) for r in collect(runs.stop_rules(s, "k", 100, 10**8, 3), tmp_path) if r.verdict == "stop" and r.k != "end"}
    df = spark.createDataFrame(rows, WORK)
    order = [F.col("time"), F.col("nr")]
    marked = journal.cumulative(journal.failure_window(df, ["k"], order, F.col("failed"), 3), ["k"], order, F.col("cost"), F.lit(100))
    first = marked.where("stop OR capped").groupBy("k").agg(F.min_by(F.struct("capped", "running"), F.struct("time", "nr")).alias("x")).select("k", "x.*").collect()
    assert {r.k: ("stop_budget" if r.capped else "stop_failures", r.running) for r in first} == {k: v for k, v in stops.items() if v[0] != "stop_wallclock"} and first


ITEMS = "k string, time string, nr long, event string, valid boolean, status string"


def test_sessions_end_by_event_or_by_time(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    t = lambda m: f"2024-01-01 00:{m:02d}:00"
    rows = [
        ("a", t(1), 1, "item", True, None), ("a", t(2), 2, "item", False, None), ("a", t(3), 3, "finalize", False, "complete"), ("a", t(4), 4, "item", True, None), ("a", t(5), 5, "finalize", True, "complete"), ("a", t(6), 6, "item", True, None),
        ("b", t(1), 1, "item", True, None), ("b", t(30), 2, "item", True, None), ("c", t(2), 1, "finalize", True, "partial"),
    ]
    feed(spark, f"{tmp_path}/in", "p1", rows[::-1], ITEMS)
    feed(spark, f"{tmp_path}/in", "p2", [("end", END, 0, "item", True, None)], ITEMS)
    got = {(r.k, r.kind): (r.n, r.status) for r in collect(runs.sessions(stream(spark, f"{tmp_path}/in", ITEMS), "k", 600), tmp_path)}
    assert {k: v for k, v in got.items() if k[0] != "end"} == {("a", "document"): (2, "complete"), ("a", "late"): (1, None), ("b", "document"): (1, "failed"), ("b", "late"): (1, None), ("c", "document"): (0, "partial")}


STATES = "k string, time string, nr long, status string"


def test_transitions_after_a_crash(spark, tmp_path):
    """State from the recovered table, legal changes only, and the same in one go as in two."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    from cairn.operators import journal

    rng = __import__("random").Random(5)
    rows = [(rng.choice("abc"), f"2024-01-01 {k // 60:02d}:{k % 60:02d}:00", k, rng.choice(["pending", "running", "done", "failed", "running"])) for k in range(40)]
    crashed = journal.recover(spark.createDataFrame([("a", "running"), ("b", "done"), ("z", "failed")], "k string, status string"))
    legal = {"pending": ("running",), "running": ("done", "failed", "pending"), "failed": ("pending", "running"), "done": ()}
    want, now = [], {"a": "pending", "b": "done"}
    for k, _, nr, status in rows:
        before = now.get(k, "pending")
        ok = status == before or status in legal[before]
        now[k] = status if ok else before
        want.append((k, nr, before, status, ok))
    for parts in ([rows], [rows[:17], rows[17:]]):
        folder, got = f"{tmp_path}/{len(parts)}", []
        for n, part in enumerate([*parts, [("end", END, 0, "pending")]]):
            feed(spark, f"{folder}/in", f"p{n}", part, STATES)
            delta.run_available(runs.transitions(stream(spark, f"{folder}/in", STATES), "k", crashed), f"{folder}/cp", lambda b, _, got=got: got.extend(b.collect()))
        assert sorted((r.k, r.nr, r.before, r.status, r.legal) for r in got if r.k != "end") == sorted(want)
    assert any(not x[4] for x in want)


def test_windows_close_and_late_rows_are_dropped(spark, tmp_path):
    ddl = "k string, time string, nr long"
    t = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    files = [[("a", t(1), 1), ("a", t(50), 2)], [("a", t(130), 3)], [("a", t(131), 6)], [("a", t(20), 4), ("a", t(125), 5)], [("a", END, 9)]]
    for n, rows in enumerate(files):
        feed(spark, f"{tmp_path}/in", f"p{n}", rows, ddl)
    got = []
    g = delta.tumbling(stream(spark, f"{tmp_path}/in", ddl, None), "time", "1 hour", "30 minutes", ["k"])
    q = g.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).foreachBatch(lambda b, _: got.extend(b.collect())).start()
    q.awaitTermination()
    assert sorted((r.window.start.hour, r.n) for r in got) == [(0, 2), (2, 3)] and runs.late_rows(q) == 1


def test_polls_commit_as_one(spark, tmp_path):
    from cairn.streaming import poll

    path, ddl = f"{tmp_path}/news", "slug string, url string, date date"
    rows = lambda xs: spark.createDataFrame([(s, u, __import__("datetime").date(2024, 1, d)) for s, u, d in xs], ddl)
    run = poll.sink(path, lambda k: f"2024-02-0{k + 1}")
    tables = lambda: {n: sorted(map(str, poll.read(spark, path, n).collect())) for n in poll.TABLES}
    assert poll.committed(spark, path) == [] and all(not v for v in tables().values())
    run(rows([("a", "u1", 1), ("a", "u2", 2), ("a", "u1", 3), ("b", "u1", 1)]), 0)
    run(rows([("a", "u2", 2), ("a", "u3", 9), (None, "x", 1)]), 1)
    before = tables()
    assert [(r.slug, r.url, r.is_new, r.place, str(r.first_seen_at)[:10]) for r in poll.read(spark, path, "items").where("poll = 1").orderBy("place").collect()] == [("a", "u3", True, 1, "2024-02-02"), ("a", "u2", False, 2, "2024-02-01")]
    assert {(r.slug, r.seen, r.polls_completed) for r in poll.state(spark, path).collect()} == {("a", 3, 2), ("b", 1, 1)}
    for k, batch in ((1, [("a", "u2", 2), ("a", "u3", 9)]), (0, [("a", "u1", 1), ("a", "u2", 2), ("a", "u1", 3), ("b", "u1", 1)])):
        run(rows(batch), k)  # a poll that runs again changes nothing
        assert tables() == before

    class Dies(Exception):
        pass

    def dead(k):
        raise Dies

    with pytest.raises(Dies):
        poll.sink(path, dead)(rows([("a", "u9", 9)]), 2)
    rows([("a", "u9", 9)]).selectExpr("slug", "url", "timestamp'2024-03-01' AS first_seen_at").write.parquet(f"{path}/seen/poll=2")  # a poll that died half way
    assert tables() == before
    run(rows([("a", "u9", 9)]), 2)
    assert poll.read(spark, path, "items").where("poll = 2").first().is_new and poll.committed(spark, path) == [0, 1, 2]


def test_polls_as_a_stream(spark, tmp_path):
    from cairn.streaming import poll

    src = f"{tmp_path}/in"
    for k in range(3):
        spark.range(40).selectExpr("concat('v', id % 4) AS slug", f"concat('u', id % {10 + 5 * k}) AS url", "date'2024-01-01' AS date").coalesce(1).write.parquet(f"{src}/p{k}")
    s = spark.readStream.schema("slug string, url string, date date").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    delta.run_available(s, f"{tmp_path}/cp", poll.sink(f"{tmp_path}/news", lambda k: f"2024-02-{k + 1:02d}"))
    seen = poll.read(spark, f"{tmp_path}/news", "seen")
    assert seen.count() == seen.select("slug", "url").distinct().count() == spark.read.option("recursiveFileLookup", True).parquet(src).select("slug", "url").distinct().count()
