"""Readers and writers over files made here."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cairn import schemas
from cairn.sources import readers, writers


@pytest.fixture
def workspace(tmp_path):
    for run, created in (("r1", "2026-05-01T00:00:00+00:00"), ("r2", None)):
        d = tmp_path / "output" / "runs" / run / "targets" / "acme"
        d.mkdir(parents=True)
        body = {"target_id": "acme", "homepage_url": "https://a.com", "run_id": run, "created_at": created, "crawl_index": [{"url": "https://a.com/x", "depth": 1, "status": "fetched", "resource_id": "resource-0001"}], "resources": [], "links": []}
        (d / "manifest.json").write_text(json.dumps(body, indent=1))
    bad = tmp_path / "output" / "runs" / "r3" / "targets" / "acme"
    bad.mkdir(parents=True)
    (bad / "manifest.json").write_text("{not json")
    return str(tmp_path)


def test_corpora(spark, workspace):
    good, bad = readers.split_corrupt(readers.corpora(spark, workspace).cache())
    assert bad.count() == 1
    rows = {r.run_id: r for r in readers.runs_in_order(good).collect()}
    assert set(rows) == {"r1", "r2"} and rows["r1"].seq == 1 and rows["r2"].created_at > "2026"
    entries = readers.child(good, "crawl_index").collect()
    assert [(e.target_id, e.url, e.pos) for e in entries] == [("acme", "https://a.com/x", 0)] * 2


def test_targets(spark, tmp_path):
    p = tmp_path / "targets.jsonl"
    p.write_text('# comment\n\n{"name": "A", "homepage_url": "https://a", "seed_urls": ["s1"], "follow_ups": [{"url": "s2"}, {"url": "s1"}]}\n{"name": "B"}\nnot json\n')
    rows = readers.targets(spark, str(p)).orderBy("line").collect()
    assert [(r.line, r.name, r.seed_urls, r.problem) for r in rows] == [(3, "A", ["s1", "s2"], None), (4, "B", [], "homepage missing"), (5, None, [], "name missing")]
    lit = readers.target_literals(spark.createDataFrame([("A=https://a?x=1",), ("B",), ("C=ftp://x",)], "raw string")).collect()
    assert [(r.name, r.problem) for r in lit] == [("A", None), ("B", "not Name=URL"), ("C", "not Name=URL")]


def test_texts_and_lines(spark, tmp_path):
    (tmp_path / "0001-home.txt").write_text("a\nb")
    (tmp_path / "0001-zz.txt").write_text("other")
    (tmp_path / "0002-x.txt").write_text("c")
    t = readers.texts(spark, str(tmp_path))
    assert {r.number: r.text for r in t.collect()} == {1: "a\nb", 2: "c"}
    assert [(r.number, r.line_no, r.line) for r in readers.lines(t).orderBy("number", "line_no").collect()] == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]


def test_tolerant_json(spark):
    df = spark.createDataFrame([(1, '{"entries": [{"url": "a"}]}'), (2, '[{"url": "b"}, {"url": "c"}]'), (3, "broken")], "k int, value string")
    got = readers.crawl_entries(df).select("k", F.expr("variant_get(entry, '$.url', 'string')").alias("url"))
    assert sorted((r.k, r.url) for r in got.collect()) == [(1, "a"), (2, "b"), (2, "c")]
    assert [r.unknown for r in readers.unknown_fields(df.limit(1), "value", ["url"]).collect()] == [["entries"]]


def test_citation_walk(spark):
    doc = {"hq": {"evidence": [{"resource_id": "r1", "line_start": 1, "line_end": 2, "snippet": "s"}]}, "items": [{"deep": {"evidence": [{"resource_id": "r2", "line_start": 3}]}}]}
    got = readers.citations(spark.createDataFrame([(7, json.dumps(doc))], "k int, doc string"), "doc", ["k"])
    assert {(r.k, r.at, r.resource_id, r.line_start) for r in got.collect()} == {(7, "$.hq.evidence[0]", "r1", 1), (7, "$.items[0].deep.evidence[0]", "r2", 3)}


def test_small_readers(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "none"), schemas.JOURNAL).count() == 0
    m = readers.mapped_urls(spark.createDataFrame([(["https://a", "x", "https://a", "http://b", None],)], "items array<string>"), limit=2)
    assert m.first().items == ["https://a", "http://b"]
    c = readers.cached(spark.createDataFrame([("u",), ("v",)], "url string"), spark.createDataFrame([("u", "body")], "url string, body string").select(F.sha1("url").alias("cache_key"), "body"))
    assert {r.url: r.body for r in c.collect()} == {"u": "body", "v": None}
    d = readers.downloads(spark.createDataFrame([(200, bytearray(b"x")), (404, bytearray(b"x")), (None, None)], "status_code int, content binary"))
    assert [r.status for r in d.collect()] == ["fetched", "failed", "failed"]
    (tmp_path / "f.bin").write_bytes(b"abc")
    assert [(r.length, "content" in r.asDict()) for r in readers.binaries(spark, str(tmp_path)).collect()] == [(3, False)]


def test_replace_swaps(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace(spark.range(3), path)
    writers.replace(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [x for x in os.listdir(tmp_path) if "tmp" in x or "bak" in x] == []
    assert writers.exists(spark, path) and writers.backup_once(spark, path) and not writers.backup_once(spark, path)


def test_json_and_front_matter(spark, tmp_path):
    df = spark.createDataFrame([(1, "x: y", [], ["a"], None)], "b int, a string, e array<string>, f array<string>, n string")
    writers.json_lines(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":"x: y","b":1,"e":[],"f":["a"]}'
    assert df.select(writers.front_matter(df).alias("m")).first().m == '---\nb: 1\na: "x: y"\nf: ["a"]\n---\n'
    writers.append_events(spark.createDataFrame([("start",)], "event string"), str(tmp_path / "log"), F.lit("2026-01-01").cast("timestamp"))
    writers.append_events(spark.createDataFrame([("stop",)], "event string"), str(tmp_path / "log"), F.lit("2026-01-02").cast("timestamp"))
    assert sorted(r.event for r in spark.read.json(str(tmp_path / "log")).collect()) == ["start", "stop"]


def test_resource_row(spark):
    p = spark.createDataFrame([(3, "https://a/x", None, "A Title", "# md\n\ntext", "<p>h</p>", 200), (4, "https://a/y", None, None, None, None, 500)], "number int, url string, final_url string, title string, markdown string, html string, status_code int")
    got = writers.resource_row(p).collect()
    assert (got[0].resource_id, got[0].text_path, got[0].text_chars, got[0].status) == ("resource-0003", "text/0003-a-title.txt", 9, "fetched") and got[1].status == "failed"


def test_citations_at_any_depth(spark):
    deep = "1"
    for k in range(30):
        deep = '{"a":[' + deep + "]}"
    doc = json.dumps({"x": "]]}}{{[", "e": [{"resource_id": "resource-0001", "line_start": 3}]})
    nested = '{"k":' * 25 + '{"resource_id":"resource-0002","snippet":"s"}' + "}" * 25
    df = spark.createDataFrame([(1, doc), (2, nested), (3, deep), (4, "{broken"), (5, None)], "k int, doc string")
    assert [(r.k, r.at, r.resource_id) for r in readers.citations(df, "doc", ["k"]).collect()] == [(1, "$.e[0]", "resource-0001")]
    assert sorted((r.k, r.resource_id, r.line_start) for r in readers.citations(df, "doc", ["k"], loose=True).collect()) == [(1, "resource-0001", 3), (2, "resource-0002", None)]
    assert readers.citations(df.limit(0), "doc", ["k"]).collect() == []


def test_citations_below_many_levels(spark):
    """Depth costs passes, not plan; texts that do not parse stop nothing."""
    nest = lambda n: '{"a":[' * n + '{"resource_id":"resource-1","line_start":%d}' % n + "]}" * n
    df = spark.createDataFrame([*[(n, nest(n)) for n in (0, 5, 6, 40, 100, 480)], (7, "[" * 100_000), (8, "{" * 100_000 + "}" * 100_000), (9, nest(600))], "k int, doc string")
    got = readers.citations(df, "doc", ["k"])
    assert sorted((r.k, r.at) for r in got.collect()) == [(n, "$" + ".a[0]" * n) for n in (0, 5, 6, 40, 100, 480)]
    assert len(got._jdf.queryExecution().analyzed().toString()) < 20_000


def test_citations_cost_no_pass_for_depth(spark):
    """The deepest text that parses is walked within its row: no job runs and nothing is written before the result is asked for."""
    nest = lambda n: '[' * (n - 1) + '{"resource_id":7,"line_start":"3"}' + "]" * (n - 1)
    odd = '{"resource_id":"r","line_start":1,"b":[{"resource_id":"s","line_start":2,"[{":[[],[{"resource_id":"t","line_start":3}]]},4,null],"c":{"resource_id":null,"line_start":5}}'
    df = spark.createDataFrame([(1, nest(1000)), (2, nest(1001)), (3, odd), (4, "7"), (5, "[]")], "k int, doc string")
    spark.sparkContext.setJobGroup("deep-citations", "")
    try:
        got = readers.citations(df, "doc", ["k"])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("deep-citations")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = [(1, "$" + "[0]" * 999, "7", 3), (3, "$", "r", 1), (3, "$.b[0]", "s", 2), (3, "$.b[0].[{[1][0]", "t", 3)]
    assert sorted((r.k, r.at, r.resource_id, r.line_start) for r in got.collect()) == want


def test_walk_gives_every_node(spark):
    from cairn.operators.walk import walk

    rng = __import__("random").Random(3)
    parent = {k: rng.randrange(max(0, k - 3), k) for k in range(1, 200)}
    below = {k: [c for c, p in parent.items() if p == k] for k in range(200)}
    roots = spark.createDataFrame([(1, "0", 0), (2, "0", 150)], "tree int, at string, v int")
    kids = "transform(filter(array(" + ",".join(f"named_struct('p', {p}, 'c', {c})" for c, p in parent.items()) + "), e -> e.p = v), e -> struct(concat(at, '/', e.c) AS at, e.c AS v))"
    got = {(r.tree, r.at, r.v) for r in walk(roots, ["tree"], kids, 2, 3).collect()}

    def down(k, at):
        yield at, k
        for c in below[k]:
            yield from down(c, f"{at}/{c}")

    assert got == {(t, at, v) for t, root in ((1, 0), (2, 150)) for at, v in down(root, "0")}


def test_documents_and_path_parts(spark, tmp_path):
    (tmp_path / "vendors" / "acme").mkdir(parents=True)
    (tmp_path / "vendors" / "acme" / "state.json").write_text('{"slug": "acme", "polls_completed": 2}')
    row = readers.documents(spark, str(tmp_path / "vendors" / "*" / "state.json"), schemas.NEWS_STATE).select("slug", "polls_completed", readers.path_part(F.col("path"), "vendors").alias("v"), readers.path_part(F.col("path"), "none").alias("n")).first()
    assert tuple(row) == ("acme", 2, "acme", None)


def test_link_edges(spark):
    df = spark.createDataFrame([("a", ["u", None, "v"]), ("b", None)], "k string, links array<string>")
    assert [tuple(r) for r in readers.link_edges(df, ["k"]).collect()] == [("a", "u"), ("a", "v")]


def test_text_forms(spark, tmp_path):
    df = spark.createDataFrame([("b", None, 1)], "z string, a string, m int")
    assert df.select(writers.sorted_json(df, pretty=False)).first()[0] == '{"m":1,"z":"b"}'
    writers.text_files(spark.createDataFrame([("one", "x\ny"), ("two", "z")], "name string, body string"), str(tmp_path / "t"), "name", "body")
    assert sorted(os.listdir(tmp_path / "t"))[-2:] == ["name=one", "name=two"]
    (tmp_path / "f.bin").write_bytes(b"abc")
    m = writers.snapshot_manifest(readers.binaries(spark, str(tmp_path / "f.bin"), with_content=True)).first()
    assert m.length == 3 and m.sha256 == __import__("hashlib").sha256(b"abc").hexdigest()


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace as N

    from cairn.session import scratch_path, shared_folder

    of = lambda master, folder: shared_folder(N(conf=N(get=lambda *_: folder), sparkContext=N(master=master, applicationId="a1")))
    assert of("spark://host:7077", "hdfs://x/") == of("local[2]", "hdfs://x") == "hdfs://x/cairn-a1" and of("local[2]", None).startswith("file:")
    for master in ("spark://host:7077", "local-cluster[3,2,1000]", "yarn"):
        with pytest.raises(ValueError, match="share"):
            of(master, None)
    assert "/cairn-" in scratch_path(spark, "x")


def test_front_matter_comes_back(spark):
    ddl = "designation string, names array<string>, year int, product struct<name:string,n:int>, ok boolean"
    rows = [("A.0042", ['say "hi"', "a: b", "line\nbreak", "é – ü"], 1999, ("x: y", 2), True), ("B", [], None, None, False), ("---", ["---"], 0, (None, None), None)]
    df = spark.createDataFrame(rows, ddl)
    text = df.select(writers.front_matter(df, F.concat(F.lit("# Head\n---\nbody of "), "designation")).alias("value"))
    got = readers.front_matter(text, ddl).collect()
    plain = lambda r: (r.designation, list(r.names or []), r.year, r.product and (r.product.name, r.product.n), r.ok)
    want = [(d, n, y, p if p != (None, None) else r.product and (None, None), o) for (d, n, y, p, o), r in zip(rows, got, strict=True)]
    assert [plain(r) for r in got] == want
    assert [r.body for r in got] == [f"# Head\n---\nbody of {r[0]}" for r in rows] and all(r.problem is None for r in got)


def test_broken_front_matter_is_set_aside(spark):
    texts = ["no fence", "---\nyear: 1\nstray line\n---\nx", "---\nyear: {1\n---\nx", '---\nyear: "a"\n---\nx', "---\nyear: 7\nmore: 1\n---\nbody", "---\n---\nempty", None, '---\r\nyear: 8\r\n---\r\nwin']
    got = readers.front_matter(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, value string"), "year int, name string").orderBy("k").collect()
    assert [r.problem for r in got] == ["no front matter", "not key: value: stray line", "not JSON", "wrong type", None, None, "no front matter", None]
    assert [r.year for r in got] == [None, None, None, None, 7, None, None, 8] and got[4].body == "body" and got[5].body == "empty" and got[0].body == "no fence" and got[7].body == "win"


def test_archive_snapshots(spark, tmp_path):
    import hashlib
    import os
    import subprocess

    from cairn.sources import archive

    spark.dataSource.register(archive.TarArchive)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    path = str(tmp_path / "snapshots")
    df = spark.range(100).select(F.concat(F.lit("runs/r"), F.col("id") % 3, F.lit("/f"), F.col("id")).alias("path"), F.encode(F.repeat(F.lit("é"), F.col("id").cast("int")), "utf-8").alias("content")).repartition(3)
    write = lambda d, name: d.write.format("tar_archive").option("path", path).option("snapshot", name).mode("append").save()
    assert archive.latest(path) is None
    for name in ("s1", "s2"):
        write(df, name)
        manifest = json.load(open(f"{path}/{name}/manifest.json"))
        assert archive.latest(path) == name and manifest["file_count"] == 100 and len(manifest["shards"]) == 3
    for s in manifest["shards"]:  # plain tar opens a shard, and its digest is that of the manifest
        raw = open(f"{path}/s2/{s['filename']}", "rb").read()
        assert hashlib.sha256(raw).hexdigest() == s["sha256"] and len(raw) == s["bytes"]
        assert subprocess.run(["tar", "tzf", f"{path}/s2/{s['filename']}"], capture_output=True, text=True, check=True).stdout.count("\n") == s["file_count"]
    r = lambda: spark.read.format("tar_archive").option("path", path).load()
    plain = lambda d: sorted((x.path, bytes(x.content)) for x in d.select("path", "content").collect())
    assert plain(r().where("snapshot = 's1'")) == plain(df) and r().count() == 200 and r().where("snapshot = 'none'").count() == 0
    assert plain(r().where("snapshot IN ('s2', 'x') AND path LIKE 'runs/r1/%'")) == plain(df.where("path LIKE 'runs/r1/%'"))
    reader = archive.ArchiveReader(path)
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("snapshot",), "s2"), EqualTo(("shard",), "x")])) == [EqualTo(("shard",), "x")] and {p.snapshot for p in reader.partitions()} == {"s2"}
    with pytest.raises(Exception, match="there already"):
        write(df, "s1")
    bad = df.withColumn("path", F.when(F.col("path").endswith("7"), F.raise_error(F.lit("a task dies"))).otherwise(F.col("path")))
    with pytest.raises(Exception, match="a task dies"):
        write(bad, "s3")
    assert sorted(os.listdir(path)) == ["latest.json", "s1", "s2"] and archive.latest(path) == "s2" and plain(r().where("snapshot = 's1'")) == plain(df)
