import gzip
import hashlib

import pytest

from cairn.llm import warc


@pytest.fixture
def pages(spark):
    big = "<p>ü" * 700
    rows = [(1, "u1", big), (5, "u5", big), (3, "u3", big), (2, "u2", "small"), (4, "u4", "small"), (6, None, None), (7, "u\r\n7", ""), (8, "u8", "WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 80), (9, "u9", "a\r\n\r\n" * 300 + "\n"), (None, "n", big), (10, "x", "é" * 499), (11, "x", "é" * 499), (12, "x", "é" * 500), (13, "x", "é" * 500)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def want(rows):
    out, best = set(), {}
    for r in rows:
        p = (r.html or "").encode()
        if len(p) >= 1000 and r.page_id is not None:
            best[p] = max(best.get(p, r.page_id), r.page_id)
    for r in rows:
        p = (r.html or "").encode()
        other = best.get(p) if len(p) >= 1000 and best.get(p) != r.page_id else None
        out.add((r.page_id, len(p), hashlib.sha1(p).hexdigest(), "revisit" if other is not None else "response", other))
    return out


@pytest.mark.parametrize("chunk", [1 << 20, 1000, 37])
def test_round_trip(pages, chunk):
    got = warc.round_trip(pages, chunk).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want(pages.collect())
    assert len(got) == pages.count() and all(r.intact for r in got) and max(r.n_chunks for r in got) == (1 if chunk > 9999 else -(-3500 // chunk))


def test_chunks_give_payloads_back(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.plan(pages), path, chunk_bytes=100)
    whole = {}
    for r in warc.read(spark, path).orderBy("record_id", "chunk_no").collect():
        assert len(r.data) <= 100
        whole[r.record_id] = whole.get(r.record_id, b"") + bytes(r.data)
        assert r.digest_so_far == hashlib.sha1(whole[r.record_id]).hexdigest() and r.bytes_so_far == len(whole[r.record_id])
    assert whole["id:8"] == ("WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 80).encode() and whole["id:1"] == b""


def test_files_are_plain_warc(pages, tmp_path):
    path = tmp_path / "w"
    warc.write(warc.plan(pages.where("page_id = 2")), str(path))
    raw = b"".join(gzip.open(f).read() for f in sorted(path.glob("*.gz")))
    head, _, body = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"Content-Length: 5" in head and body == b"small\r\n\r\n"


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_parser_takes_blocks_of_any_size(pages, tmp_path, step):
    path = tmp_path / "w"
    warc.write(warc.plan(pages.coalesce(1)), str(path), chunk_bytes=64)
    for f in path.glob("*.gz"):
        raw = gzip.open(f).read()
        rows = list(warc.parse(raw[k : k + step] for k in range(0, len(raw), step)))
        assert sum(r["last"] for r in rows) == pages.count()


def test_cut_archive_is_told(pages):
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse([b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nContent-Length: 9\r\n\r\nabc"]))
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.parse([b"HTTP/1.1 200\r\n\r\n"]))


def test_empty(pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_ties_are_all_responses(spark):
    big = "x" * 1000
    got = warc.round_trip(spark.createDataFrame([(1, "u", big), (2, "u", big), (2, "v", big)], "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "revisit"), (2, "response"), (2, "response")]


def test_a_plain_record_is_chunked_as_it_streams():
    """64 MiB in one record without segments, in blocks of 64 KiB: never over two chunks are held."""
    size, step = 64 << 20, 1 << 16
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nContent-Length: {size}\r\n\r\n".encode()
    parser, sha, n = warc.Parser(), hashlib.sha1(), 0
    for block in [head, *[bytes([k % 251]) * step for k in range(size // step)], b"\r\n\r\n"]:
        for row in parser.feed(block):
            sha.update(row["data"])
            assert len(row["data"]) == 1 << 20 and row["chunk_no"] == n and row["digest_so_far"] == sha.hexdigest() and row["last"] == (n == 63)
            n += 1
        assert len(parser.buffer) <= 2 << 20
    parser.close()
    assert n == 64


def test_a_long_plain_record_through_spark(spark, tmp_path):
    body = b"\n".join(b"line %d" % k for k in range(300_000))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:9>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)))
    rows = warc.read(spark, str(tmp_path)).orderBy("chunk_no").collect()
    assert [r.last for r in rows] == [False] * (len(rows) - 1) + [True] and len(rows) == -(-len(body) // (1 << 20)) > 2
    assert b"".join(bytes(r.data) for r in rows) == body and rows[-1].digest_so_far == hashlib.sha1(body).hexdigest()


def test_clashing_columns(spark, pages):
    from pyspark.sql import functions as F

    more = pages.select("*", *[F.lit(k).alias(n) for k, n in enumerate("payload payload_bytes payload_digest winner n record_type refers_to block n_chunks k data".split())])
    assert sorted(map(str, warc.round_trip(more).collect())) == sorted(map(str, warc.round_trip(pages).collect()))


def test_any_identifier_comes_back(spark):
    ids = ["null", " blank ", "<a>", "id:1", "a#2", "é 100%+", "", None, "line\r\nbreak"]
    same = "x" * 2000
    df = spark.createDataFrame([(i, "u", f"page {k}" if k % 2 else same) for k, i in enumerate(ids)], "page_id string, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert set(got) == set(ids) and all(r.intact for r in got.values())
    winner = max(i for k, i in enumerate(ids) if k % 2 == 0 and i is not None)
    assert all((r.record_type, r.refers_to) == (("response", None) if ids.index(i) % 2 or i == winner else ("revisit", winner)) for i, r in got.items())
