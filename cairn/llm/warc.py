"""WARC (5): a chunked record table.

A record is kept as rows (record_id, chunk_no, data) with the digest so far, never as one value. Chunks beyond the
first are stored as ``continuation`` records of the WARC 1.1 standard; the reader cuts records of any size, segmented or
not, into chunks as they stream past, with a running digest. (Spark's text source hands it a line at a time, so what
has no line end is as long as a line; parse() takes blocks of any size.)
Archives are gzip files written and read by Spark's own text source, whose bytes are not altered; any store works.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path

CHUNK_BYTES = 1 << 20
LEAST_SHARED = 1000
URN = "urn:record:"
CHUNKS = "record_id string, chunk_no int, data binary, digest_so_far string, bytes_so_far long, record_type string, refers_to string, payload_digest string, payload_bytes long, target_uri string, last boolean"


def plan(pages: DataFrame) -> DataFrame:
    """Records with payload facts: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Payload: html in UTF-8, null as empty. Among equal payloads of at least 1000 bytes, the one of the largest
    page_id is the response and the others revisit it; null page_ids rank below all others, and rows that tie on the
    largest are responses all. Only digests are grouped, summed up before the shuffle; payloads move once at most.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select("page_id", "url", payload.alias("payload")).withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    light = facts.where(F.col("payload_bytes") >= LEAST_SHARED).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
    shared = light.where((F.col("n") > 1) & F.col("winner").isNotNull()).drop("n")
    joined = facts.join(shared, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("winner")).alias("refers_to"),
    )


def _name(page_id: Column) -> Column:
    """An identifier that any text survives as: percent signs and pluses for what a header line could not hold; null is told from the text ``null``."""
    return F.when(page_id.isNull(), F.lit("null")).otherwise(F.concat(F.lit("id:"), F.url_encode(page_id.cast("string"))))


def _id_of(name: Column) -> Column:
    return F.when(name.startswith("id:"), F.try_url_decode(F.substring(name, 4, F.length(name))))


def _line(name: str, value: Column) -> Column:
    """One header line; control characters in the value become spaces."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " "), F.lit("\r\n"))).otherwise(F.lit(""))


def records(planned: DataFrame, date: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One text row for each WARC record; a payload of n chunks gives n records in a row, a revisit gives one without a block.

    The row holds the record up to the first line end of its trailer; the writer's line separator is the second.
    """
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    n = F.greatest(F.lit(1), F.ceil(F.length(block) / chunk_bytes).cast("int"))
    rows = planned.withColumn("block", block).withColumn("n_chunks", n).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_chunks"))))
    data = F.substring(F.col("block"), (F.col("k") - 1) * chunk_bytes + 1, F.lit(chunk_bytes))
    rows = rows.withColumn("data", data)
    first, many = F.col("k") == 1, F.col("n_chunks") > 1
    urn = F.concat(F.lit(f"<{URN}"), _name(F.col("page_id")), F.lit(">"))
    own = F.when(first, urn).otherwise(F.concat(F.lit(f"<{URN}"), _name(F.col("page_id")), F.lit("#"), F.col("k").cast("string"), F.lit(">")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(first, F.col("record_type")).otherwise(F.lit("continuation"))),
        _line("WARC-Record-ID", own),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.when(first, F.col("url"))),
        _line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        _line("WARC-Payload-Length", F.when(first, F.col("payload_bytes"))),
        _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("data"))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit(f"<{URN}"), _name(F.col("refers_to")), F.lit(">")))),
        _line("WARC-Segment-Number", F.when(many, F.col("k"))),
        _line("WARC-Segment-Origin-ID", F.when(~first, urn)),
        _line("WARC-Segment-Total-Length", F.when(many & (F.col("k") == F.col("n_chunks")), F.col("payload_bytes"))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.length("data")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head.cast("binary"), F.col("data"), F.lit(b"\r\n")).cast("string").alias("value"))


def write(planned: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write archives, one gzip file for each partition of ``planned``."""
    records(planned, date, chunk_bytes).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class Parser:
    """Reads a stream of byte blocks cut at any place and yields chunk rows of ``chunk_bytes`` at most, whether or not the archive has segments; it holds one header or chunk and the block at hand."""

    def __init__(self, chunk_bytes: int = CHUNK_BYTES) -> None:
        self.chunk_bytes = chunk_bytes
        self.buffer = bytearray()
        self.need = -1  # bytes of the block still to come; below 0 outside a block
        self.head: dict[str, str] = {}
        self.open: dict = {}

    def feed(self, block: bytes) -> Iterator[dict]:
        self.buffer += block
        at = 0
        while True:
            if self.need < 0:
                while self.buffer[at : at + 1] in (b"\r", b"\n"):
                    at += 1
                end = self.buffer.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                lines = self.buffer[at:end].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
                self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.need, at = int(self.head["content-length"]), end + 4
                self._begin()
            size = min(self.need, self.chunk_bytes)
            if len(self.buffer) - at < size:
                break
            data = bytes(self.buffer[at : at + size])
            at, self.need = at + size, self.need - size
            yield self._chunk(data, not self.need)
            if not self.need:
                self.need = -1
        del self.buffer[:at]

    def _begin(self) -> None:
        """A header was read: of a new record, or of a segment of the one before."""
        h = self.head
        bare = lambda x: x.strip("<>").removeprefix(URN)
        if h["warc-type"] != "continuation":
            self.open = {
                "record_id": bare(h["warc-record-id"]), "chunk_no": -1, "sha": hashlib.sha1(), "bytes": 0, "record_type": h["warc-type"], "target_uri": h.get("warc-target-uri"),
                "refers_to": bare(h["warc-refers-to"]) if "warc-refers-to" in h else None, "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                "payload_bytes": int(h["warc-payload-length"]) if "warc-payload-length" in h else None,
            }
        elif bare(h["warc-segment-origin-id"]) != self.open.get("record_id"):
            raise ValueError(f"a segment of {h['warc-segment-origin-id']} without the one before it")

    def _chunk(self, data: bytes, ends: bool) -> dict:
        h, o = self.head, self.open
        o["chunk_no"] += 1
        o["sha"].update(data)
        o["bytes"] += len(data)
        last = ends and ("warc-segment-number" not in h or "warc-segment-total-length" in h)
        return {
            "record_id": o["record_id"], "chunk_no": o["chunk_no"], "data": data, "digest_so_far": o["sha"].hexdigest(), "bytes_so_far": o["bytes"], "record_type": o["record_type"],
            "refers_to": o["refers_to"], "payload_digest": o["payload_digest"], "payload_bytes": o["payload_bytes"], "target_uri": o["target_uri"], "last": last,
        }

    def close(self) -> None:
        if self.need >= 0 or bytes(self.buffer).strip():
            raise ValueError("the archive ends inside a record")


def parse(blocks: Iterable[bytes], chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of one archive given as byte blocks, such as reads of an open file."""
    parser = Parser(chunk_bytes)
    for block in blocks:
        yield from parser.feed(block)
    parser.close()


_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("chunk_no", pa.int32()), ("data", pa.binary()), ("digest_so_far", pa.string()), ("bytes_so_far", pa.int64()), ("record_type", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("target_uri", pa.string()), ("last", pa.bool_()),
    ]
)


def _lines(batches: Iterator[pa.RecordBatch], with_data: bool) -> Iterator[pa.RecordBatch]:
    """Lines of gzip files, whole files in order, to chunk rows; ``with_data`` false leaves the payloads out of the rows."""
    parser, path, rows, held = Parser(), None, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    for batch in batches:
        for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != path:
                parser.close()
                parser, path = Parser(), name
            for row in parser.feed(line + b"\n"):
                held += len(row["data"])
                rows.append(row if with_data else row | {"data": None})
                if len(rows) >= 2000 or held >= 16 << 20:
                    yield flush()
                    rows, held = [], 0
    parser.close()
    if rows:
        yield flush()


def read(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """The chunk table of all archives under ``path``: gzip files are not split, so a task streams whole files in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    picked = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"))
    return picked.mapInArrow(lambda batches: _lines(batches, with_data), CHUNKS)


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder, read them back, and return one row per record.

    payload_bytes and payload_digest of a response come from the bytes read; those of a revisit, which has no block,
    from its header. An empty table gives an empty result; a null page_id comes back as null, any other as it was.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(plan(pages), path, chunk_bytes=chunk_bytes)
    got = read(spark, path, with_data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    kind = pages.schema["page_id"].dataType
    return got.select(
        _id_of(F.col("record_id")).cast(kind).alias("page_id"),
        F.when(revisit, F.col("payload_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type", _id_of(F.col("refers_to")).cast(kind).alias("refers_to"),
        (F.col("chunk_no") + 1).alias("n_chunks"),
        (revisit | (F.col("digest_so_far") == F.col("payload_digest"))).alias("intact"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS winner FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> winner THEN winner END AS refers_to,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> winner THEN 1 ELSE greatest(1, ceil(payload_bytes / {CHUNK_BYTES}))::INTEGER END AS n_chunks, true AS intact
FROM w"""
