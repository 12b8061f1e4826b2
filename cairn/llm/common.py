"""Pieces that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word is a run of anything but space and the controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Tables up to this size may be dealt anew before work on them starts.
SMALL_BYTES = 128 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table under ``sf_dir``. One of a few small files is dealt over all cores, since a small file gives one task; a table beyond SMALL_BYTES is read as it lies."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.count("*").alias("n"), F.sum("length").alias("size")).first()
    return df.repartition(cores) if files.n < cores and (files.size or 0) <= SMALL_BYTES else df


def fold_case(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def free_prefix(df: DataFrame, start: str) -> str:
    """``start``, lengthened until no column of ``df`` begins with it."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(start.lower()) for c in taken):
        start += "_"
    return start


def words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier's text, by ``modulus``; a null identifier counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(doc_id: Column, text: Column) -> Column:
    """A key of a document that holds for null and repeated identifiers; equal rows share it."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("\x00")), F.coalesce(text, F.lit("\x00")))


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, lost executors do not matter, and the planner knows its size."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)
    out.scratch_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Delete the files of frames from stored() that nothing reads any more."""
    for df in frames:
        target, files = _file_system(df.sparkSession, df.scratch_path)
        files.delete(target, True)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Batches sorted by ``key``, put together to some ``rows`` rows such that no group is cut."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        n += len(b)
        if n < rows or held[0].column(key)[0] == b.column(key)[-1]:
            continue
        whole = pa.Table.from_batches(held)
        last = b.column(key)[-1]
        at = b.column(key).index(last).as_py()
        cut = n - len(b) + at
        if not at:  # the last group may have begun in a batch before
            keys = whole.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
        yield whole.slice(0, cut)
        held, n = whole.slice(cut).to_batches(), n - cut
    if held:
        yield pa.Table.from_batches(held)
