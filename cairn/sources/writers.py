"""Writers: JSON documents, text files, journals, and staged replacement of directories."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def sorted_json(df: DataFrame, pretty: bool = True) -> Column:
    """Rows as JSON text, keys in order, nulls left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"pretty": "true"} if pretty else {})


def json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    df.select(sorted_json(df, pretty=False).alias("value")).write.mode(mode).text(path)


def append_events(df: DataFrame, path: str, now: Column) -> None:
    """Append rows to a journal, each with its time."""
    df.withColumn("ts", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ssXXX")).write.mode("append").json(path)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write beside the target, then swap: readers see the old or the new table, and a failed write leaves the old one."""
    spark = df.sparkSession
    stage, backup = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex[:8]}", f"{path.rstrip('/')}.bak-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(stage)
    fs, target = _fs(spark, path)
    new, old = _fs(spark, stage)[1], _fs(spark, backup)[1]
    moved = fs.exists(target) and fs.rename(target, old)
    if not fs.rename(new, target):
        if moved:
            fs.rename(old, target)
        raise OSError(f"{stage} could not be moved to {path}")
    if moved:
        fs.delete(old, True)


def backup_once(spark: SparkSession, path: str) -> bool:
    """Copy a file or table beside itself unless that was done before; whether it was done now."""
    fs, p = _fs(spark, path)
    _, copy = _fs(spark, f"{path.rstrip('/')}.orig")
    if fs.exists(copy):
        return False
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs, copy, False, spark._jsc.hadoopConfiguration())


def front_matter(df: DataFrame, body: Column | None = None) -> Column:
    """Rows as markdown with YAML front matter: one JSON-valued line a key, null and empty-list keys left out."""
    lines = []
    for name, kind in df.dtypes:
        c = F.col(name)
        value = F.to_json(c) if kind.startswith(("array", "struct", "map")) else F.when(c.isNotNull(), F.to_json(F.array(c)))
        value = value if kind.startswith(("array", "struct", "map")) else F.regexp_replace(value, r"^\[|\]$", "")
        lines.append(F.when(value != "[]", F.concat(F.lit(f"{name}: "), value)) if kind.startswith("array") else F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)))
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"), F.lit("") if body is None else body)


def text_files(df: DataFrame, path: str, name: str, value: str) -> None:
    """One folder a row under ``path``, named by the column ``name``; written by Spark, so any store will do."""
    df.select(name, value).write.partitionBy(name).mode("overwrite").option("lineSep", "\n").text(path)


def snapshot_manifest(files: DataFrame) -> DataFrame:
    """path, length and sha256 of each file read with its content."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def resource_row(pages: DataFrame) -> DataFrame:
    """The row that a materialised HTML page leaves: paths by number and slug, sha256, text_chars, status."""
    from ..functions import text as t

    rid = t.resource_id(F.col("number"))
    stem = F.concat(F.lpad(F.col("number").cast("string"), 4, "0"), F.lit("-"), t.slugify(F.coalesce("title", "url")))
    body = t.best_text(F.col("markdown"), F.col("html"))
    ok = F.coalesce(F.col("status_code") < 400, F.lit(True)) & (body != "")
    return pages.select(
        rid.alias("resource_id"), "url", F.coalesce("final_url", "url").alias("final_url"), F.lit("html").alias("kind"), F.when(ok, "fetched").otherwise("failed").alias("status"),
        F.concat(F.lit("text/"), stem, F.lit(".txt")).alias("text_path"), F.concat(F.lit("html/"), stem, F.lit(".html")).alias("html_path"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("sha256"), F.length(body).cast("long").alias("text_chars"),
    )
