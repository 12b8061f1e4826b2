"""Session defaults and table access shared by all plans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def build_session(app: str = "cairn", cores: str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings every query of this package assumes: UTC, AQE, Arrow."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir``; the path may be on any store Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local master gets a folder of its own, and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/cairn-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: what follows does not compute it again, and lost executors do not matter."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
