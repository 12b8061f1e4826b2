"""Structured Streaming forms: first sight of an item, lateness, state transitions, registry upsert, event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType


class FirstSight(StatefulProcessor):
    """Per key a map of the items seen; each row comes out with is_new. With ``ttl_ms`` an item is forgotten after that time."""

    def __init__(self, item: str, columns: list[str], ttl_ms: int | None = None) -> None:
        self.item, self.columns, self.ttl_ms = item, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        key, value = StructType([StructField("item", StringType())]), StructType([StructField("n", IntegerType())])
        self.seen = handle.getMapState("seen", key, value, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            new = []
            for x in pdf[self.item]:
                fresh = not self.seen.containsKey((x,))
                if fresh:
                    self.seen.updateValue((x,), (1,))
                new.append(fresh)
            yield pdf[self.columns].assign(is_new=new)

    def close(self) -> None:
        pass


def first_sight(stream: DataFrame, key: str, item: str, columns: list[str], ttl_ms: int | None = None) -> DataFrame:
    """``stream`` with is_new; the state grows with the distinct items of a key, spread over tasks by key, on RocksDB."""
    fields = {f.name: f for f in stream.schema.fields}
    out = StructType([*(fields[c] for c in columns), StructField("is_new", BooleanType())])
    return stream.groupBy(key).transformWithStateInPandas(statefulProcessor=FirstSight(item, columns, ttl_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")


def distinct_within(stream: DataFrame, keys: list[str], time: str, lateness: str = "180 days") -> DataFrame:
    """New items only, state bounded by the watermark: later repeats of an item pass again."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def punctual(items: DataFrame, as_of: Column, days: int, ahead: int = 2, date: str = "date") -> DataFrame:
    """Rows dated within the last ``days`` and not more than ``ahead`` days in the future; undated rows go."""
    return items.where(F.col(date).between(F.date_sub(as_of, days), F.date_add(as_of, ahead)))


def latest_state(stream: DataFrame, key: list[str]) -> DataFrame:
    """The newest status of each key, as a running aggregate (update mode)."""
    return stream.groupBy(*key).agg(F.max_by("status", "ts").alias("status"), F.max("ts").alias("updated_at"))


def upsert_sink(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], key: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges complete updates into a registry; a batch run again leaves the same registry."""
    from ..operators.registry import upsert

    def sink(batch: DataFrame, _: int) -> None:
        newest = batch.groupBy(*key).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in key]), "updated_at").alias("_r")).select(*key, "_r.*").select(*batch.columns)
        write(upsert(read(), newest, key))

    return sink


def tumbling(stream: DataFrame, time: str, size: str, lateness: str, keys: list[str]) -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.window(time, size), *keys).agg(F.count("*").alias("n"))


def sliding(stream: DataFrame, time: str, size: str, step: str, lateness: str, keys: list[str]) -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.window(time, size, step), *keys).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, time: str, gap: str, lateness: str, keys: list[str]) -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def run_available(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there and stop; a later call goes on from the checkpoint."""
    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
