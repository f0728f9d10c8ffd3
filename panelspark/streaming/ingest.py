"""Landing, upsert, dedupe and bars as streams.

Jobs run with ``availableNow``: they take what is new since the last run and
stop. The checkpoint folder is the high-water mark. State is bounded by the
watermark delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelspark.sources.sinks import upsert


def file_stream(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def land_increment(stream: DataFrame, target: str, checkpoint: str, *, partition: Sequence[str] = ()) -> StreamingQuery:
    """Append new rows; every input row arrives exactly once over any number of runs."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(*partition)
    return writer.start(target)


def upsert_increment(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], partition: Sequence[str]) -> StreamingQuery:
    """Revisions replace stored rows with the same key; a repeated batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, target, keys, partition)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drop_repeats(stream: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Exact repeats inside the delay are dropped; the state of older keys is released."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def event_time_bars(stream: DataFrame, time: str, entity: str, value: str, width: str, delay: str) -> DataFrame:
    """Open, high, low, close, sum and count per entity and time window; works on batches too."""
    key = F.struct(F.col(time), F.col(value))
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("_w"), entity)
        .agg(
            F.min_by(value, key).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, key).alias("close"),
            F.sum(value).alias("total"),
            F.count("*").alias("n"),
        )
        .select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), entity, "open", "high", "low", "close", "total", "n")
    )
