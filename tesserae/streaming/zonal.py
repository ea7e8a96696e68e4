"""Bounded streams: label statistics kept up to date as pixel files arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import zonal
from ..operators.graph import stored


def zonal_stream(pixels: DataFrame, folder: str, keys: list[str], channels: list[str]) -> DataFrame:
    """Statistics of a streaming frame of pixels, after all that is available has been read.

    Each micro-batch is summed and appended to a table under `folder`; the sums of sums are the
    result, so a batch may be of any size and late files just add to their labels.
    """
    spark = pixels.sparkSession
    run = uuid.uuid4().hex
    parts, state = f"{folder.rstrip('/')}/zonal-{run}", f"{folder.rstrip('/')}/state-{run}"

    def add(batch: DataFrame, number: int) -> None:
        zonal(batch, keys, channels).write.mode("overwrite").parquet(f"{parts}/batch={number}")

    pixels.writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(parts)
    sums = [F.sum(c).alias(c) for c in ("area", "sum_x", "sum_y", *(f"{c}_sum" for c in channels))]
    sums += [F.min(c).alias(c) for c in ("x0", "y0")] + [F.max(c).alias(c) for c in ("x1", "y1", *(f"{c}_max" for c in channels))]
    return found.groupBy(*keys, "label").agg(*sums)


def event_counts(events: DataFrame, window: str, delay: str) -> DataFrame:
    """Counts and sums by tumbling window and type, for events at most `delay` late."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.rint(F.col("value") * 100).cast("long")).alias("cents"))


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A table's files as a stream; `path` ends in .parquet and is a file or a folder."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path.removesuffix("t") + "[t]")


def counted(spark: SparkSession, path: str, window: str, delay: str, folder: str) -> DataFrame:
    """`event_counts` over a stream of Parquet files, as a table, when all that is available has been read."""
    run = uuid.uuid4().hex
    out, state = f"{folder.rstrip('/')}/counts-{run}", f"{folder.rstrip('/')}/state-{run}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    found = event_counts(stream_of(spark, path), window, delay)
    found.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "cents")


def folder_of(spark: SparkSession) -> str:
    """The shared folder for stream state."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        stored(spark.range(1))
    return spark.conf.get("spark.checkpoint.dir")
