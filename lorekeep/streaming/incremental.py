"""Incremental runs: what is new, what is done, and counts over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(docs: DataFrame, done: DataFrame, key: str = "doc_name", force: bool = False) -> DataFrame:
    """Documents without an output yet; all of them if forced."""
    return docs if force else docs.join(done.select(key).distinct(), key, "left_anti")


def with_cached(new: DataFrame, cached: DataFrame, key: str = "doc_name") -> DataFrame:
    """New results, and those of an earlier run for other documents."""
    return new.unionByName(cached.join(new.select(key).distinct(), key, "left_anti"))


def new_files(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """A stream of (path, content) of markdown files as they arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.md").option("maxFilesPerTrigger", per_trigger).load(path).select("path", F.decode("content", "UTF-8").alias("text"))


def appended(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Run a batch operator on a stream, each micro-batch written once: the batch number is part of the path."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, event_type, n, total) over event time; works on streams and tables."""
    # Watermarks need instants; local times are taken as UTC, and windows are given back as local times.
    counted = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")
