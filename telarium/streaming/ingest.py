"""Streams of our own beside the batch operators: ingest without repeats, late rows, and an audit of each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_repeats(stream: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """Rows of a stream, each key once within the watermark; state is dropped behind it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, key: str, size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts by tumbling window and key; rows later than the watermark are left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def audited(stream: DataFrame, audit: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Writes the audit of every batch below path, named by the batch, so a batch that runs again replaces its own."""

    def each(batch: DataFrame, n: int) -> None:
        audit(batch).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
