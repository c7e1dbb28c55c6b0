"""Streams of items: duplicates dropped as they arrive, and running counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(stream: DataFrame, key: str = "fingerprint", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of each key; state of a key goes once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, by: str, time: str = "ts", window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows by event-time window and a column."""
    counts = stream.withWatermark(time, delay).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), by, "n")
