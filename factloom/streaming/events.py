"""Windows over event streams: the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timed(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """events with ts as a timestamp, and a watermark on streams."""
    out = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return out.withWatermark("ts", late) if events.isStreaming else out


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    by = timed(events).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return by.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    by = timed(events).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return by.select("user_id", F.col("session_window.start").alias("start"), "n")
