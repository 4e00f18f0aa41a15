"""Tumbling windows, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, seconds: int = 15, origin_s: int = 40, late: str = "1 minute") -> DataFrame:
    """Events of each document in windows aligned to ``origin_s``; a stream drops what is later than ``late``."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    bucket = F.window("ts", f"{seconds} seconds", startTime=f"{origin_s % seconds} seconds")
    counted = events.groupBy(F.col("user_id").alias("document"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return counted.select("document", F.col("bucket.start").alias("start"), F.col("bucket.end").alias("end"), "n")
