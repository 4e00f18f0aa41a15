"""Archives of what was not found or not mapped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegrid.config import Table


def empty_frames(recorded: DataFrame) -> DataFrame:
    """Frames recorded as empty, with the time of their first record."""
    return recorded.where(F.col("status") == "empty").groupBy("document", "file").agg(F.min_by("time_s", "ord").alias("time_s"), F.count("*").alias("count"))


def unmapped(placed: DataFrame, table: Table = Table()) -> DataFrame:
    """Unmapped events by file and cell; the time is the first one of the file."""
    counted = placed.where(F.col("event") == table.unmapped).groupBy("document", "file", "row", "col").agg(
        F.count("*").alias("count"), F.min(F.struct("time_s", "ord")).alias("first")
    )
    first = F.min("first").over(Window.partitionBy("document", "file"))
    return counted.select("document", "file", first["time_s"].alias("time_s"), "row", "col", "count")


def on_disk(archive: DataFrame, listing: DataFrame) -> DataFrame:
    """The archive's files that are still listed, once each."""
    return archive.select("document", "file").distinct().join(listing, ["document", "file"], "left_semi")
