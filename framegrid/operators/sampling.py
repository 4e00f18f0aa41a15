"""Stage 1: systematic frame sampling, boxes, size check and the extraction log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegrid.config import Sampling
from framegrid.functions import exprs as E


def sample_frames(frames: DataFrame, conf: Sampling = Sampling()) -> DataFrame:
    """Rows of (document, frame_index, fps, duration_s, ...) that fall on the sampling grid, with their timestamp."""
    rated = frames.withColumn("fps", E.fps(F.col("fps"), conf))
    kept = rated.where(E.is_sampled(F.col("frame_index"), F.col("fps"), F.col("duration_s"), conf))
    return kept.withColumn("timestamp", F.col("frame_index") / F.col("fps"))


def number_frames(sampled: DataFrame) -> DataFrame:
    """0-based sequence numbers in frame order; skipped frames count too."""
    order = Window.partitionBy("document").orderBy("frame_index")
    return sampled.withColumn("seq", F.row_number().over(order) - 1)


def with_boxes(sampled: DataFrame) -> DataFrame:
    """Predicted fractions l, t, r, b of a width x height frame to a box and its size."""
    box = E.roi_box(*(F.col(c) for c in ("l", "t", "r", "b", "width", "height")))
    return sampled.withColumn("box", box).withColumns({"w": F.expr("box.r - box.l"), "h": F.expr("box.b - box.t")})


def check_sizes(boxed: DataFrame, conf: Sampling = Sampling()) -> DataFrame:
    """Compare each frame with its document's first sampled frame, found by one partial aggregate."""
    first = boxed.groupBy("document").agg(F.min_by(F.struct("w", "h", "frame_index"), "frame_index").alias("first"))
    odd = E.is_anomaly(F.col("w"), F.col("h"), F.col("first.w"), F.col("first.h"), conf)
    later = F.col("frame_index") > F.col("first.frame_index")
    return boxed.join(first, "document").withColumn("anomaly", later & odd).drop("first")


def extraction_log(frames: DataFrame, conf: Sampling = Sampling()) -> DataFrame:
    checked = number_frames(check_sizes(with_boxes(sample_frames(frames, conf)), conf))
    t = F.col("timestamp")
    return checked.select(
        "document", "seq", E.mmss(t).alias("mmss"), E.tenths(t).cast("double").alias("time_s"),
        F.when(F.col("anomaly"), "").otherwise(E.frame_name(F.col("seq"), t)).alias("file"),
        E.size_label(F.col("w"), F.col("h")).alias("size"), E.frame_status(F.col("anomaly")).alias("status"),
    )


def summary(frames: DataFrame, conf: Sampling = Sampling()) -> DataFrame:
    checked = check_sizes(with_boxes(sample_frames(frames, conf)), conf)
    return checked.groupBy("document").agg(
        F.count("*").alias("total"), F.count_if(~F.col("anomaly")).alias("normal"), F.count_if("anomaly").alias("anomaly"),
        F.first("duration_s").alias("duration_s"), F.first(E.expected_frames(F.col("duration_s"), conf)).alias("expected"),
    )
