"""Train what the stages load: a ring detector from labelled crops, or a box forest from labelled frames of a recording.

    python -m framegrid.plans.train ring FRAMES POSITIONS MODEL
    python -m framegrid.plans.train box RECORDING BOXES MODEL

POSITIONS is a position file (file, time_s, status, px, py): ``found`` rows are centres, ``empty`` rows frames without one. BOXES is a CSV
with frame_index, l, t, r, b as fractions.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from framegrid.operators import crops, forest, locate, ring_model, roi_model
from framegrid.sources import files
from framegrid.sources import video as video_source


def ring(spark: SparkSession, frames: str, positions: str, model: str, growth: forest.Growth = ring_model.GROWTH, rounds: int = 3) -> dict:
    labels = locate.typed_positions(files.positions(spark, positions, "")).where("status in ('found', 'empty')")
    templates, fitted, mined = ring_model.train(labels, frames, growth, rounds)
    ring_model.save(templates, fitted, model)
    return {"templates": len(templates), "nodes": len(fitted.feature), "mined": mined}


def box(spark: SparkSession, recording: str, boxes: str, model: str, growth: forest.Growth = forest.Growth(), decoder: str = "framegrid.sources.video:recording") -> dict:
    """Only the labelled frames are decoded: their indices reach the source."""
    labels = spark.read.option("header", True).schema("frame_index bigint, l double, t double, r double, b double").csv(boxes)
    wanted = [r.frame_index for r in labels.select("frame_index").distinct().collect()]  # labelled by hand, so few
    video_source.register(spark)
    read = spark.read.format("video_frames").option("decoder", decoder).option("start_s", 0).option("interval_s", 1e-9)
    frames = read.load(recording).where(f"frame_index in ({', '.join(map(str, wanted))})") if wanted else read.load(recording).limit(0)
    fitted = roi_model.train(crops.with_features(frames).select("frame_index", "features").join(labels, "frame_index"), growth)
    forest.save(fitted, model)
    return {"trees": len(fitted.roots), "nodes": len(fitted.feature)}


def main() -> None:
    args = argparse.ArgumentParser(description="Train a ring detector or a box forest.")
    args.add_argument("what", choices=["ring", "box"])
    args.add_argument("source", help="folder of crops, or a recording")
    args.add_argument("labels")
    args.add_argument("model", help="the file to write")
    args.add_argument("--trees", type=int)
    args.add_argument("--depth", type=int)
    args.add_argument("--seed", type=int, default=0)
    a = args.parse_args()
    spark = SparkSession.builder.appName("framegrid training").getOrCreate()
    base = ring_model.GROWTH if a.what == "ring" else forest.Growth()
    growth = forest.Growth(a.trees or base.trees, a.depth or base.depth, base.bins, base.least_rows, base.feature_share, a.seed)
    made = (ring if a.what == "ring" else box)(spark, a.source, a.labels, a.model, growth)
    for name, value in made.items():
        print(name, value)


if __name__ == "__main__":
    main()
