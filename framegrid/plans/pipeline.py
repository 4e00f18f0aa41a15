"""The three stages as one run over a document, and its command line.

    python -m framegrid.plans.pipeline --document NAME --apply-root FOLDER --symbols FILE --forest FILE --model FILE
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.config import Grid, Sampling, Table
from framegrid.functions import exprs as E
from framegrid.functions import jpeg
from framegrid.operators import archive, crops, detect, fill, locate, ring_model, roi_model, sampling
from framegrid.operators.progress import Live
from framegrid.plans import stage2
from framegrid.schemas import EXTRACTION_LOG_HEADER, GRID_RESULT_HEADER
from framegrid.sources import files, sheets, sinks
from framegrid.sources import video as video_source


@dataclass
class Conf:
    apply_root: str
    symbols: str
    template: str | None = None
    decoder: str = "framegrid.sources.video:recording"
    predictor: Callable[[], crops.Predictor] | None = None
    forest: str | None = None  # a box forest that roi_model stored, in place of a predictor
    detector: Callable[[], detect.Detector] | None = None
    model: str | None = None  # a ring detector that ring_model stored, in place of a detector
    encoder: Callable[[np.ndarray], bytes] = jpeg.jpeg
    say: Callable[[str], None] | None = None  # is given lines of progress
    limit: int | None = None
    workers: int | None = None
    sampling: Sampling = field(default_factory=Sampling)
    grid: Grid = field(default_factory=Grid)
    table: Table = field(default_factory=Table)


def extract(spark: SparkSession, video: str, document: str, conf: Conf, store: str) -> DataFrame:
    """Sampled frames of a recording with log columns and crops.

    Whole frames stay in the task that decodes them: boxes are predicted and crops cut there and stored once; numbering and
    the size check run on narrow columns, and the crops are joined to them.
    """
    if conf.predictor is None and conf.forest is None:
        raise ValueError("stage 1 needs a box predictor or a box forest")
    video_source.register(spark)
    read = spark.read.format("video_frames").option("decoder", conf.decoder)
    for name in ("start_s", "end_s", "interval_s", "default_fps"):
        if (value := getattr(conf.sampling, name)) is not None:
            read = read.option(name, value)
    frames = read.load(video).withColumn("document", F.lit(document))
    boxed = crops.predict_boxes(frames, conf.predictor or roi_model.ship(spark, conf.forest))
    with Live(spark, every=50, say=conf.say or (lambda line: None)) as live:
        crops.crop(sampling.with_boxes(boxed), conf.sampling.target_size, live.counter).write.mode("overwrite").parquet(store)
    stored = spark.read.parquet(store)
    narrow = stored.select("document", "frame_index", "w", "h", (F.col("frame_index") / E.fps(F.col("fps"), conf.sampling)).alias("timestamp"))
    numbered = sampling.number_frames(sampling.check_sizes(narrow, conf.sampling))
    return numbered.join(stored.select("document", "frame_index", "height", "width", "data"), ["document", "frame_index"])


def locate_and_fill(spark: SparkSession, positions: DataFrame, out: str, conf: Conf, frames: str | None = None) -> dict:
    """Stage 3 over (document, ord, file, time_s, status, px, py): grid results, the filled table and the archive, with screenshots from ``frames``."""
    labelled = locate.events(positions, files.symbols(spark, conf.symbols), conf.grid, conf.table)
    columns, rows = sheets.axes(conf.template) if conf.template else (conf.table.columns, conf.table.rows)
    table = Table(conf.table.start_s, conf.table.cell_s, conf.table.rows, columns, conf.table.empty, conf.table.unmapped, conf.table.separator)
    placed = locate.placed(labelled, table).where(F.col("row_idx") < rows)
    sinks.csv(labelled.orderBy("time_s", "ord").select("file", "time_s", "row", "col", "status", "px", "py", "symbol"), f"{out}/hero_grid_result", GRID_RESULT_HEADER)
    cells = fill.cell_strings(placed, table)
    filled = [(r.col_idx, r.row_idx, r.cell) for r in cells.collect()]  # one document: at most columns * rows cells
    headers = [r.header for r in fill.time_axis(spark, table).where("row_idx = 0").orderBy("col_idx").collect()]
    sheets.fill(conf.template, f"{out}/filled.xlsx", filled, (headers, [str(i + 1) for i in range(rows)]))
    unmapped = archive.unmapped(placed, table)
    copied = sinks.rebuild(
        f"{out}/{table.unmapped}",
        lambda to: (sinks.csv(unmapped.drop("document").orderBy("file", "row", "col"), to), sinks.copy_files(unmapped, frames, to) if frames else 0)[1],
    )
    return {"copied": copied, "table_path": f"{out}/filled.xlsx", "un_count": placed.where(F.col("event") == table.unmapped).count(), "filled_cells": len(filled)}


def run(spark: SparkSession, document: str, conf: Conf) -> dict:
    """Stages 1 to 3; between them only what the contract stores. Frames that are recorded are not detected again."""
    if conf.detector is None and conf.model is None:
        raise ValueError("stage 2 needs a detector or a stored ring detector")
    home, began = f"{conf.apply_root}/{document}", time.time()
    frames = f"{home}/subproject1"
    sampled = extract(spark, files.one_video(spark, home), document, conf, f"{frames}/_crops")
    t = F.col("timestamp")
    log = sampled.orderBy("seq").select(
        "seq", E.mmss(t).alias("mmss"), E.tenths(t).alias("time_s"), F.when(F.col("anomaly"), "").otherwise(E.frame_name(F.col("seq"), t)).alias("file"),
        E.size_label(F.col("w"), F.col("h")).alias("size"), E.frame_status(F.col("anomaly")).alias("status"),
    )
    sinks.csv(log, f"{frames}/extraction_log", EXTRACTION_LOG_HEADER)
    sinks.save_images(sampled.where(~F.col("anomaly")).withColumn("file", E.frame_name(F.col("seq"), t)), frames, conf.encoder)
    counts = sampled.agg(F.count("*").alias("total"), F.count_if("anomaly").alias("anomaly")).first()
    first = {"total": counts.total, "anomaly": counts.anomaly, "normal": counts.total - counts.anomaly, "seconds": time.time() - began}
    make = conf.detector or ring_model.ship(spark, conf.model)
    second = stage2.detect_frames(spark, frames, f"{home}/subproject2", make, document, conf.limit, conf.workers, conf.table, say=conf.say)
    at = time.time()
    third = locate_and_fill(spark, stage2.recorded(spark, f"{home}/subproject2"), f"{home}/subproject3", conf, frames)
    return {"stage1": first, "stage2": second, "stage3": third | {"seconds": time.time() - at}, "seconds": time.time() - began}


def main() -> None:
    args = argparse.ArgumentParser(description="Run the three stages over one document.")
    args.add_argument("--document", required=True)
    args.add_argument("--apply-root", required=True)
    args.add_argument("--symbols", required=True)
    args.add_argument("--template")
    args.add_argument("--decoder", default=Conf.decoder)
    boxes = args.add_mutually_exclusive_group(required=True)
    boxes.add_argument("--forest", help="a stored box forest")
    boxes.add_argument("--predictor", help="module:factory of another box predictor")
    rings = args.add_mutually_exclusive_group(required=True)
    rings.add_argument("--model", help="a stored ring detector")
    rings.add_argument("--detector", help="module:factory of another detector")
    args.add_argument("--encoder", default="framegrid.functions.jpeg:jpeg", help="module:function that encodes a crop")
    args.add_argument("--limit", type=int, help="most frames to detect in this run")
    args.add_argument("--workers", type=int, help="tasks that detect")
    args.add_argument("--start", type=float, default=Sampling.start_s)
    args.add_argument("--end", type=float)
    args.add_argument("--interval", type=float, default=Sampling.interval_s)
    a = args.parse_args()
    conf = Conf(
        a.apply_root, a.symbols, a.template, a.decoder, stage2.named(a.predictor) if a.predictor else None, a.forest,
        stage2.named(a.detector) if a.detector else None, a.model, stage2.named(a.encoder), print, a.limit, a.workers,
        Sampling(start_s=a.start, end_s=a.end, interval_s=a.interval),
    )
    spark = SparkSession.builder.appName("framegrid").getOrCreate()
    for stage, result in run(spark, a.document, conf).items():
        print(stage, result)


if __name__ == "__main__":
    main()
