"""Stage 2: detection through a plug-in, resume, and the state of a run."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.functions import exprs as E
from framegrid.sources.sinks import filesystem

#: image (height x width x 3, blue first) to (px, py) or None
Detector = Callable[[np.ndarray], tuple[int, int] | None]


def todo(frames: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Frames not recorded yet, the first ``limit`` by name; the limit comes before any detection."""
    left = frames.join(done.select("document", "file"), ["document", "file"], "left_anti")
    return left if limit is None else left.orderBy("document", "file").limit(limit)


def _detect(parts: Iterator[pd.DataFrame], make: Callable[[], Detector]) -> Iterator[pd.DataFrame]:
    detector = make()
    for part in parts:
        rows = []
        for document, file, image in zip(part["document"], part["file"], part["image"], strict=True):
            readable = image is not None and image["width"] > 0
            found = None
            if readable:
                pixels = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])
                found = detector(pixels)
            rows.append((document, file, bool(readable), *(found or (None, None))))
        yield pd.DataFrame(rows, columns=["document", "file", "readable", "px", "py"]).astype({"px": "Int32", "py": "Int32"})


def detect(images: DataFrame, make: Callable[[], Detector]) -> DataFrame:
    """Rows of (document, file, image) to positions; ``make`` is called once in each task."""
    found = images.select("document", "file", "image").mapInPandas(
        partial(_detect, make=make), "document string, file string, readable boolean, px int, py int"
    )
    return positions(found)


def _detect_files(parts: Iterator[pd.DataFrame], folder: str, make: Callable[[], Detector], read, counter) -> Iterator[pd.DataFrame]:
    detector = make()
    for part in parts:
        rows = []
        for document, file in zip(part["document"], part["file"], strict=True):
            at, inside = filesystem(f"{folder}/{file}")
            with at.open_input_stream(inside) as f:
                pixels = read(f.read())
            found = None if pixels is None else detector(pixels)
            rows.append((document, file, pixels is not None, *(found or (None, None))))
            if counter is not None:
                counter.add(1)
        yield pd.DataFrame(rows, columns=["document", "file", "readable", "px", "py"]).astype({"px": "Int32", "py": "Int32"})


def detect_files(names: DataFrame, folder: str, make: Callable[[], Detector], read: Callable[[bytes], np.ndarray | None], counter=None) -> DataFrame:
    """Rows of (document, file) to positions: a task reads, decodes and detects its own files, so only names are ever dealt out."""
    found = names.select("document", "file").mapInPandas(
        partial(_detect_files, folder=folder, make=make, read=read, counter=counter), "document string, file string, readable boolean, px int, py int"
    )
    return positions(found)


def positions(found: DataFrame) -> DataFrame:
    """Name the state and parse the time of each detection."""
    return found.select(
        "document", "file", E.parse_time(F.col("file")).alias("time_s"),
        E.detect_status(F.col("readable"), F.col("px")).alias("status"), "px", "py",
    )


def summary(recorded: DataFrame, frames: DataFrame) -> DataFrame:
    """found, empty, their total, and frames less distinct recorded ones (negative if frames have gone)."""
    one = recorded.groupBy("document").agg(
        F.count_if(F.col("status") == "found").alias("found"), F.count_if(F.col("status") == "empty").alias("empty"),
        F.count_distinct("file").alias("done"),
    )
    listed = frames.groupBy("document").agg(F.count("*").alias("frames"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return listed.join(one, "document", "full").select(
        "document", none("found"), none("empty"), (none("found") + none("empty")).alias("total"),
        (none("frames") - none("done")).alias("remaining"),
    )


def best_candidate(candidates: DataFrame, least: float = 1.05) -> DataFrame:
    """The candidate with the highest fused score of each frame, if it reaches ``least``."""
    scored = candidates.withColumn("score", E.fused_score(F.col("ncc"), F.col("probability"), F.col("coverage")))
    best = scored.where(F.col("score") >= least).groupBy("frame").agg(F.max_by("candidate", F.struct("score", -F.col("candidate"))).alias("candidate"), F.max("score").alias("score"))
    return best
