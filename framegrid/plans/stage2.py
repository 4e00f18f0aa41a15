"""Stage 2 over a folder of frames: detect what is not recorded yet, record it batch by batch, rebuild the archive; and its command line.

    python -m framegrid.plans.stage2 FRAMES OUTPUT --model FILE [--limit N] [--workers N]

``--model`` is what ``framegrid.plans.train`` stores; ``--detector module:factory`` names any other detector.
"""

from __future__ import annotations

import argparse
import importlib
import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import SparkSession

from framegrid.config import Table
from framegrid.functions import images
from framegrid.operators import archive, detect, locate, ring_model
from framegrid.operators.progress import Live
from framegrid.sources import files, sinks
from framegrid.sources import frames as names_source
from framegrid.streaming import resume

recorded = resume.recorded


def import_positions(spark: SparkSession, output: str, document: str) -> int:
    """Take over a position file that an earlier run left, where nothing is recorded; how many rows."""
    if resume.recorded(spark, output).limit(1).count():
        return 0
    at, inside = sinks.filesystem(f"{output}/hero_position.csv")
    if not at.get_file_info(inside).is_file:
        return 0
    rows = locate.typed_positions(files.positions(spark, f"{output}/hero_position.csv", document))
    return resume.commit(rows, output, resume.next_run(output), 0)


def detect_frames(
    spark: SparkSession, frames: str, output: str, make: Callable[[], detect.Detector], document: str = "", limit: int | None = None,
    workers: int | None = None, table: Table = Table(), files_per_batch: int = 256, read: Callable[[bytes], np.ndarray | None] = images.read,
    say: Callable[[str], None] | None = None,
) -> dict:
    """Detect at most ``limit`` frames not recorded yet, in ``workers`` tasks; each batch is recorded once, when it is done.

    Frames are listed, dealt out and limited by their names in Spark; a position file in the output folder counts as recorded.
    ``say`` is given a line for every 20 frames while tasks run.
    """
    began = time.time()
    if next(names_source.names(frames), None) is None:
        raise FileNotFoundError(f"no frames (frame_*.jpg) in {frames}")
    import_positions(spark, output, document)
    with Live(spark, say=say or (lambda line: None)) as live:
        new = resume.run(spark, frames, output, make, document, limit, workers, files_per_batch, read, live.counter)
        seconds = time.time() - live.began
    every = resume.recorded(spark, output)
    sinks.csv(every.orderBy("ord", "file").select("file", "time_s", "status", "px", "py"), f"{output}/hero_position")
    empty = archive.empty_frames(every)
    listing = files.frame_listing(spark, frames, document)
    copied = sinks.rebuild(
        f"{output}/{table.empty}", lambda to: (sinks.csv(empty.drop("document").orderBy("file"), to), sinks.copy_files(archive.on_disk(empty, listing), frames, to))[1]
    )
    state = detect.summary(every, listing).first()
    return {
        "found": state.found, "empty": state.empty, "total": state.total, "remaining": state.remaining, "new": new, "copied": copied,
        "seconds": time.time() - began, "frames_a_second": new / max(seconds, 1e-9),
    }


def named(plugin: str) -> Callable:
    """The object that ``module:name`` names."""
    module, _, name = plugin.partition(":")
    return getattr(importlib.import_module(module), name)


def main() -> None:
    args = argparse.ArgumentParser(description="Detect positions in a folder of frames; what is recorded is not detected again.")
    args.add_argument("frames")
    args.add_argument("output")
    args.add_argument("--document", default="")
    args.add_argument("--limit", type=int)
    args.add_argument("--workers", type=int)
    which = args.add_mutually_exclusive_group(required=True)
    which.add_argument("--model", help="a stored ring detector")
    which.add_argument("--detector", help="module:factory of another detector")
    a = args.parse_args()
    spark = SparkSession.builder.appName("framegrid stage 2").getOrCreate()
    make = ring_model.ship(spark, a.model) if a.model else named(a.detector)
    for name, value in detect_frames(spark, a.frames, a.output, make, a.document, a.limit, a.workers, say=print).items():
        print(name, value)


if __name__ == "__main__":
    main()
