"""Detection as a stream of frame names whose batches are committed one by one; what is committed is never detected again.

Names come from the ``frame_names`` source, which admits a batch at a time. Of each batch the names that are not recorded yet, up to
the limit, are read, decoded and detected in tasks, and written to a folder of the run and the batch. The folder counts once its
last file, Spark's ``_SUCCESS``, is there: a batch that a crash cut off is no batch, and a batch that is given again after it was
committed is left alone. A new run takes the names from the start and drops what any run has recorded.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

import numpy as np
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.functions import exprs as E
from framegrid.functions import images
from framegrid.operators import archive, detect
from framegrid.sources import frames as names_source
from framegrid.sources.sinks import filesystem

RECORDED = "document string, file string, time_s double, status string, px int, py int"


def _folders(output: str) -> list[str]:
    """Folders of batches, committed or not; one for each batch of frames."""
    from pyarrow import fs

    at, inside = filesystem(f"{output}/recorded")
    found = at.get_file_info(fs.FileSelector(inside, recursive=True, allow_not_found=True))
    return sorted({f.path.rpartition("/")[0] for f in found if f.is_file})


def _committed(output: str, folders: list[str] | None = None) -> list[str]:
    at, _ = filesystem(f"{output}/recorded")
    return [f for f in (_folders(output) if folders is None else folders) if at.get_file_info(f"{f}/_SUCCESS").is_file]


def _address(output: str, inside: str) -> str:
    """The address of a path inside the file system of ``output``."""
    return output + inside[len(filesystem(output)[1]) :]


def recorded(spark: SparkSession, output: str) -> DataFrame:
    """All that committed batches hold, with the frames' numbers as ``ord``."""
    paths = [_address(output, f) for f in _committed(output)]
    found = spark.read.schema(RECORDED).parquet(*paths) if paths else spark.createDataFrame([], RECORDED)
    return found.withColumn("ord", E.frame_number(F.col("file")))


def commit(rows: DataFrame, output: str, run: int, batch: int) -> int:
    """Record a batch once: rows that are written, or 0 where the batch was committed before."""
    folder = f"{output}/recorded/run={run:06d}/batch={batch:06d}"
    at, inside = filesystem(f"{folder}/_SUCCESS")
    if at.get_file_info(inside).is_file:
        return 0
    rows.select("document", "file", "time_s", "status", "px", "py").write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
    return rows.sparkSession.read.schema(RECORDED).parquet(folder).count()


def next_run(output: str) -> int:
    """The number of a new run; folders of batches that were cut off are deleted."""
    folders = _folders(output)
    at, _ = filesystem(f"{output}/recorded")
    for f in set(folders) - set(_committed(output, folders)):
        at.delete_dir(f)
    runs = [int(part.removeprefix("run=")) for f in folders for part in f.split("/") if part.startswith("run=")]
    return max(runs, default=-1) + 1


def run(
    spark: SparkSession, frames: str, output: str, make: Callable[[], detect.Detector], document: str = "", limit: int | None = None, workers: int | None = None,
    files_per_batch: int = 256, read: Callable[[bytes], np.ndarray | None] = images.read, counter: Accumulator | None = None,
) -> int:
    """Detect at most ``limit`` frames that are not recorded, in the order of their names; how many were recorded now.

    ``workers`` tasks share a batch; an error of the detector ends the run, what was committed before stays.
    """
    number = next_run(output)
    new, enough = 0, threading.Event()

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal new
        if enough.is_set():
            return
        left = detect.todo(batch, recorded(batch.sparkSession, output), None if limit is None else limit - new)
        if workers:
            left = left.repartition(workers)
        new += commit(detect.detect_files(left, frames, make, read, counter), output, number, batch_id)
        if limit is not None and new >= limit:
            enough.set()

    if limit is not None and limit <= 0:
        return 0
    per_task = -(-files_per_batch // workers) if workers else 16
    source = names_source.stream(spark, frames, document, files_per_batch, per_task)
    query = source.writeStream.foreachBatch(take).option("checkpointLocation", f"{output}/_stream/run={number:06d}").start()
    failed: list[BaseException] = []

    def wait() -> None:
        try:
            query.processAllAvailable()
        except BaseException as e:  # noqa: BLE001 - given to the caller below
            failed.append(e)

    waiting = threading.Thread(target=wait, daemon=True)
    waiting.start()
    while waiting.is_alive() and not enough.is_set():
        waiting.join(0.05)
    query.stop()
    waiting.join()
    if query.exception() is not None:
        raise query.exception()
    if failed and not enough.is_set():
        raise failed[0]
    return new


def rebuild_archive(spark: SparkSession, output: str) -> DataFrame:
    """The archive of empty frames from all that is recorded, in order of frames."""
    return archive.empty_frames(recorded(spark, output))
