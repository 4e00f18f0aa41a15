"""A Spark stream of the frame names in a folder, in their order; it admits a stated number of names a batch.

An offset is the last name that was given. A batch's names are those after its start up to its end, so a batch that is replayed
gives the same names, and names are dealt to tasks by small lists. The source looks ahead at most ``AHEAD`` names at a time,
so what it holds does not grow with the folder.
"""

from __future__ import annotations

import bisect
import fnmatch
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from framegrid.sources.sinks import filesystem

PATTERN = "frame_*.jpg"
AHEAD = 1 << 16


@dataclass
class Names(InputPartition):
    names: list[str]


def names(folder: str, pattern: str = PATTERN) -> Iterator[str]:
    """The folder's file names that fit, in no order."""
    from pyarrow import fs

    at, inside = filesystem(folder)
    for found in at.get_file_info(fs.FileSelector(inside, allow_not_found=True)):
        if found.is_file and fnmatch.fnmatchcase(found.base_name, pattern):
            yield found.base_name


class FrameNames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame_names"

    def schema(self) -> str:
        return "document string, file string"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return FrameNamesReader(self.options)


class FrameNamesReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.folder, self.document = options["path"], options.get("document", "")
        self.per_batch, self.per_task = int(options.get("files_per_batch", 256)), int(options.get("files_per_task", 16))
        self.reached = ""
        self.ahead: list[str] = []

    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        """The end of the next batch: ``files_per_batch`` names after the one reached."""
        coming = self._after(self.reached, self.per_batch)
        return {"after": coming[-1] if coming else self.reached}

    def partitions(self, start: dict, end: dict) -> list[Names]:
        wanted = [n for n in self._after(start["after"], self.per_batch) if n <= end["after"]]
        if len(wanted) == self.per_batch and wanted[-1] < end["after"]:  # a batch that was planned with other options
            wanted = sorted(n for n in names(self.folder) if start["after"] < n <= end["after"])
        self.reached = max(self.reached, end["after"])
        return [Names(wanted[i : i + self.per_task]) for i in range(0, len(wanted), self.per_task)]

    def read(self, partition: Names | None) -> Iterator[tuple]:
        for name in partition.names if partition else ():
            yield self.document, name

    def _after(self, name: str, n: int) -> list[str]:
        at = bisect.bisect_right(self.ahead, name)
        if len(self.ahead) - at < n or (self.ahead and name < self.ahead[0]):
            self.ahead = heapq.nsmallest(max(AHEAD, n), (x for x in names(self.folder) if x > name))
            at = 0
        return self.ahead[at : at + n]


def stream(spark: SparkSession, folder: str, document: str, files_per_batch: int = 256, files_per_task: int = 16):
    """Rows of (document, file) as a stream."""
    spark.dataSource.register(FrameNames)
    read = spark.readStream.format("frame_names").option("document", document)
    return read.option("files_per_batch", files_per_batch).option("files_per_task", files_per_task).load(folder)
