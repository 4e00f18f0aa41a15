"""Counts and throughput of a running job, taken while it runs."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Progress:
    """Observe rows by state; ``rates`` is there once an action on the frame has ended."""

    def __init__(self) -> None:
        self.seen, self.began = Observation(), time.time()

    def watch(self, df: DataFrame, status: str = "status", states: tuple[str, ...] = ("found", "empty", "unreadable")) -> DataFrame:
        counts = [F.count_if(F.col(status) == s).alias(s) for s in states]
        return df.observe(self.seen, F.count("*").alias("rows"), *counts)

    def rates(self) -> dict:
        seconds = time.time() - self.began
        found = self.seen.get
        return found | {"seconds": seconds, "minutes": seconds / 60, "rows_a_second": found["rows"] / max(seconds, 1e-9)}


class Live:
    """A line for every ``every`` rows that ended tasks have counted, while the job still runs.

    Tasks call ``add`` through ``counter``; a thread of the driver looks at the sum. A task that is run twice counts twice, so the
    figures are for people to look at; results come from the stored rows.
    """

    def __init__(self, spark: SparkSession, every: int = 20, say: Callable[[str], None] = print, wait: float = 0.1) -> None:
        self.counter = spark.sparkContext.accumulator(0)
        self.every, self.say, self.wait = every, say, wait
        self.said, self.began, self._end = 0, time.time(), threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def _line(self, n: int) -> None:
        seconds = max(time.time() - self.began, 1e-9)
        self.said = n
        self.say(f"{n} rows, {n / seconds:.1f} a second, {seconds / 60:.1f} min")

    def _run(self) -> None:
        while not self._end.wait(self.wait):
            n = self.counter.value
            if n // self.every > self.said // self.every:
                self._line(n)

    def __enter__(self) -> Live:
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._end.set()
        self._thread.join()
        if self.counter.value > self.said:
            self._line(self.counter.value)
