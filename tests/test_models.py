"""Model artifacts and progress."""

from __future__ import annotations

import pickle
import time

import pytest
from pyspark.sql import functions as F

from framegrid.operators import progress
from framegrid.sources import models


def test_shipped_model(spark, tmp_path):
    """Two files of one name are two models; a file over the bound is refused."""
    loads = []
    for i in (5, 7):
        (tmp_path / str(i)).mkdir()
        (tmp_path / f"{i}/bundle.pkl").write_bytes(pickle.dumps({"add": i}))
        loads.append(models.ship(spark, f"file:{tmp_path}/{i}/bundle.pkl"))

    def apply(parts):
        for part in parts:
            yield part.assign(id=part["id"] + loads[0]()["add"] + 10 * loads[1]()["add"])

    assert [r.id for r in spark.range(3).mapInPandas(apply, "id long").orderBy("id").collect()] == [75, 76, 77]
    with pytest.raises(ValueError, match="over 4 bytes"):
        models.read_file(str(tmp_path / "5/bundle.pkl"), 4)


def test_progress(spark):
    watch = progress.Progress()
    df = watch.watch(spark.range(10).withColumn("status", F.when(F.col("id") < 3, "found").otherwise("empty")))
    df.write.format("noop").mode("overwrite").save()
    rates = watch.rates()
    assert (rates["rows"], rates["found"], rates["empty"], rates["unreadable"]) == (10, 3, 7, 0) and rates["rows_a_second"] > 0


def test_lines_while_the_job_runs(spark):
    lines: list[tuple[float, str]] = []
    with progress.Live(spark, every=20, say=lambda x: lines.append((time.time(), x)), wait=0.02) as live:
        counter = live.counter

        def slow(parts):
            for part in parts:
                for _ in range(len(part)):
                    time.sleep(0.01)
                    counter.add(1)
                yield part

        spark.range(0, 160, 1, 16).mapInPandas(slow, "id long").write.format("noop").mode("overwrite").save()
        ended = time.time()
    counts = [int(x.split()[0]) for _, x in lines]
    assert counts == sorted(counts) and counts[-1] == 160 and len(counts) >= 3 and sum(at < ended for at, _ in lines) >= 2
