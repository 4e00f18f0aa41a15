"""Golden rows of the stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framegrid.operators import archive, detect, fill, locate, sampling

SAMPLES = "document string, ord long, file string, time_s double, status string, px int, py int"
SYMBOLS = "row int, col int, symbol string, ord long"


def samples(spark, *rows):
    return spark.createDataFrame([("d", i, f"f{i}", *r) for i, r in enumerate(rows)], SAMPLES)


def symbols(spark):
    return spark.createDataFrame([(0, 1, "b0", 0), (0, 1, " b1 ", 1), (0, 2, "", 2), (0, 0, "a", 3), (77, 0, "never", 4)], SYMBOLS)


def test_labels(spark):
    df = samples(spark, (50.0, "found", 10, 0), (50.0, "found", 0, 0), (51.0, "found", 20, 0), (52.0, "unreadable", None, None), (53.0, "found", None, 3), (54.0, "empty", 4, 4), (54.5, "found", 90, 90))
    events = {r.ord: r for r in locate.events(df, symbols(spark)).collect()}
    assert [events[i].event for i in range(7)] == ["b1", "a", "UN", "EM", "EM", "EM", "UN"]
    assert events[3].status == events[4].status == "empty" and events[5].px is None and events[2].symbol == ""
    cells = fill.cell_strings(locate.placed(locate.events(df, symbols(spark)))).collect()
    assert [(c.col_idx, c.row_idx, c.cell) for c in cells] == [(0, 0, "b1_a_UN_EM_EM_EM_UN")]


def test_cells_keep_order_and_bounds(spark):
    df = samples(spark, (55.0, "found", 0, 0), (54.9, "found", 10, 0), (54.9, "found", 10, 0), (39.9, "found", 0, 0), (1570.0, "found", 0, 0), (1569.9, "empty", None, None), (130.0, "empty", None, None))
    placed = locate.placed(locate.events(df, symbols(spark)))
    got = {(c.col_idx, c.row_idx): c.cell for c in fill.cell_strings(placed).collect()}
    assert got == {(0, 0): "b1_b1", (0, 1): "a", (16, 5): "EM", (1, 0): "EM"}
    assert sum(len(c.split("_")) for c in got.values()) == placed.count()


def test_px_without_py_fails(spark):
    with pytest.raises(Exception, match="px without py"):
        locate.events(samples(spark, (50.0, "found", 1, None)), symbols(spark)).collect()


def test_blank_time_fails(spark):
    raw = spark.createDataFrame([("d", 0, "f", "", "found", "1", "1")], "document string, ord long, file string, time_s string, status string, px string, py string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        locate.typed_positions(raw).collect()


def test_template_is_kept(spark):
    cells = spark.createDataFrame([("d", 0, 0, "x")], "document string, col_idx int, row_idx int, cell string")
    docs = spark.createDataFrame([("d",), ("e",)], "document string")
    rows = fill.filled_grid(cells, docs, F.lit("old")).collect()
    assert len(rows) == 204 and sum(r.cell == "x" for r in rows) == 1 and sum(r.cell == "old" for r in rows) == 203
    wide = fill.pivoted(cells).collect()
    assert len(wide) == 1 and wide[0].c0 == "x" and wide[0].c16 is None


def test_archives(spark):
    recorded = spark.createDataFrame([("d", 1, "f", 9.0, "empty"), ("d", 0, "f", 5.0, "empty"), ("d", 2, "g", 1.0, "unreadable")], "document string, ord long, file string, time_s double, status string")
    assert [tuple(r) for r in archive.empty_frames(recorded).collect()] == [("d", "f", 5.0, 2)]
    placed = spark.createDataFrame([("d", "f", 60.0, 0, 1, 1, "UN"), ("d", "f", 50.0, 1, 2, 2, "UN"), ("d", "f", 70.0, 2, 1, 1, "UN"), ("d", "g", 41.0, 3, 1, 1, "EM")], "document string, file string, time_s double, ord long, row int, col int, event string")
    assert sorted(tuple(r) for r in archive.unmapped(placed).collect()) == [("d", "f", 50.0, 1, 1, 2), ("d", "f", 50.0, 2, 2, 1)]


def test_resume(spark):
    frames = spark.createDataFrame([("d", f"f{i}") for i in range(5)], "document string, file string")
    done = spark.createDataFrame([("d", "f1"), ("d", "f1"), ("d", "gone")], "document string, file string")
    assert sorted(r.file for r in detect.todo(frames, done).collect()) == ["f0", "f2", "f3", "f4"]
    assert [r.file for r in detect.todo(frames, done, 2).collect()] == ["f0", "f2"]
    state = detect.summary(done.withColumn("status", F.lit("found")), frames).first()
    assert (state.found, state.total, state.remaining) == (3, 3, 3)


def test_first_frame_is_the_reference(spark):
    rows = [("d", i, 1.0, 0.0, 0.0, w / 1000, 0.19, 1001, 1001, float(i)) for i, w in [(0, 0.188 * 1000), (3, 194), (6, 193), (9, 180)]]
    frames = spark.createDataFrame(rows, "document string, frame_index long, fps double, l double, t double, r double, b double, width int, height int, timestamp double")
    got = sampling.check_sizes(sampling.with_boxes(frames)).orderBy("frame_index").collect()
    assert [r.anomaly for r in got] == [False, True, False, True]
    assert [r.seq for r in sampling.number_frames(frames).orderBy("frame_index").collect()] == [0, 1, 2, 3]
