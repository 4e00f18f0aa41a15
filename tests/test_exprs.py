"""Column builders against independent Python rules."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framegrid.config import Sampling
from framegrid.functions import exprs as E


def values(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_grid_cell_everywhere(spark):
    px = list(range(-50, 2000))
    want = [max(0, min(19, int(x // 9.3))) for x in px]
    assert values(spark, E.grid_cell(F.col("x")), [(x,) for x in px], "x int") == want
    assert want[px.index(93)] == 9  # the formula floor(x / 9.3) would give 10


def test_time_cells(spark):
    ts = [40 + i / 10 for i in range(15600)]
    column, row = E.time_cell(F.col("t"))
    got = values(spark, F.array(column, row), [(t,) for t in ts], "t double")
    assert got == [[int((t - 40) // 90), int((t - 40) % 90 // 15)] for t in ts]


@pytest.mark.parametrize(("t", "inside"), [(39.9, False), (40.0, True), (1569.9, True), (1570.0, False)])
def test_table_bounds(spark, t, inside):
    assert values(spark, E.in_table(F.col("t")), [(t,)], "t double") == [inside]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(0, 6000), min_size=50, max_size=200))
def test_times_as_text(spark, xs):
    rows = [(x,) for x in xs]
    assert values(spark, E.tenths(F.col("x")), rows, "x double") == [f"{x:.1f}" for x in xs]
    assert values(spark, E.mmss(F.col("x")), rows, "x double") == [f"{int(x) // 60:02d}:{int(x) % 60:02d}" for x in xs]


def test_names(spark):
    assert values(spark, E.frame_name(F.lit(7), F.lit(42.25)), [(1,)], "x int") == ["frame_0007_42.2s.jpg"]
    names = ["frame_0007_42.2s.jpg", "frame_x.jpg", "a_3s.jpg", "a_3s.jpg.tmp"]
    assert values(spark, E.parse_time(F.col("n")), [(n,) for n in names], "n string") == [42.2, None, 3.0, None]
    assert values(spark, E.mmss(F.lit(6000.0)), [(1,)], "x int") == ["100:00"]


def test_rounding_is_half_even(spark):
    steps = [(60.4,), (0.1,), (60.1666666,), (1 / 6,)]
    want = [max(1, round(r[0] * 3)) for r in steps]
    assert values(spark, E.frame_step(F.col("f"), Sampling()), steps, "f double") == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.floats(-0.5, 1.5)] * 4), min_size=20, max_size=50))
def test_boxes(spark, rows):
    def want(l, t, r, b, w=1280, h=582):
        l, t = max(0, round(l * w)), max(0, round(t * h))
        r, b = min(w - 1, round(r * w)), min(h - 1, round(b * h))
        return [l, t, r if r > l else l + 1, b if b > t else t + 1]

    box = E.roi_box(*(F.col(c) for c in "ltrb"), F.lit(1280), F.lit(582))
    got = values(spark, F.array(*(box[c] for c in "ltrb")), rows, "l double, t double, r double, b double")
    assert got == [want(*r) for r in rows]


def test_anomaly(spark):
    rows = [(194, 190, 188, 190), (193, 190, 188, 190), (5, 5, 0, 190)]
    odd = E.is_anomaly(*(F.col(c) for c in "abcd"))
    assert values(spark, odd, rows, "a int, b int, c int, d int") == [True, False, False]


def test_strip_is_unicode_wide(spark):
    assert values(spark, E.strip(F.col("x")), [("　 a b ",)], "x string") == ["a b"]
    assert values(spark, E.optional_int(F.col("x")), [("　",), (" 7 ",)], "x string") == [None, 7]
