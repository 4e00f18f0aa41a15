"""Column builders; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framegrid.config import Grid, Sampling, Table
from framegrid.schemas import NORMAL, SKIPPED


def strip(c: Column) -> Column:
    """Trim all Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def optional_int(c: Column) -> Column:
    return F.nullif(strip(c), F.lit("")).cast("int")


def grid_cell(px: Column, grid: Grid = Grid()) -> Column:
    """Floor division as on binary doubles, which differs from floor(px / size) at multiples; clamped to the grid."""
    size = F.lit(grid.cell_px)
    whole = F.rint((px - px % size) / size).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(grid.cells - 1), whole))


def time_cell(t: Column, table: Table = Table()) -> tuple[Column, Column]:
    """Column and row of a time; cells are half-open, a boundary belongs to the later one."""
    offset = t - table.start_s
    column = F.floor(offset / table.column_s).cast("int")
    row = F.floor((offset % table.column_s) / table.cell_s).cast("int")
    return column, row


def in_table(t: Column, table: Table = Table()) -> Column:
    column, row = time_cell(t, table)
    return (t >= table.start_s) & (column < table.columns) & (row < table.rows)


def mmss(seconds: Column) -> Column:
    """Minutes do not wrap at 60."""
    whole = seconds.cast("int")
    return F.format_string("%02d:%02d", (whole / 60).cast("int"), whole % 60)


def tenths(x: Column) -> Column:
    """One decimal, rounded on the exact binary value."""
    return F.call_function("format_number", x, F.lit("0.0"))


def frame_name(seq: Column, t: Column) -> Column:
    return F.concat(F.format_string("frame_%04d_", seq), tenths(t), F.lit("s.jpg"))


def parse_time(name: Column) -> Column:
    """Seconds in a frame's file name; null where it has none."""
    return F.nullif(F.regexp_extract(name, r"_(\d+\.?\d*)s\.jpg$", 1), F.lit("")).cast("double")


def frame_number(name: Column) -> Column:
    """The sequence number in a frame's file name; other names come last."""
    number = F.nullif(F.regexp_extract(name, r"^frame_(\d+)_", 1), F.lit("")).cast("long")
    return F.coalesce(number, F.lit((1 << 63) - 1))


def is_frame(name: Column) -> Column:
    return F.startswith(name, F.lit("frame_")) & F.endswith(name, F.lit(".jpg"))


def fps(c: Column, conf: Sampling = Sampling()) -> Column:
    return F.coalesce(F.nullif(c, F.lit(0.0)), F.lit(conf.default_fps))


def frame_step(rate: Column, conf: Sampling = Sampling()) -> Column:
    """Half-even rounding, at least one frame."""
    return F.greatest(F.lit(1), F.rint(rate * conf.interval_s).cast("long"))


def end_seconds(duration: Column, conf: Sampling = Sampling()) -> Column:
    return duration if conf.end_s is None else F.least(F.lit(conf.end_s), duration)


def is_sampled(frame: Column, rate: Column, duration: Column, conf: Sampling = Sampling()) -> Column:
    first, last = (conf.start_s * rate).cast("long"), (end_seconds(duration, conf) * rate).cast("long")
    return frame.between(first, last) & ((frame - first) % frame_step(rate, conf) == 0)


def expected_frames(duration: Column, conf: Sampling = Sampling()) -> Column:
    return ((end_seconds(duration, conf) - conf.start_s) / conf.interval_s).cast("long") + 1


def roi_box(left: Column, top: Column, right: Column, bottom: Column, width: Column, height: Column) -> Column:
    """Fractions to a pixel box: rounded half-even, clamped, one pixel wide and high at least."""
    px = lambda part, whole: F.rint(part * whole).cast("int")
    low = [F.greatest(F.lit(0), px(left, width)), F.greatest(F.lit(0), px(top, height))]
    high = [F.least(width - 1, px(right, width)), F.least(height - 1, px(bottom, height))]
    l, t = low
    r, b = (F.when(h <= x, x + 1).otherwise(h) for x, h in zip(low, high, strict=True))
    return F.struct(l.alias("l"), t.alias("t"), r.alias("r"), b.alias("b"))


def is_anomaly(w: Column, h: Column, ref_w: Column, ref_h: Column, conf: Sampling = Sampling()) -> Column:
    odd = (F.abs(w - ref_w) / ref_w > conf.max_deviation) | (F.abs(h - ref_h) / ref_h > conf.max_deviation)
    return F.when((ref_w <= 0) | (ref_h <= 0), False).otherwise(odd)


def size_label(w: Column, h: Column) -> Column:
    return F.concat(w.cast("string"), F.lit("×"), h.cast("string"))


def frame_status(anomaly: Column) -> Column:
    return F.when(anomaly, SKIPPED).otherwise(NORMAL)


def detect_status(readable: Column, px: Column) -> Column:
    return F.when(~readable, "unreadable").when(px.isNotNull(), "found").otherwise("empty")


def is_located(status: Column, px: Column) -> Column:
    return (status == "found") & px.isNotNull()


def event_label(located: Column, symbol: Column, table: Table = Table()) -> Column:
    named = F.when(F.coalesce(symbol, F.lit("")) == "", table.unmapped).otherwise(symbol)
    return F.when(located, named).otherwise(table.empty)


def fused_score(ncc: Column, probability: Column, coverage: Column) -> Column:
    return ncc + probability + 0.3 * coverage
