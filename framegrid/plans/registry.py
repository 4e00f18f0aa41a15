"""Registered queries over the driver's tables, each with its DuckDB SQL.

Samples derive from ``events`` (a user is a document), symbols from ``part``, decoded frames from ``events``, fusion
candidates from ``lineitem`` and source listings from ``customer`` and ``orders``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framegrid.functions import exprs as E
from framegrid.operators import archive, detect, fill, locate, sampling
from framegrid.sources import sinks
from framegrid.sources import tables as T
from framegrid.streaming import cells, windows

#: How many pending frames the limited resume query takes.
RESUME_LIMIT = 100


def _events(spark: SparkSession, d: str) -> DataFrame:
    return locate.events(T.samples(spark, d), T.symbols(spark, d))


def pixel_to_grid(spark: SparkSession, d: str) -> DataFrame:
    return T.samples(spark, d).select("ord", E.grid_cell(F.col("py")).alias("row"), E.grid_cell(F.col("px")).alias("col"))


def time_cell(spark: SparkSession, d: str) -> DataFrame:
    column, row = E.time_cell(F.col("time_s"))
    return T.samples(spark, d).where("time_s >= 40").select("ord", column.alias("col_idx"), row.alias("row_idx"))


def format_time(spark: SparkSession, d: str) -> DataFrame:
    return T.samples(spark, d).select("ord", E.mmss(F.col("time_s") * 10).alias("mmss"))


def parse_time(spark: SparkSession, d: str) -> DataFrame:
    return T.samples(spark, d).select("ord", "file", E.parse_time(F.col("file")).alias("time_s"))


def frame_name(spark: SparkSession, d: str) -> DataFrame:
    return T.samples(spark, d).select("ord", E.frame_name(F.col("ord"), F.col("time_s")).alias("file"))


def load_positions(spark: SparkSession, d: str) -> DataFrame:
    return locate.typed_positions(T.raw_positions(spark, d)).orderBy("document", "time_s", "ord")


def symbol_map(spark: SparkSession, d: str) -> DataFrame:
    return locate.last_symbols(T.symbols(spark, d))


def symbol_lookup(spark: SparkSession, d: str) -> DataFrame:
    return locate.lookup(T.samples(spark, d), T.symbols(spark, d)).select("ord", "row", "col", "symbol")


def event_labels(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("document", "ord", "time_s", "row", "col", "status", "px", "py", "symbol", "event")


def placed_events(spark: SparkSession, d: str) -> DataFrame:
    return locate.placed(_events(spark, d)).select("document", "ord", "col_idx", "row_idx", "event")


def cell_strings(spark: SparkSession, d: str) -> DataFrame:
    return fill.cell_strings(locate.placed(_events(spark, d)))


def streamed_cells(spark: SparkSession, d: str) -> DataFrame:
    """The cells again, from a stream over the events whose watermark closes them."""
    closed = cells.cells(T.samples(spark, d, stream=True), T.symbols(spark, d), late="0 seconds")
    home = sinks.scratch(spark, "cells")
    return cells.run(closed, f"{home}/closed", f"{home}/state")


def time_axis(spark: SparkSession, d: str) -> DataFrame:
    return fill.cell_bounds(locate.placed(_events(spark, d)))


def filled_grid(spark: SparkSession, d: str) -> DataFrame:
    documents = T.samples(spark, d).select("document").distinct()
    template = F.when(F.col("row_idx") == 0, "-")  # what the sheet holds before it is filled
    return fill.filled_grid(cell_strings(spark, d), documents, template)


def pivot_table(spark: SparkSession, d: str) -> DataFrame:
    return fill.pivoted(cell_strings(spark, d))


def em_archive(spark: SparkSession, d: str) -> DataFrame:
    return archive.empty_frames(T.samples(spark, d))


def un_archive(spark: SparkSession, d: str) -> DataFrame:
    return archive.unmapped(locate.placed(_events(spark, d)))


def archive_semi(spark: SparkSession, d: str) -> DataFrame:
    return archive.on_disk(em_archive(spark, d), T.listing(spark, d))


def done_set(spark: SparkSession, d: str) -> DataFrame:
    return T.done(spark, d).select("document", "file").distinct()


def resume_todo(spark: SparkSession, d: str) -> DataFrame:
    return detect.todo(T.listing(spark, d), T.done(spark, d))


def resume_limit(spark: SparkSession, d: str) -> DataFrame:
    return detect.todo(T.listing(spark, d), T.done(spark, d), RESUME_LIMIT)


def append_results(spark: SparkSession, d: str) -> DataFrame:
    new = detect.todo(T.listing(spark, d), T.done(spark, d)).withColumn("status", F.lit("new"))
    return T.done(spark, d).select("document", "file", "status").unionByName(new)


def detect_status(spark: SparkSession, d: str) -> DataFrame:
    found = T.samples(spark, d).withColumns({"readable": F.col("status") != "unreadable", "px": F.when(F.col("status") == "found", F.col("px"))})
    return detect.positions(found).select("document", "file", "status", "px")


def frame_sampling(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_frames(T.frames(spark, d)).select("document", "frame_index", "timestamp")


def roi_box(spark: SparkSession, d: str) -> DataFrame:
    return sampling.with_boxes(T.frames(spark, d)).select("document", "frame_index", "box.*")


def size_anomaly(spark: SparkSession, d: str) -> DataFrame:
    checked = sampling.check_sizes(sampling.with_boxes(sampling.sample_frames(T.frames(spark, d))))
    return checked.select("document", "frame_index", "w", "h", "anomaly")


def extraction_log(spark: SparkSession, d: str) -> DataFrame:
    return sampling.extraction_log(T.frames(spark, d))


def stage1_summary(spark: SparkSession, d: str) -> DataFrame:
    return sampling.summary(T.frames(spark, d))


def stage2_summary(spark: SparkSession, d: str) -> DataFrame:
    return detect.summary(T.done(spark, d), T.listing(spark, d))


def stage3_summary(spark: SparkSession, d: str) -> DataFrame:
    return fill.summary(_events(spark, d), locate.last_symbols(T.symbols(spark, d)))


def frame_listing(spark: SparkSession, d: str) -> DataFrame:
    return T.file_names(spark, d).where(E.is_frame(F.col("file"))).orderBy("document", "file")


def exactly_one_source(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("o_orderkey")
    state = F.when(n == 0, "missing").when(n > 1, "several").otherwise("one")
    held = T.read(spark, d, "customer").join(T.read(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return held.groupBy(F.col("c_custkey").alias("document")).agg(n.alias("n"), state.alias("state"))


def tumbling_15s(spark: SparkSession, d: str) -> DataFrame:
    return windows.tumbling(T.read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select(
        "document", F.unix_seconds("start").alias("start_s"), "n"
    )


def jump_score(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("document").orderBy("time_s", "ord")
    found = T.samples(spark, d).where(F.col("status") == "found")
    step = lambda c: F.col(c) - F.lag(c).over(order)
    return found.select("document", "ord", (step("px") * step("px") + step("py") * step("py")).alias("jump_sq"))


def fused_argmax(spark: SparkSession, d: str) -> DataFrame:
    return detect.best_candidate(T.candidates(spark, d))


_NAMES = [
    pixel_to_grid, time_cell, format_time, parse_time, frame_name, load_positions, symbol_map, symbol_lookup, event_labels,
    placed_events, cell_strings, streamed_cells, time_axis, filled_grid, pivot_table, em_archive, un_archive, archive_semi, done_set, resume_todo,
    resume_limit, append_results, detect_status, frame_sampling, roi_box, size_anomaly, extraction_log, stage1_summary,
    stage2_summary, stage3_summary, frame_listing, exactly_one_source, tumbling_15s, jump_score, fused_argmax,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _NAMES}


_OBS = """obs as (
  select user_id as document, event_id as ord, ((epoch_us(ts) // 100000) % 16000) / 10.0 :: double as time_s,
         case event_type when 'error' then 'empty' when 'signup' then 'unreadable' else 'found' end as status,
         cast((event_id * 37) % 186 as int) as px, cast((user_id * 53 + event_id * 11) % 186 as int) as py,
         'frame_' || printf('%04d', event_id // 2) || '_' || cast((event_id // 2) % 1600 as varchar) || '.0s.jpg' as file
  from events)"""
_SM = """sm as (
  select cast(((p_partkey * 7) % 400) // 20 as int) as "row", cast(((p_partkey * 7) % 400) % 20 as int) as col,
         arg_max(case when p_partkey % 40 = 0 then '' else 's' || cast(p_partkey as varchar) end, p_partkey) as symbol
  from part where p_partkey < 182 group by all)"""
_EV = f"""{_OBS}, {_SM}, cells as (
  select *, status = 'found' as located, case when status = 'found' then cast(greatest(0, least(19, (10 * py - 1) // 93)) as int) end as "row",
         case when status = 'found' then cast(greatest(0, least(19, (10 * px - 1) // 93)) as int) end as col from obs),
ev as (
  select document, ord, file, time_s, c."row", c.col, case when located then 'found' else 'empty' end as status,
         case when located then px end as px, case when located then py end as py, coalesce(case when located then symbol end, '') as symbol,
         case when not located then 'EM' when coalesce(symbol, '') = '' then 'UN' else symbol end as event
  from cells c left join sm on sm."row" = c."row" and sm.col = c.col),
placed as (
  select *, cast(floor((time_s - 40) / 90) as int) as col_idx, cast(floor(((time_s - 40) % 90) / 15) as int) as row_idx
  from ev where time_s >= 40 and time_s < 1570),
cell as (
  select document, col_idx, row_idx, string_agg(event, '_' order by time_s, ord) as cell from placed group by all)"""
_LIST = f"""{_OBS}, listing as (select distinct document, file from obs where (ord // 2) % 5 <> 0),
done as (select document, ord, file, status from obs where (ord // 2) % 3 = 0)"""
_FR = """raw as (
  select user_id % 20 as document, event_id as frame_index,
         case (user_id % 20) % 3 when 0 then 30.0 when 1 then 2.5 else 1.0 end :: double as fps,
         ((event_id * 13) % 100) / 1000.0 :: double as l, ((event_id * 17) % 100) / 1000.0 :: double as t,
         ((event_id * 13) % 100) / 1000.0 :: double + (140 + (event_id * 7) % 11) / 1000.0 :: double as r,
         ((event_id * 17) % 100) / 1000.0 :: double + (320 + (event_id * 5) % 13) / 1000.0 :: double as b from events),
fr as (select *, 100000 / fps as duration_s, greatest(1, cast(round_even(fps * 3, 0) as bigint)) as step, cast(trunc(40 * fps) as bigint) as first_frame from raw),
boxed0 as (
  select *, greatest(0, cast(round_even(l * 1280, 0) as int)) as bl, greatest(0, cast(round_even(t * 582, 0) as int)) as bt,
         least(1279, cast(round_even(r * 1280, 0) as int)) as br0, least(581, cast(round_even(b * 582, 0) as int)) as bb0 from fr),
boxed as (select *, case when br0 <= bl then bl + 1 else br0 end as br, case when bb0 <= bt then bt + 1 else bb0 end as bb from boxed0),
sampled as (
  select document, frame_index, frame_index / fps as ts, duration_s, br - bl as w, bb - bt as h from boxed
  where frame_index >= first_frame and frame_index <= cast(trunc(duration_s * fps) as bigint) and (frame_index - first_frame) % step = 0),
checked as (
  select *, row_number() over o - 1 as seq, (row_number() over o > 1) and (abs(w - first_value(w) over o) / first_value(w) over o > 0.03 :: double
         or abs(h - first_value(h) over o) / first_value(h) over o > 0.03 :: double) as anomaly
  from sampled window o as (partition by document order by frame_index))"""


def oracle_sql() -> dict[str, str]:
    pivot = ", ".join(f"max(case when col_idx = {i} then cell end) as c{i}" for i in range(17))
    return {
        "pixel_to_grid": f"""with {_OBS} select ord, cast(greatest(0, least(19, (10 * py - 1) // 93)) as int) as "row",
            cast(greatest(0, least(19, (10 * px - 1) // 93)) as int) as col from obs""",
        "time_cell": f"with {_OBS} select ord, cast(floor((time_s - 40) / 90) as int) as col_idx, cast(floor(((time_s - 40) % 90) / 15) as int) as row_idx from obs where time_s >= 40",
        "format_time": f"with {_OBS} select ord, printf('%02d:%02d', cast(trunc(time_s * 10) as bigint) // 60, cast(trunc(time_s * 10) as bigint) % 60) as mmss from obs",
        "parse_time": f"with {_OBS} select ord, file, cast(nullif(regexp_extract(file, '_(\\d+\\.?\\d*)s\\.jpg$', 1), '') as double) as time_s from obs",
        "frame_name": f"with {_OBS} select ord, 'frame_' || printf('%04d', ord) || '_' || printf('%.1f', time_s) || 's.jpg' as file from obs",
        "load_positions": f"""with {_OBS} select document, ord, file, time_s, status, case when status = 'found' then px end as px,
            case when status = 'found' then py end as py from obs""",
        "symbol_map": f"""with {_SM} select "row", col, symbol from sm""",
        "symbol_lookup": f"""with {_EV} select c.ord, c."row", c.col, sm.symbol from cells c left join sm on sm."row" = c."row" and sm.col = c.col""",
        "event_labels": f"""with {_EV} select document, ord, time_s, "row", col, status, px, py, symbol, event from ev""",
        "placed_events": f"with {_EV} select document, ord, col_idx, row_idx, event from placed",
        "cell_strings": f"with {_EV} select * from cell",
        "streamed_cells": f"with {_EV} select * from cell",
        "time_axis": f"""with {_EV} select col_idx, row_idx, printf('%02d:%02d', (40 + 90 * col_idx) // 60, (40 + 90 * col_idx) % 60) as header,
            40 + 90 * col_idx + 15 * row_idx as start_s, 55 + 90 * col_idx + 15 * row_idx as end_s, count(*) as events from placed group by all""",
        "filled_grid": f"""with {_EV}, axis as (select cast(i // 6 as int) as col_idx, cast(i % 6 as int) as row_idx from range(102) r(i))
            select d.document, a.col_idx, a.row_idx, coalesce(cell, case when a.row_idx = 0 then '-' end) as cell
            from (select distinct document from obs) d cross join axis a left join cell c on c.document = d.document and c.col_idx = a.col_idx and c.row_idx = a.row_idx""",
        "pivot_table": f"with {_EV} select document, row_idx, {pivot} from cell group by document, row_idx",
        "em_archive": f"""with {_OBS} select document, file, arg_min(time_s, ord) as time_s, count(*) as "count" from obs where status = 'empty' group by document, file""",
        "un_archive": f"""with {_EV}, un as (select * from placed where event = 'UN'),
            f as (select document, file, min(time_s) as time_s from un group by document, file)
            select un.document, un.file, f.time_s, "row", col, count(*) as "count" from un join f on f.document = un.document and f.file = un.file group by all""",
        "archive_semi": f"with {_LIST} select distinct document, file from obs o where status = 'empty' and exists (select 1 from listing l where l.document = o.document and l.file = o.file)",
        "done_set": f"with {_LIST} select distinct document, file from done",
        "resume_todo": f"with {_LIST} select document, file from listing l where not exists (select 1 from done d where l.document = d.document and l.file = d.file)",
        "resume_limit": f"""with {_LIST} select document, file from listing l where not exists (select 1 from done d where l.document = d.document and l.file = d.file)
            order by document, file limit {RESUME_LIMIT}""",
        "append_results": f"""with {_LIST} select document, file, status from done union all
            select document, file, 'new' as status from listing l where not exists (select 1 from done d where l.document = d.document and l.file = d.file)""",
        "detect_status": f"with {_OBS} select document, file, status, case when status = 'found' then px end as px from obs",
        "frame_sampling": f"with {_FR} select document, frame_index, ts as timestamp from sampled",
        "roi_box": f"with {_FR} select document, frame_index, bl as l, bt as t, br as r, bb as b from boxed",
        "size_anomaly": f"with {_FR} select document, frame_index, w, h, anomaly from checked",
        "extraction_log": f"""with {_FR} select document, cast(seq as int) as seq, printf('%02d:%02d', cast(trunc(ts) as bigint) // 60, cast(trunc(ts) as bigint) % 60) as mmss,
            cast(printf('%.1f', ts) as double) as time_s, case when anomaly then '' else 'frame_' || printf('%04d', seq) || '_' || printf('%.1f', ts) || 's.jpg' end as file,
            cast(w as varchar) || '×' || cast(h as varchar) as size, case when anomaly then '跳过(尺寸异常)' else '正常' end as status from checked""",
        "stage1_summary": f"""with {_FR} select document, count(*) as total, count(*) filter (not anomaly) as normal, count(*) filter (anomaly) as anomaly,
            any_value(duration_s) as duration_s, cast(trunc((any_value(duration_s) - 40) / 3) as bigint) + 1 as expected from checked group by document""",
        "stage2_summary": f"""with {_LIST}, r as (select document, count(*) filter (status = 'found') as found, count(*) filter (status = 'empty') as empty, count(distinct file) as done from done group by document),
            f as (select document, count(*) as frames from listing group by document)
            select coalesce(r.document, f.document) as document, coalesce(found, 0) as found, coalesce(empty, 0) as empty, coalesce(found, 0) + coalesce(empty, 0) as total,
            coalesce(frames, 0) - coalesce(done, 0) as remaining from f full join r on r.document = f.document""",
        "stage3_summary": f"""with {_EV}, s as (select document, count(*) as samples from ev group by document),
            u as (select document, count(*) filter (event = 'UN') as un_count from placed group by document), c as (select document, count(*) as filled_cells from cell group by document)
            select s.document, samples, coalesce(un_count, 0) as un_count, coalesce(filled_cells, 0) as filled_cells, (select count(*) from sm) as map_size,
            17 :: bigint as n_cols, 6 :: bigint as n_rows from s left join u on u.document = s.document left join c on c.document = s.document""",
        "frame_listing": f"with {_OBS} select distinct document, case when ord % 7 = 0 then 'thumb_' || file else file end as file from obs where ord % 7 <> 0",
        "exactly_one_source": """select c_custkey as document, count(o_orderkey) as n, case when count(o_orderkey) = 0 then 'missing' when count(o_orderkey) > 1 then 'several' else 'one' end as state
            from customer left join orders on c_custkey = o_custkey group by c_custkey""",
        "tumbling_15s": "select user_id as document, ((epoch_us(ts) // 1000000 - 10) // 15) * 15 + 10 as start_s, count(*) as n from events group by all",
        "jump_score": f"""with {_OBS} select document, ord, (px - lag(px) over o) * (px - lag(px) over o) + (py - lag(py) over o) * (py - lag(py) over o) as jump_sq
            from obs where status = 'found' window o as (partition by document order by time_s, ord)""",
        "fused_argmax": """with c as (select l_orderkey as frame, l_linenumber as candidate, l_discount * 10 + l_tax * 10 + 0.3 :: double * (l_quantity / 50) as score from lineitem)
            select frame, arg_max(candidate, (score, -candidate)) as candidate, max(score) as score from c where score >= 1.05 :: double group by frame""",
    }
