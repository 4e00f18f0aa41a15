"""Stage 3, second half: cells, the template and its pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framegrid.config import Table
from framegrid.functions import exprs as E


def cell_strings(placed: DataFrame, table: Table = Table(), *span: Column) -> DataFrame:
    """Labels of a cell joined in time order, duplicates kept; partial lists are built before the one shuffle.

    For a stream, ``span`` is the cell's window of event time, by which the watermark closes it.
    """
    listed = F.array_sort(F.collect_list(F.struct("time_s", "ord", "event")))
    joined = F.array_join(F.transform(listed, lambda x: x["event"]), table.separator)
    return placed.groupBy("document", "col_idx", "row_idx", *span).agg(joined.alias("cell")).select("document", "col_idx", "row_idx", "cell")


def axis_columns(table: Table = Table()) -> Column:
    """All cells of the table as an array of (col_idx, row_idx)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(table.columns * table.rows - 1)),
        lambda i: F.struct((i / table.rows).cast("int").alias("col_idx"), (i % table.rows).cast("int").alias("row_idx")),
    )


def time_axis(spark: SparkSession, table: Table = Table()) -> DataFrame:
    cells = spark.range(1).select(F.inline(axis_columns(table)))
    start = table.start_s + table.column_s * F.col("col_idx") + table.cell_s * F.col("row_idx")
    header = E.mmss(table.start_s + table.column_s * F.col("col_idx"))
    return cells.select("col_idx", "row_idx", header.alias("header"), start.alias("start_s"), (start + table.cell_s).alias("end_s"))


def cell_bounds(placed: DataFrame, table: Table = Table()) -> DataFrame:
    """The cells that events fall in: header, first second, second after the last, and how many events."""
    start = table.start_s + table.column_s * F.col("col_idx") + table.cell_s * F.col("row_idx")
    header = E.mmss(table.start_s + table.column_s * F.col("col_idx"))
    counted = placed.groupBy("col_idx", "row_idx").agg(F.count("*").alias("events"))
    return counted.select("col_idx", "row_idx", header.alias("header"), start.alias("start_s"), (start + table.cell_s).alias("end_s"), "events")


def filled_grid(cells: DataFrame, documents: DataFrame, template: Column, table: Table = Table()) -> DataFrame:
    """Every cell of every document's table: its fill, else what the template holds."""
    blank = documents.select("document", F.inline(axis_columns(table)))
    filled = blank.join(cells, ["document", "col_idx", "row_idx"], "left")
    return filled.select("document", "col_idx", "row_idx", F.coalesce("cell", template).alias("cell"))


def pivoted(cells: DataFrame, table: Table = Table()) -> DataFrame:
    """One row for each table row; the columns are named, so no extra job looks for them."""
    wide = cells.groupBy("document", "row_idx").pivot("col_idx", list(range(table.columns))).agg(F.first("cell"))
    return wide.select("document", "row_idx", *(F.col(str(i)).alias(f"c{i}") for i in range(table.columns)))


def summary(labelled: DataFrame, symbols: DataFrame, table: Table = Table()) -> DataFrame:
    """One pass over the labelled events; the size of the symbol map is one row, added to each."""
    inside = E.in_table(F.col("time_s"), table)
    column, row = E.time_cell(F.col("time_s"), table)
    counted = labelled.groupBy("document").agg(
        F.count("*").alias("samples"), F.count_if(inside & (F.col("event") == table.unmapped)).alias("un_count"),
        F.count_distinct(F.when(inside, column * table.rows + row)).alias("filled_cells"),
    )
    size = symbols.agg(F.count("*").alias("map_size"))
    return counted.join(F.broadcast(size)).select(
        "*", F.lit(table.columns).cast("long").alias("n_cols"), F.lit(table.rows).cast("long").alias("n_rows")
    )
