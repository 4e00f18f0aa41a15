"""Stage 3, first half: grid cells, symbols, labels and placing in the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.config import Grid, Table
from framegrid.functions import exprs as E


def typed_positions(raw: DataFrame) -> DataFrame:
    """Text columns of a position file to types; a blank or malformed time fails, blank pixels are null."""
    return raw.select(
        "document", "ord", E.strip(F.col("file")).alias("file"), F.col("time_s").cast("double").alias("time_s"),
        E.strip(F.col("status")).alias("status"), E.optional_int(F.col("px")).alias("px"), E.optional_int(F.col("py")).alias("py"),
    )


def last_symbols(raw: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One symbol for each cell, the last listed; at most cells * cells rows, as others can never be looked up."""
    inside = F.col("row").between(0, grid.cells - 1) & F.col("col").between(0, grid.cells - 1)
    return raw.where(inside).groupBy("row", "col").agg(F.max_by(E.strip(F.col("symbol")), "ord").alias("symbol"))


def with_cells(samples: DataFrame, grid: Grid = Grid()) -> DataFrame:
    located = E.is_located(F.col("status"), F.col("px"))
    py = F.when(F.col("py").isNull(), F.raise_error(F.lit("px without py"))).otherwise(F.col("py"))
    return samples.withColumns({
        "row": F.when(located, E.grid_cell(py, grid)), "col": F.when(located, E.grid_cell(F.col("px"), grid)),
    })


def lookup(samples: DataFrame, symbols: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Left join to the symbols; their size is bounded by the grid, so they are broadcast."""
    return with_cells(samples, grid).join(F.broadcast(last_symbols(symbols, grid)), ["row", "col"], "left")


def events(samples: DataFrame, symbols: DataFrame, grid: Grid = Grid(), table: Table = Table()) -> DataFrame:
    """Grid results with the label; what is not located is blanked and counts as empty."""
    found = lookup(samples, symbols, grid)
    located = E.is_located(F.col("status"), F.col("px"))
    blank = lambda c: F.when(located, F.col(c)).alias(c)
    return found.select(
        "document", "ord", "file", "time_s", "row", "col", F.when(located, F.col("status")).otherwise("empty").alias("status"), blank("px"), blank("py"),
        F.when(located, F.coalesce("symbol", F.lit(""))).otherwise("").alias("symbol"), E.event_label(located, F.col("symbol"), table).alias("event"),
    )


def placed(labelled: DataFrame, table: Table = Table()) -> DataFrame:
    """Events inside the table, with their cell."""
    column, row = E.time_cell(F.col("time_s"), table)
    inside = labelled.where(E.in_table(F.col("time_s"), table))
    return inside.withColumns({"col_idx": column, "row_idx": row})
