"""Table cells from a stream of positions: each cell's events are held, ordered, and given once when the watermark has passed its end.

Positions may come in any order. One is left out only if its cell was given before it came: when the watermark, ``late`` behind the
newest time of earlier batches, had passed the cell's end. All else gives the text that a batch over the same positions gives. State is
one list for each open cell, so it follows the recordings that run at a time, not their number. Spark's own aggregation keeps it, so no
Python runs for a cell, in the RocksDB state store, which ``run`` chooses for its query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.config import Grid, Table
from framegrid.functions import exprs as E
from framegrid.operators import fill, locate

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cells(samples: DataFrame, symbols: DataFrame, grid: Grid = Grid(), table: Table = Table(), late: str = "1 minute") -> DataFrame:
    """A stream of (document, ord, file, time_s, status, px, py) to a stream of (document, col_idx, row_idx, cell).

    Positions outside of the table move the watermark on, so the last cells close when a recording goes on past them.
    """
    timed = locate.events(samples, symbols, grid, table).withColumn("at", F.timestamp_millis(F.rint(F.col("time_s") * 1000).cast("long"))).withWatermark("at", late)
    # by the watermark's own column alone, as Spark moves any other condition before the watermark, where rows outside could not move it
    inside = timed.where(E.in_table(F.unix_millis("at") / 1000, table))
    column, row = E.time_cell(F.col("time_s"), table)
    placed = inside.select("document", column.alias("col_idx"), row.alias("row_idx"), "time_s", "ord", "event", "at")
    return fill.cell_strings(placed, table, F.window("at", f"{table.cell_s} seconds", startTime=f"{table.start_s % table.cell_s} seconds"))


def run(closed: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Take in all that the stream has now and store the cells that it closes; all that are stored so far."""
    spark = closed.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STORE)
    try:
        query = closed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    query.awaitTermination()
    return spark.read.schema(closed.schema).parquet(out)
