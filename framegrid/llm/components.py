"""Connected components by alternating large and small stars; every round's edges go to the shared folder.

Cases: repeated edges, edges in both directions and edges of a node with itself change nothing; a null end is no node, its edge is left
out; no edges give no rows. Rounds follow the logarithm of the longest path, so ``MOST_ROUNDS`` is far beyond any graph that can
be stored; should they not do, that is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import saved

MOST_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v) but the roots themselves; the root is a component's least node."""
    edges = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MOST_ROUNDS):
        edges = saved(_small(_large(edges)), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError("components did not settle")
