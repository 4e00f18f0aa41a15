"""Sharding by Karmarkar-Karp differencing; documents of equal text form one indivisible group.

Groups are dealt by hash into buckets that fit a task. In each bucket the two partial partitions with the largest spread
are combined, oppositely ordered, until one is left; the buckets' partitions (at most ``MOST_BUCKETS`` tuples of sums)
are then combined in the same way on the driver. Bytes end up near equal unless one group alone outweighs a shard. Equal rows
are counted before anything else and made into rows again at the end, in parts.

Cases: null texts form one group apart from empty ones and count 0 bytes plus 1; repeated rows keep a slot each; null
ids are allowed; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegrid.llm.common import digest, expanded, saved

#: Groups that a bucket holds while there are fewer than MOST_BUCKETS of them.
BUCKET_GROUPS = 16384
MOST_BUCKETS = 65536
#: Entries that are numbered together.
BLOCK_ROWS = 65536


def differencing(parts: Sequence[Sequence[int]], k: int) -> list[tuple[int, ...]]:
    """For each k-tuple of ``parts`` (sums in descending order): the part of the whole that each of its slots joins."""
    if not parts:
        return []
    heap = [(p[-1] - p[0], i, tuple(p)) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    joins: list[tuple[int, int, tuple[int, ...]]] = []
    n = len(parts)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b), strict=True)]
        order = sorted(range(k), key=sums.__getitem__, reverse=True)
        at = [0] * k
        for slot, x in enumerate(order):
            at[x] = slot
        least = sums[order[-1]]
        new = tuple(sums[x] - least for x in order)
        heapq.heappush(heap, (-new[0], n + len(joins), new))
        joins.append((i, j, tuple(at)))
    goes: list[tuple[int, ...]] = [()] * (n + len(joins))
    goes[-1] = tuple(range(k))
    for m in range(len(joins) - 1, -1, -1):
        i, j, at = joins[m]
        to = goes[n + m]
        goes[i] = tuple(to[x] for x in at)
        goes[j] = tuple(to[x] for x in reversed(at))
    return goes[:n]


def _bucket(k: int):
    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["total", "key"], ascending=[False, True], ignore_index=True)
        nothing = (0,) * (k - 1)
        goes = differencing([(int(t), *nothing) for t in group["total"]], k)
        raw = np.array([g[0] for g in goes])
        sums = np.bincount(raw, weights=group["total"], minlength=k)
        rank = np.empty(k, dtype=int)
        rank[np.argsort(-sums, kind="stable")] = np.arange(k)
        return pd.DataFrame({"key": group["key"], "bucket": group["bucket"], "part": rank[raw], "total": group["total"]})

    return split


def shards(docs: DataFrame, k: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key (of the group), size, text_crc32, shard and slot for each row of ``docs``."""
    spark = docs.sparkSession
    known = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(digest(F.col(text)), F.lit(b"")).alias("key"),
        (F.octet_length(known) + 1).cast("long").alias("size"),
        F.crc32(known).alias("text_crc32"),
    )
    # equal rows are one entry with a count, so however many they are they burden no task
    rows = saved(rows.groupBy("doc_id", "key", "size", "text_crc32").agg(F.count("*").alias("n")), "entries")
    groups = saved(rows.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("total")), "groups")
    buckets = min(MOST_BUCKETS, max(1, -(-groups.count() // BUCKET_GROUPS)))
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    parted = saved(
        dealt.groupBy("bucket").applyInPandas(_bucket(k), "key binary, bucket int, part int, total long"), "parted"
    )
    sums = np.zeros((buckets, k), dtype=object)
    for r in parted.groupBy("bucket", "part").agg(F.sum("total").alias("total")).collect():  # at most MOST_BUCKETS * k rows
        sums[r.bucket, r.part] = r.total
    goes = differencing([sorted(s, reverse=True) for s in sums.tolist()], k)
    to = spark.createDataFrame([(b, list(g)) for b, g in enumerate(goes)], "bucket int, goes array<int>")
    placed = parted.join(F.broadcast(to), "bucket").select("key", F.get("goes", F.col("part")).alias("shard"))
    return numbered(rows.join(placed, "key"), rows.count())


def numbered(entries: DataFrame, n_entries: int) -> DataFrame:
    """Rows out of entries (rows with a count ``n``), with gapless slots from 0 in each shard: entries are numbered in blocks, blocks by their counts."""
    blocks = max(1, -(-n_entries // BLOCK_ROWS))
    entries = saved(entries.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.lit(blocks)).cast("int")), "placed")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = entries.groupBy("shard", "block").agg(F.sum("n").alias("count")).select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = entries.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, ["shard", "block"])
    first = placed.select("doc_id", "key", "size", "text_crc32", "shard", "n", (F.col("start") + F.col("at")).alias("first"))
    rows = expanded(saved(first, "first-slots"), "n", "copy", ["key"])
    return rows.select("doc_id", "key", "size", "text_crc32", "shard", (F.col("first") + F.col("copy")).alias("slot"))
