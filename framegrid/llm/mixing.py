"""Mixing sources to target weights by weighted fair queueing.

A source's documents are shuffled by a hash of their id and sent up to three times. A document's virtual finish time is
its source's cumulative tokens divided by the source's target; all sendings are range-sorted by it and cut at the total
budget. Cumulative sums run over hash blocks, so a source with a third of all rows is spread over many tasks; an id that many
different rows share is spread by the rows' own digests.

Cases: a null text has size 0, and so takes nothing; a null source is a source of its own, sorted last; null ids are
shuffled as empty ones; repeated rows are separate documents, but are counted before they are queued, so a row of which
there are many is one entry; when nothing has a size, targets are 0; an empty table gives an empty result; further columns
may have any name, and ``sent`` keeps them. Equal finish times are cut together, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegrid.llm.common import WORD_PATTERN, expanded, saved, unused, whole_row

WEIGHTS = (5, 2, 1)
#: How often a document is sent at most; targets stop at so many times their source's size.
MOST_EPOCHS = 3
SEED = "mix"
#: Expected entries of a block of a source, and the most among which the cut is found in one task.
BLOCK_ROWS, CUT_ROWS = 4_000, 100_000
#: Sources are listed on the driver: one row each, never one for each document.
MOST_SOURCES = 1_000_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: Sequence[int], weights: Sequence[int], most: int = MOST_EPOCHS) -> list[float]:
    """Shares of the total by weight; what is above ``most`` times a source's size is shared out again by weight."""
    left, weight = sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    for at, i in enumerate(order):
        if most * sizes[i] * weight > weights[i] * left:
            share = left / weight
            for j in order[at:]:
                out[j] = weights[j] * share
            break
        out[i] = float(most * sizes[i])
        left, weight = left - most * sizes[i], weight - weights[i]
    return out


def dealt(entries: DataFrame, digits: int) -> DataFrame:
    """Entries (name, at, row and more) with the block of their source by the first ``digits`` of ``at``.

    An id that many entries share would be one block whatever the digits; its entries are dealt by their own digests, after the block's others.
    """
    heavy = saved(entries.groupBy("name", "at").agg(F.count("*").alias("entries")).where(F.col("entries") > 4 * BLOCK_ROWS), "heavy")
    further = 1
    while 16**further * BLOCK_ROWS < (heavy.agg(F.max("entries")).first()[0] or 0):
        further += 1
    own = F.concat(F.substring("at", 1, digits), F.lit("~"), "at", F.substring(F.hex("row"), 1, further))
    block = F.when(F.col("entries").isNull(), F.substring("at", 1, digits)).otherwise(own)
    return entries.join(heavy, ["name", "at"], "left").withColumn("block", block).drop("entries")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of ``docs``: doc_id, row (key), source, size, source_size, target, first finish time, times."""
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))  # null after all others
    sized = saved(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            whole_row(docs, doc_id, text).alias("row"),
            name.alias("name"),
            n_words(F.col(text)).alias("size"),
            F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).alias("at"),
        ),
        "sized",
    )
    totals = sized.groupBy("name").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).orderBy("name").limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"over {MOST_SOURCES} sources")
    digits = 0
    while 16**digits * BLOCK_ROWS < max((t.rows for t in totals), default=0):
        digits += 1
    goals = targets([t["size"] for t in totals], [weights[i % len(weights)] for i in range(len(totals))])
    goal = spark.createDataFrame([(t.name, t["size"], g) for t, g in zip(totals, goals, strict=True)], "name string, source_size long, target double")
    entries = sized.groupBy("name", "at", "doc_id", "size", "row").agg(F.count("*").alias("n"))
    blocked = dealt(entries, digits)
    before = Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy("name", "block")
        .agg(F.sum(F.col("size") * F.col("n")).alias("sum"))
        .select("name", "block", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"))
        .join(goal, "name")
    )
    inside = Window.partitionBy("name", "block").orderBy("at", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    queued = saved(
        blocked.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
        .join(starts, ["name", "block"])
        .select("doc_id", "row", "name", "size", "source_size", "target", "n", (F.col("start") + F.col("before")).alias("before")),
        "entries",
    )
    upto = F.col("before") + (F.col("copy") + 1) * F.col("size")
    queued = saved(expanded(queued, "n", "copy", ["row"]).select("doc_id", "row", "name", "size", "source_size", "target", upto.alias("upto")), "queued")
    end = cut(queued, sum(t["size"] for t in totals))
    times = sum((F.when(finish(e) <= end, 1).otherwise(0) for e in range(MOST_EPOCHS)), F.lit(0))
    return queued.select(
        "doc_id", "row", F.when(F.col("name") != "t", F.expr("substring(name, 2)")).alias("source"), "size", "source_size", "target",
        finish(0).alias("finish"), times.alias("times"),
    )


def finish(epoch: int) -> Column:
    return F.when(F.col("target") > 0, (F.col("upto") + epoch * F.col("source_size")) / F.col("target")).otherwise(F.lit(float("inf")))


def cut(queued: DataFrame, budget: int) -> float:
    """The last finish time up to which all sendings together stay within the budget.

    Sendings are range-partitioned; the range that the budget ends in is partitioned again until it is small.
    """
    rows = queued.where("target > 0").select(F.explode(F.array(*(finish(e) for e in range(MOST_EPOCHS)))).alias("finish"), "size")
    parts = max(2, int(queued.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    end, before, n = float("-inf"), 0, None
    while True:
        ordered = saved(rows.repartitionByRange(parts, "finish").withColumn("part", F.spark_partition_id()), "sent")
        sums = ordered.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("sum"), F.min("finish").alias("first"), F.max("finish").alias("last"))
        for r in sums.orderBy("last").collect():  # a row for each part
            if before + r["sum"] > budget:
                break
            end, before = r["last"], before + r["sum"]
        else:
            return end
        if r["first"] == r["last"]:
            return end
        part = ordered.where(F.col("part") == r.part)
        if r.n <= CUT_ROWS:
            upto = Window.orderBy("finish").rowsBetween(Window.unboundedPreceding, 0)
            summed = part.groupBy("finish").agg(F.sum("size").alias("sum")).withColumn("upto", before + F.sum("sum").over(upto))
            found = summed.where(F.col("upto") <= budget).agg(F.max("finish")).first()[0]
            return end if found is None else found
        rows = part.select("finish", "size")
        if r.n == n:  # one finish time holds nearly all
            rows = rows.groupBy("finish").agg(F.sum("size").alias("size"))
        n = r.n


def sent(docs: DataFrame, weights: Sequence[int] = WEIGHTS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it."""
    key, row = unused(docs, "key"), unused(docs, "row")
    times, copy = unused(docs, "times"), unused(docs, "copy")
    taken = mix(docs, weights, doc_id, text, source).groupBy("row").agg(F.sum("times").alias(times)).where(F.col(times) > 0)
    whole = docs.select(whole_row(docs, doc_id, text).alias(key), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row))
    once = whole.groupBy(key).agg(F.first(row).alias(row))  # rows with one key are equal
    kept = once.join(saved(taken.withColumnRenamed("row", key), "taken"), key)
    high = F.col(times) > MOST_EPOCHS  # only a repeated row is taken more often, so few rows with their texts are stored
    repeated = expanded(saved(kept.where(high), "repeated"), times, copy, [key])
    single = kept.where(~high).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return single.unionByName(repeated).select(*(F.col(row)[c].alias(c) for c in docs.columns))
