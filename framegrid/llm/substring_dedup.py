"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes are taken where they matter: of each run of windows the anchor with the least hash of ``PREFIX`` words begins
one, so that equal windows hold equal anchors at equal places. Anchors are grouped by that prefix; a prefix met in one
text only is dropped. Each remaining group gets the words around its anchors, sorts the suffixes after them and the
reversed words before them, and so has both trees' nodes at every depth; a pair of nodes that together span a window is
a repeat, with the least document that holds it. A prefix with over ``MOST_CONTEXTS`` different surroundings is
lengthened: its windows are halved by where they begin, and each half has a longer run of words in common (16, then 33,
42, 46, 48, 49), which groups the surroundings anew; where it is the whole window, one minimum is left to take. Equal
surroundings are one leaf, and equal texts one text, so copies are never gathered in a task.

Cases: null and empty texts have no words; texts shorter than a window lose nothing; within a text or among rows of one
doc_id, whatever their texts, nothing is removed; null ids count as the greatest; repeated rows get equal results; texts of any length are read
whole; an empty table gives an empty result; further columns are not read. Ids are whole numbers, as their order counts; other text as
an id is an error of the cast. A null id counts as 2 ** 63 - 1, so it ties with a row of that id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import digest, saved, utf8

WINDOW = 50
PREFIX = 16
#: Different surroundings of one prefix that a task takes; over this, the prefix is lengthened.
MOST_CONTEXTS = 4096
#: Surroundings that are sorted together.
BLOCK_ROWS = 30_000
CACHE_WORDS = 200_000
LAST = (1 << 63) - 1
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """64-bit hashes of all runs of ``size`` words."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, hashed = self.known, xxhash.xxh3_64_intdigest
        h = np.array([known.get(w) or known.setdefault(w, hashed(w)) for w in words], np.uint64)
        n = len(words) - self.size + 1
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(self.size):
                out = (out ^ (out >> np.uint64(29))) * _GOLDEN + h[i : i + n]
            return out ^ (out >> np.uint64(32))


def anchors(grams: np.ndarray, run: int) -> np.ndarray:
    """Places of the least gram (the first of equals) of every ``run`` grams in a row."""
    if len(grams) < run:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, run)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def _index(window: int, prefix: int):
    def index(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Grams(prefix)
        for batch in it:
            sizes, shas, places, grams = [], [], [], []
            for text in utf8(batch.column(2)):
                words = (text or b"").split()
                sizes.append(len(words))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                g = hashed(words) if len(words) >= window else np.empty(0, np.uint64)
                at = anchors(g, window - prefix + 1)
                places.append(at.astype(np.int32))
                grams.append(g[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(places, pa.list_(pa.int32())), pa.array(grams, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_words", "sha", "places", "grams"],
            )

    return index


_CONTEXT = "kind int, id bigint, tid binary, text binary, place int, gram bigint, context binary, left int"
_FIELDS = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("tid", pa.binary()), ("text", pa.binary()), ("place", pa.int32()), ("gram", pa.int64()), ("context", pa.binary()), ("left", pa.int32())])
#: Rows of kind 0 are anchors and name their surroundings; of kind 1, surroundings, once in a task; of kind 2, texts.
ANCHOR, CONTEXT, TEXT = 0, 1, 2


def _contexts(window: int, prefix: int):
    before = window - prefix

    def contexts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Grams(prefix)
        least: dict[bytes, int] = {}  # of surroundings already given out
        for batch in it:
            rows = []
            ids, tids, places = (batch.column(i).to_pylist() for i in (0, 1, 3))
            if len(least) > CACHE_WORDS:
                least.clear()
            for id_, tid, text, at in zip(ids, tids, utf8(batch.column(2)), places, strict=True):
                words = text.split()
                grams = hashed(words).view(np.int64)
                for a in at:
                    left = min(a, before)
                    part = b" ".join(words[a - left : a + window])
                    key = xxhash.xxh3_128_digest(b"%d:" % left + part)
                    gram = int(grams[a])
                    rows.append((ANCHOR, id_, tid, None, a, gram, key, None))
                    if least.get(key, LAST + 1) > id_:
                        least[key] = id_
                        rows.append((CONTEXT, id_, None, part, None, gram, key, left))
                rows.append((TEXT, id_, tid, text, None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS) if rows else pa.RecordBatch.from_pylist([], _FIELDS)

    return contexts


def _nodes(gram: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """For each depth, the node of the tree of ``words`` (by row) that a row is in; roots are the grams."""
    order = np.lexsort((*words.T[::-1], gram))
    g, w = gram[order], words[order]
    same = np.empty((len(g), words.shape[1] + 1), bool)
    same[0] = False
    same[1:, 0] = g[1:] == g[:-1]
    same[1:, 1:] = w[1:] == w[:-1]
    same = np.logical_and.accumulate(same, axis=1)
    out = []
    for depth in range(words.shape[1] + 1):
        node = np.empty(len(g), np.int64)
        node[order] = np.cumsum(~same[:, depth])
        out.append(node)
    return out


def earlier_windows(
    gram: np.ndarray, least: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, contexts: list[bytes], window: int, before: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows low to high, bit o stands for the window that begins o words before the anchor: those that fit, and those that a document before the leaf's own holds."""
    known: dict[bytes, int] = {}
    after_words = np.zeros((len(gram), window), np.int32)
    before_words = np.zeros((len(gram), before), np.int32)
    right = np.empty(len(gram), np.int64)
    for i, (part, n) in enumerate(zip(contexts, left.tolist(), strict=True)):
        ids = [known.setdefault(x, len(known) + 1) for x in part.split()]
        right[i] = len(ids) - n
        after_words[i, : right[i]] = ids[n:]
        before_words[i, :n] = ids[:n][::-1]
    after, ahead = _nodes(gram, after_words), _nodes(gram, before_words)
    fits, earlier = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
    for o in range(before + 1):
        ok = np.flatnonzero((left >= o) & (right >= window - o) & (low <= o) & (o <= high))
        if not len(ok):
            continue
        pair = ahead[o][ok] * (len(gram) + 1) + after[window - o][ok]
        _, node = np.unique(pair, return_inverse=True)
        first = np.full(node.max() + 1, LAST)
        np.minimum.at(first, node, least[ok])
        fits[ok] |= 1 << o
        earlier[ok[first[node] < least[ok]]] |= 1 << o
    return fits, earlier


_RESULT = "context binary, least bigint, fits bigint, earlier bigint"


def _trees(window: int, before: int):
    """Rows (gram, context, least, left, text), sorted by gram, whole grams in a partition."""

    def done(rows: pa.Table) -> pa.RecordBatch:
        gram, least, left, low, high = (rows.column(c).to_numpy() for c in ("gram", "least", "left", "low", "high"))
        fits, earlier = earlier_windows(gram, least, left, low, high, rows.column("text").to_pylist(), window, before)
        return pa.RecordBatch.from_arrays(
            [rows.column("context").combine_chunks().cast(pa.binary()), pa.array(least), pa.array(fits), pa.array(earlier)], ["context", "least", "fits", "earlier"]
        )

    def trees(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in it:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows >= BLOCK_ROWS:
                gram = held.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))
                if cut:
                    yield done(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    return trees


def halves(low: int, high: int) -> list[tuple[int, int]]:
    middle = (low + high) // 2
    return [(low, middle), (middle + 1, high)]


_LONGER = "gram bigint, whole binary, context binary, least bigint, left int, low int, high int, text binary"


def _lengthen(window: int):
    """Surroundings to one row for each half of their windows, with the words that the half has in common as the new prefix."""

    def lengthen(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            fields = ("context", "least", "left", "low", "high", "text")
            for context, least, left, low, high, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in fields), strict=True):
                words = text.split()
                right = len(words) - left
                for a, b in halves(low, high):
                    if max(a, window - right) <= min(b, left):  # a window of this half fits
                        core = b" ".join(words[left - a : left + window - b])
                        gram = xxhash.xxh3_64_intdigest(core, seed=a * 64 + b) - (1 << 63)
                        rows.append((gram, xxhash.xxh3_128_digest(core) if a == b else None, context, least, left, a, b, text))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            names = [f.split()[0] for f in _LONGER.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return lengthen


def _cut(window: int):
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            removed, shas, ids, tids, spans = [], [], batch.column(0), batch.column(1), []
            for text, marks in zip(utf8(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for mark in marks:
                    at, bits = mark["place"], mark["bits"]
                    while bits:
                        o = bits.bit_length() - 1
                        edge[at - o] += 1
                        edge[at - o + window] -= 1
                        bits ^= 1 << o
                covered = np.cumsum(edge[:-1]) > 0
                removed.append(int(covered.sum()))
                shas.append(hashlib.sha256(b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c)).hexdigest())
                ends = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                spans.append(ends.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, tids, pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(spans, pa.list_(pa.int64()))], ["id", "tid", "n_removed", "sha", "spans"]
            )

    return cut


def removals(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (begin and end words of the removed runs) for each row of ``docs``."""
    before = window - prefix
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest(F.col(text)).alias("key"), F.col(text).alias("text"))
    indexed = saved(
        source.mapInArrow(_index(window, prefix), "doc_id long, key binary, n_words long, sha string, places array<int>, grams array<bigint>"), "indexed"
    )
    order = F.coalesce("doc_id", F.lit(LAST))
    texts = saved(
        indexed.where(F.col("n_words") >= window).groupBy("key").agg(
            F.min(order).alias("id"), F.first("places").alias("places"), F.first("grams").alias("grams")
        ).withColumn("tid", F.col("key")),
        "texts",
    )
    spots = texts.select("id", "tid", F.explode(F.arrays_zip("places", "grams")).alias("at")).select("id", "tid", F.col("at.places").alias("place"), F.col("at.grams").alias("gram"))
    shared = saved(spots.groupBy("gram").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("gram"), "shared")
    wanted = saved(spots.join(shared, "gram").groupBy("id", "tid").agg(F.collect_list("place").alias("places")), "wanted")
    rows = source.where("text is not null").withColumns({"id": order, "tid": F.col("key")}).join(wanted, ["id", "tid"])
    around = saved(rows.select("id", "tid", "text", "places").mapInArrow(_contexts(window, prefix), _CONTEXT), "around", ["kind"])

    all_windows, part = (F.lit(None).cast("binary").alias("whole"), F.lit(0).alias("low"), F.lit(before).alias("high")), []
    pending = around.where(f"kind = {CONTEXT}").select("gram", "context", F.col("id").alias("least"), "left", "text", *all_windows)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    while True:
        counts = pending.where("whole is null").groupBy("gram").agg(F.approx_count_distinct("context", 0.05).alias("n"))
        large = saved(counts.where(F.col("n") > MOST_CONTEXTS).select("gram"), "large")
        last = large.isEmpty()
        small = pending.where("whole is null") if last else pending.where("whole is null").join(large, "gram", "left_anti")
        part.append(_gathered(small, parts).mapInArrow(_trees(window, before), _RESULT))
        if part[1:]:
            part.append(_earliest(pending.where("whole is not null")))
        if last:
            break
        pending = saved(_once(pending.join(large, "gram", "left_semi")).mapInArrow(_lengthen(window), _LONGER), "longer")
    leaves = part[0]
    if part[1:]:
        split = reduce(DataFrame.unionByName, part[1:])
        leaves = leaves.unionByName(split.groupBy("context").agg(F.min("least").alias("least"), *(F.bit_or(c).alias(c) for c in ("fits", "earlier"))))
    bits = F.when(F.col("id") > F.col("least"), F.col("fits")).otherwise(F.col("earlier"))
    marked = around.where(f"kind = {ANCHOR}").select("id", "tid", "place", "context").join(saved(leaves, "leaves"), "context").withColumn("bits", bits)
    marks = marked.where("bits != 0").groupBy("id", "tid").agg(F.collect_set(F.struct("place", "bits")).alias("marks"))
    held = around.where(f"kind = {TEXT}").select("id", "tid", "text").join(marks, ["id", "tid"])
    cut = held.select("id", "tid", "text", "marks").mapInArrow(_cut(window), "id bigint, tid binary, n_removed bigint, sha string, spans array<bigint>")
    cut = saved(cut.dropDuplicates(["id", "tid"]), "cut")

    judged = texts.select("key", "id", "tid").join(cut.withColumnRenamed("sha", "cut_sha"), ["id", "tid"], "left").select("key", F.col("id").alias("first_id"), "n_removed", "cut_sha", "spans")
    every = indexed.select("doc_id", "key", "n_words", "sha").join(judged, "key", "left")
    copy = F.coalesce(order > F.col("first_id"), F.lit(False))
    empty = hashlib.sha256(b"").hexdigest()
    return every.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.array(F.lit(0), F.col("n_words")).cast("array<bigint>")).otherwise(F.coalesce("spans", F.array().cast("array<bigint>"))).alias("spans"),
    )


_KEPT = ("least", "left", "low", "high", "text")


def _once(contexts: DataFrame) -> DataFrame:
    """One row for each prefix and surroundings, with the least document."""
    return contexts.groupBy("gram", "context").agg(F.min("least").alias("least"), *(F.first(c).alias(c) for c in _KEPT[1:]))


def _gathered(contexts: DataFrame, parts: int) -> DataFrame:
    """One row for each surroundings, whole prefixes in a partition, in order."""
    return _once(contexts.repartition(parts, "gram")).sortWithinPartitions("gram").select("gram", "context", *_KEPT)


def _earliest(windows: DataFrame) -> DataFrame:
    """Prefixes that are whole windows: their least document, by sums alone; they are stored, so that the join with a common window can be split."""
    first = saved(windows.groupBy("whole").agg(F.min("least").alias("first")), "first")
    bit = F.expr("shiftleft(bigint(1), low)")
    earlier = F.when(F.col("first") < F.col("least"), bit).otherwise(F.lit(0).cast("bigint"))
    return windows.join(first, "whole").select("context", "least", bit.alias("fits"), earlier.alias("earlier"))
