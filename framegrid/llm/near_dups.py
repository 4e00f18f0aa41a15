"""Near-duplicates by DartMinHash signatures, banded joining and an exact check.

Each distinct run of five words is an element. Darts of an element are a Poisson process in rank, seeded by the element
alone; a text throws those up to a rank that gives about t (ln t + 2) darts in all, and each coordinate keeps its earliest
dart. Texts that agree in all coordinates of a band are candidates; Jaccard similarity over whole shingle sets decides.

Texts with equal shingle sets are one representative from the start. Within a bucket of representatives, each is paired
with the bucket's least member and with its hub, the member with the most bucket mates over all bands, so copies of one
original meet through it. In buckets that still hold several classes, every pair across classes is then settled: parity
bitmaps of 4,096 bits give a bound on the similarity that no pair at the limit or above fails, and what passes the bound is compared
exactly, first a spanning forest of the nearest pairs, then all that is left between classes. Large buckets are dealt out
by pairs of blocks.

Weights are 1: the similarity that counts is that of sets. ``counted`` gives a shingle the weight of its occurrences, each
with a region of its own, and ``signature`` takes any weights.

Cases: texts of one to four words are one element; a text without words equals only equal texts; null texts equal only
rows with the same doc_id; null ids are allowed and sort last; repeated rows share a class; an empty table gives an empty
result; further columns, whatever their names, are not read by ``classes`` and kept by ``distinct``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import row_key, saved, unused, utf8
from framegrid.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 48, 8
#: Members of a bucket that are held against each other in one task.
BLOCK = 4096
#: Bits of a parity bitmap, and of the folded one that is looked at first.
PARITY_BITS, FOLDED_BITS = 4096, 1024
_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
#: Hashes of words that a task keeps at hand.
CACHE_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles; ``counted``, those of each of a shingle's occurrences."""

    def __init__(self, size: int = SHINGLE, counted: bool = False) -> None:
        self.size, self.counted = size, counted
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        h = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            if (x := known.get(w)) is None:
                x = known[w] = digest(w)
            h[i] = x
        n = min(self.size, len(words))
        with np.errstate(over="ignore"):
            out = np.full(len(words) - n + 1, n, np.uint64)
            for i in range(n):
                out = mix(out * _GOLDEN + h[i : len(words) - n + 1 + i])
        if not self.counted:
            return np.unique(out)
        out, times = np.unique(out, return_counts=True)
        return np.unique(cells(out, times.astype(float))[0])


def cells(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit regions of weighted elements, with the part of each that its weight covers; the first is the element's own."""
    many = np.ceil(weights).astype(np.int64)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    whole = np.repeat(elements, many)
    with np.errstate(over="ignore"):
        further = mix(whole ^ mix(nth.astype(np.uint64) * _GOLDEN))
    return np.where(nth == 0, whole, further), np.minimum(1.0, np.repeat(weights, many) - nth)


def signature(elements: np.ndarray, t: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The id of the earliest dart in each of t coordinates; without weights, all are 1.

    Darts fall on an element's region, weight by rank, as a Poisson process; those beyond its weight miss.
    """
    part = np.ones(len(elements))
    total = float(len(elements))
    if weights is not None:
        elements, part = cells(elements, weights)
        total = float(part.sum())
    limit = t * (np.log(t) + 2) / total
    while True:
        wide = int(limit + 3 * np.sqrt(limit) + 3)
        ids, ranks, left, least, base, at = [], [], elements, part, np.zeros(len(elements)), 0
        while len(left):
            with np.errstate(over="ignore"):
                dart = mix(left[:, None] + np.arange(at + 1, at + wide + 1, dtype=np.uint64) * _GOLDEN)
            gap = -np.log1p(-(mix(dart) >> _U(11)).astype(np.float64) * 2.0**-53)
            rank = np.cumsum(gap, axis=1) + base[:, None]
            in_reach = rank <= limit
            if weights is not None:
                in_reach &= (mix(dart ^ _GOLDEN) >> _U(11)).astype(np.float64) * 2.0**-53 <= least[:, None]
            ids.append(dart[in_reach])
            ranks.append(rank[in_reach])
            more = rank[:, -1] <= limit
            left, least, base, at = left[more], least[more], rank[more, -1], at + wide
        dart, rank = np.concatenate(ids), np.concatenate(ranks)
        coordinate = (dart % _U(t)).astype(np.int64)
        first = np.full(t, np.inf)
        np.minimum.at(first, coordinate, rank)
        if np.isfinite(first).all():
            out = np.empty(t, np.uint64)
            won = rank == first[coordinate]
            out[coordinate[won]] = dart[won]
            return out
        limit *= 2


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN
        for column in sig.reshape(bands, rows).T:
            out = mix(out * _GOLDEN + column)
    return out.view(np.int64)


def parity(elements: np.ndarray) -> bytes:
    """For each slot whether an odd number of elements falls in it: two sets differ in at least as many elements as bits."""
    odd = np.bincount((elements % _U(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _sign(bands: int, rows: int, shingle: int, counted: bool):
    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle, counted)
        for batch in it:
            keys, counts, found, odd = [], [], [], []
            for row, text in zip(batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                s = shingles(text or b"")
                counts.append(len(s))
                if len(s):
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    found.append(band_keys(signature(s, bands * rows), bands, rows))
                    odd.append(parity(s))
                else:
                    keys.append(row if text is None else xxhash.xxh3_128_digest(b"no words:" + text))
                    found.append(None)
                    odd.append(None)
            columns = [pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "row", "set_key", "n_shingles", "bands", "parity"])

    return sign


def _similar(least: float, shingle: int, counted: bool):
    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle, counted)
        last: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
        for batch in it:
            keep, how = [], []
            texts = [utf8(batch.column(i)) for i in (2, 3)]
            for i, (a, b) in enumerate(zip(*texts, strict=True)):
                if last[0] != a:
                    last = (a, shingles(a))
                x, y = last[1], shingles(b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= least * (len(x) + len(y) - both):
                    keep.append(i)
                    how.append(both / (len(x) + len(y) - both))
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(how, pa.float64())], ["u", "v", "similarity"])

    return check


def possible(members: pd.DataFrame, similarity: float, forest: bool) -> list[tuple[int, int]]:
    """Pairs of members (set_key, root, n_shingles, parity, part) of different roots, and of different parts where there are two, that may be similar.

    Sets of a and b elements with d in one of them alone are similar at s if d <= (a + b) (1 - s) / (1 + s).
    """
    bits = np.frombuffer(b"".join(members["parity"]), np.uint64).reshape(len(members), -1)
    # slots that are folded onto each other have the parity of their sum, so the fold gives a bound, too, though a lower one
    folded = np.bitwise_xor.reduce(bits.reshape(len(members), -1, FOLDED_BITS // 64), axis=1)
    size = members["n_shingles"].to_numpy()
    root = members["root"].map(bytes).astype("category").cat.codes.to_numpy()
    part = members["part"].to_numpy()
    largest = np.bincount(root).argmax()
    share = (1 - similarity) / (1 + similarity) + 1e-9
    at, to, off = [], [], []
    for i in np.flatnonzero(root != largest):
        mates = (root != root[i]) & ((root == largest) | (np.arange(len(root)) > i))
        if part.min() != part.max():
            mates &= part != part[i]
        mates = np.flatnonzero(mates)
        both = size[mates] + size[i]
        apart = np.maximum(np.bitwise_count(folded[mates] ^ folded[i]).sum(axis=1, dtype=np.int64), np.abs(size[mates] - size[i]))
        near = np.flatnonzero(apart <= both * share)
        if not len(near):
            continue
        mates, both = mates[near], both[near]
        apart = np.maximum(np.bitwise_count(bits[mates] ^ bits[i]).sum(axis=1, dtype=np.int64), apart[near])
        near = apart <= both * share
        at.append(np.full(near.sum(), i))
        to.append(mates[near])
        off.append(apart[near] / both[near])
    if not at:
        return []
    at, to, off = np.concatenate(at), np.concatenate(to), np.concatenate(off)
    if not forest:
        return list(zip(at.tolist(), to.tolist(), strict=True))
    parent = list(range(int(root.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for k in np.argsort(off, kind="stable"):
        x, y = find(root[at[k]]), find(root[to[k]])
        if x != y:
            parent[x] = y
            out.append((int(at[k]), int(to[k])))
    return out


def _across(similarity: float, forest: bool):
    def across(members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("set_key", ignore_index=True)
        key = members["set_key"]
        pairs = possible(members, similarity, forest)
        return pd.DataFrame({"bucket": members["bucket"].iloc[0], "set_key": [key[i] for i, _ in pairs], "to": [key[j] for _, j in pairs]}, columns=["bucket", "set_key", "to"])

    return across


def links(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, counted: bool = False, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with their set_key, verified pairs of set_keys); ``counted``, a shingle weighs as often as it occurs."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))
    id_type = dict(keyed.dtypes)["doc_id"]
    signed = saved(
        keyed.mapInArrow(_sign(bands, rows, shingle, counted), f"doc_id {id_type}, row binary, set_key binary, n_shingles long, bands array<bigint>, parity binary"), "signed"
    )
    one = [F.min("row").alias("row"), *(F.first(c).alias(c) for c in ("bands", "n_shingles", "parity"))]
    sets = saved(signed.where("bands is not null").groupBy("set_key").agg(*one), "sets")
    members = sets.select("set_key", F.explode("bands").alias("bucket"))
    shared = saved(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("set_key").alias("least")).where("n > 1"), "shared")
    mates = saved(members.join(shared, "bucket"), "mates")
    degree = mates.groupBy("set_key").agg(F.sum("n").alias("degree"))
    most = F.max_by("set_key", F.struct("degree", "set_key")).alias("hub")
    first = saved(mates.join(degree, "set_key").groupBy("bucket").agg(most), "hubs")
    starred = mates.join(first, "bucket").select("set_key", F.explode(F.array_distinct(F.array("least", "hub"))).alias("to"))
    tried = saved(_pairs(starred), "tried")
    found = _verified(tried, keyed, sets, similarity, shingle, counted)

    # two members have met as least member or hub; larger buckets may hold classes that have not met
    open_ = mates.where("n > 2").select("bucket", "set_key", "n")
    for forest in (True, False):
        root = saved(components(found), "roots").withColumnRenamed("node", "set_key")
        mine = saved(open_.join(root, "set_key", "left").withColumn("root", F.coalesce("root", "set_key")), "rooted")
        mixed = mine.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("bucket")
        across = mine.join(mixed, "bucket").join(sets.select("set_key", "n_shingles", "parity"), "set_key")
        parts = F.ceil(F.col("n") / BLOCK).cast("int")
        dealt = across.withColumn("part", F.pmod(F.xxhash64("set_key"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        blocks = dealt.select("bucket", "set_key", "root", "n_shingles", "parity", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
        near = saved(blocks.groupBy("bucket", "a", "b").applyInPandas(_across(similarity, forest), "bucket long, set_key binary, to binary"), "near")
        fresh = saved(_pairs(near).join(tried, ["u", "v"], "left_anti"), "fresh")
        found = found.unionByName(_verified(fresh, keyed, sets, similarity, shingle, counted))
        tried = tried.unionByName(fresh)
        open_ = open_.join(near.select("bucket").distinct(), "bucket", "left_semi")  # the others' pairs are all settled
    return signed.drop("bands", "parity"), found


def _pairs(starred: DataFrame) -> DataFrame:
    return starred.where("set_key != to").select(F.greatest("set_key", "to").alias("u"), F.least("set_key", "to").alias("v")).distinct()


def _verified(pairs: DataFrame, keyed: DataFrame, sets: DataFrame, similarity: float, shingle: int, counted: bool) -> DataFrame:
    """The pairs whose texts are similar enough; only texts of pairs are moved."""
    pairs = saved(pairs, "candidates")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("set_key")).distinct()
    needed = ends.join(sets.select("set_key", "row"), "set_key")
    texts = saved(keyed.select("row", "text").join(needed, "row").groupBy("set_key").agg(F.first("text").alias("text")), "texts")
    sides = pairs.join(texts.select(F.col("set_key").alias("u"), F.col("text").alias("u_text")), "u").join(
        texts.select(F.col("set_key").alias("v"), F.col("text").alias("v_text")), "v"
    )
    checked = sides.select("u", "v", "v_text", "u_text").mapInArrow(_similar(similarity, shingle, counted), "u binary, v binary, similarity double")
    return saved(checked, "links")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, counted: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, class_id (the class's least doc_id), n_links (of the row's shingle set, among the pairs that were compared) and keeper, for each row."""
    signed, linked = links(docs, similarity, bands, rows, shingle, counted, doc_id, text)
    root = components(linked)
    count = linked.select(F.explode(F.array("u", "v")).alias("set_key")).groupBy("set_key").agg(F.count("*").alias("n_links"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")))
    sets = signed.groupBy("set_key").agg(first.alias("first"))
    rooted = saved(
        sets.join(root.withColumnRenamed("node", "set_key"), "set_key", "left")
        .join(count, "set_key", "left")
        .select("set_key", "first", F.coalesce("root", "set_key").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")),
        "rooted",
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(heads, "root").select("set_key", "n_links", "head")
    return signed.join(named, "set_key").select(
        "doc_id", "row", F.col("head.doc_id").alias("class_id"), "n_links", (F.col("row") == F.col("head.row")).alias("keeper")
    )


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each class, one with the least doc_id, with its columns; of several, the one that sorts first as JSON."""
    key, row = unused(docs, "key"), unused(docs, "row")
    keepers = classes(docs, doc_id=doc_id, text=text, **options).where("keeper").select(F.col("row").alias(key)).distinct()
    whole = docs.select(row_key(F.col(doc_id), F.col(text)).alias(key), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row))
    others = F.to_json(F.struct(F.lit(0), *(F.col(row)[c].alias(c) for c in docs.columns if c not in (doc_id, text))))
    once = whole.groupBy(key).agg(F.min_by(row, others).alias(row))  # in part before the shuffle, so that a repeated row is not gathered
    return once.join(keepers, key, "left_semi").select(*(F.col(row)[c].alias(c) for c in docs.columns))
