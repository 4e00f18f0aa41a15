"""Benchmark decontamination by the q-gram lemma, verified by banded alignment.

A text holds an item of m characters with at most k edits only if some band of 2k + 1 diagonals (text position less item
position) holds m + 1 - (k + 1) q shared q-grams. Overlapping bands, each two such widths, count them; every band that
reaches the bound is aligned inside the band, and the fewest edits count. Items too short for the bound with q-grams of
the usual length have shorter ones, m / (k + 1) characters, so k is the same share of every item. Both sides are
lower-cased with white space runs as one space.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters. One block is looked for in place, without a
shuffle. Of several, each is looked for in a pass of its own that stores the texts that hold something of it, so a task
holds one index at a time; the findings are then joined to the rows by the text's digest.

Cases: null and empty texts and items match nothing; items shorter than q that allow no edit must occur exactly; repeated
items all report; repeated rows report alike; an empty benchmark or table finds nothing; the input's columns stay as they
are, but for one with the result's name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import digest, saved, unused

BLOCK_CHARS = 2_000_000
#: Characters of text that are scanned in one step.
STEP_CHARS = 4_000_000
SCHEMA = "struct<items: array<bigint>, edits: array<int>>"
_BASE = np.uint32(0x01000193)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def qgrams(symbols: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of each q-gram; equal q-grams hash alike."""
    n = len(symbols) - q + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    power, base, length, done = symbols.astype(np.uint32), _BASE, 1, 0
    out = np.zeros(n, np.uint32)
    left = q
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                out = out * base + power[done : done + n]
                done += length
            left >>= 1
            if left:
                power = power[:-length] * base + power[length:]
                base, length = base * base, 2 * length
        out ^= out >> np.uint32(15)
        return out * np.uint32(0x9E3779B1)


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> int:
    """Fewest edits between the item and any part of the text, on diagonals low to high; any number over k if over k."""
    width = high - low + 1
    t = np.arange(low, high + 1)
    far = len(item) + 1
    row = np.where((t >= 0) & (t <= len(text)), 0, far)
    padded = np.concatenate([np.zeros(max(0, -low), np.int64), text.astype(np.int64) + 1, np.zeros(max(0, high + len(item) - len(text)) + 1, np.int64)])
    shift, steps = max(0, -low), np.arange(width)
    for j in range(1, len(item) + 1):
        at = padded[low + shift + j - 1 : low + shift + j - 1 + width]
        best = np.minimum(row + (at != int(item[j - 1]) + 1), np.append(row[1:], far) + 1)
        end = t + j
        best[(end < 0) | (end > len(text))] = far
        row = np.minimum.accumulate(best - steps) + steps
        if row.min() > k:
            return k + 1
    return int(row.min())


@dataclass
class Grams:
    """The q-grams of those items of a block that have the same q."""

    q: int
    items: list[int]
    codes: list[np.ndarray]
    least: int  # the smallest bound of these items

    def __post_init__(self) -> None:
        grams = [qgrams(fold(c), self.q) for c in self.codes]
        item = np.repeat(np.array(self.items, np.int32), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams])
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        self.grams, start = np.unique(every[order], return_index=True)
        self.start = np.append(start, len(every)).astype(np.int32)
        self.item, self.at = item[order], at[order]
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(self.grams)) * 24))))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.grams >> np.uint32(32 - self.bits)] = True

    def hits(self, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text's q-grams that items have too, and which."""
        hashes = qgrams(fold(every), self.q)
        hit = np.flatnonzero(self.seen[hashes >> np.uint32(32 - self.bits)])
        gram = np.minimum(np.searchsorted(self.grams, hashes[hit]), len(self.grams) - 1)
        real = self.grams[gram] == hashes[hit]
        return hit[real], gram[real]


def fold(c: np.ndarray) -> np.ndarray:
    return (c ^ (c >> 8)) & 0xFF


@dataclass
class Index:
    """A block of items with their q-grams."""

    ids: list[int]
    texts: list[str]
    q: int
    error: float

    def __post_init__(self) -> None:
        self.codes = [codes(t) for t in self.texts]
        self.m = m = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.k = k = (self.error * m).astype(np.int64)
        self.step = 2 * k + 1
        q = np.minimum(self.q, m // (k + 1))
        self.bound = m + 1 - (k + 1) * q
        self.short = [i for i in range(len(m)) if 0 < m[i] < self.q and not k[i]]
        self.parts = []
        for size in np.unique(q[(m >= self.q) | (k > 0)]).tolist():
            items = [i for i in range(len(m)) if q[i] == size and (m[i] >= self.q or k[i])]
            self.parts.append(Grams(size, items, [self.codes[i] for i in items], int(self.bound[items].min())))

    def find(self, texts: list[str]) -> list[dict[int, int]]:
        """For each text, the found items (by place in the index) with their edits."""
        found: list[dict[int, int]] = [{} for _ in texts]
        for i in self.short:
            for d, t in enumerate(texts):
                if self.texts[i] in t:
                    found[d][i] = 0
        if not self.parts or not texts:
            return found
        every = codes("\0".join(texts))
        lengths = np.array([len(t) + 1 for t in texts])
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        for part in self.parts:
            hit, gram = part.hits(every)
            doc = np.searchsorted(starts, hit, side="right") - 1
            enough = np.bincount(doc, minlength=len(texts)) >= part.least
            hit, gram, doc = hit[enough[doc]], gram[enough[doc]], doc[enough[doc]]
            for d in np.unique(doc):
                here = slice(*np.searchsorted(doc, [d, d + 1]))
                self._bands(part, every[starts[d] : starts[d] + lengths[d] - 1], hit[here] - starts[d], gram[here], texts[d], found[d])
        return found

    def _bands(self, part: Grams, text: np.ndarray, hit: np.ndarray, gram: np.ndarray, plain: str, found: dict[int, int]) -> None:
        many = part.start[gram + 1] - part.start[gram]
        post = np.repeat(part.start[gram] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item = part.item[post].astype(np.int64)
        at = part.at[post].astype(np.int64)
        band = (np.repeat(hit, many) - at + self.m[item]) // self.step[item]
        wide = 1 << 40
        pairs = np.unique(np.stack([item * wide + band, at]), axis=1)[0]  # an item's q-gram counts once in a band
        keys, counts = np.unique(pairs, return_counts=True)
        later = keys % wide > 0
        both = np.concatenate([keys, keys[later] - 1])  # band b covers the steps b and b + 1
        keys, place = np.unique(both, return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([counts, counts[later]]))
        for key in keys[counts >= self.bound[keys // wide]]:
            i, b = int(key // wide), int(key % wide)
            least = found.get(i, int(self.k[i]) + 1)
            if not least:
                continue
            k, m = int(self.k[i]), int(self.m[i])
            low = b * int(self.step[i]) - m
            high = low + 2 * int(self.step[i]) - 1
            left = max(0, low - k)
            if self.texts[i] in plain[left : high + m + k + 1]:
                found[i] = 0
            elif k:
                edits = banded(self.codes[i], text[left : high + m + k + 1], low - k - left, high + k - left, least - 1)
                if edits < least:
                    found[i] = edits


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """Blocks of items, dealt by a hash; each is collected alone when its index is built."""
    chars = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    n = -(-chars // (BLOCK_CHARS // 2)) or 1
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        yield [(r["id"], normal(r["text"])) for r in part.collect()]


def scan(text: Column, index: Index) -> Column:
    """The items of one block that each text holds."""
    ids = index.ids

    @F.arrow_udf(SCHEMA)
    def look(texts: pa.Array) -> pa.Array:
        out: list[dict[int, int]] = []
        held: list[str] = []
        size = 0
        for t in texts.to_pylist():
            held.append(normal(t))
            size += len(held[-1])
            if size >= STEP_CHARS:
                out += index.find(held)
                held, size = [], 0
        out += index.find(held)
        rows = [{"items": [ids[i] for i in sorted(f)], "edits": [f[i] for i in sorted(f)]} for f in out]
        return pa.array(rows, pa.struct([("items", pa.list_(pa.int64())), ("edits", pa.list_(pa.int32()))]))

    return look.asNondeterministic()(text)  # so that a filter on the findings does not look again


def _indexes(benchmark: DataFrame, q: int, error: float, item_id: str, item_text: str) -> Iterator[Index]:
    for rows in blocks(benchmark, item_id, item_text):
        rows = sorted((r for r in rows if r[1]), key=lambda r: (r[0] is None, r[0], r[1]))
        yield Index([r[0] for r in rows], [r[1] for r in rows], q, error)


def flag(docs: DataFrame, benchmark: DataFrame, into: str = "leak", q: int = 10, error: float = 0.08, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with the struct ``into`` of all items that each text holds, in order of ids, and their edits."""
    indexes = _indexes(benchmark, q, error, item_id, item_text)
    index, other = next(indexes), next(indexes, None)
    if other is None:
        return docs.withColumn(into, scan(F.col(text), index))
    found = None
    for index in chain((index, other), indexes):
        texts = docs.select(digest(F.col(text)).alias("key"), scan(F.col(text), index).alias("leak")).where(F.size("leak.items") > 0)
        hits = saved(texts.dropDuplicates(["key"]), "leaks")
        found = hits if found is None else found.unionByName(hits)
    one = found.select("key", F.explode(F.arrays_zip("leak.items", "leak.edits")).alias("at"))
    inside = F.struct(F.col("at.items").isNull().alias("none"), F.col("at.items").alias("item"), F.col("at.edits").alias("edits"))
    named = one.groupBy("key").agg(F.array_sort(F.collect_list(inside)).alias("at"))  # at most the benchmark's items for each text
    key = unused(docs, "key")
    joined = docs.withColumn(key, digest(F.col(text))).join(named.select(F.col("key").alias(key), F.col("at").alias(f"{key}_at")), key, "left")
    leak = F.struct(
        F.coalesce(F.col(f"{key}_at")["item"], F.array().cast("array<bigint>")).alias("items"), F.coalesce(F.col(f"{key}_at")["edits"], F.array().cast("array<int>")).alias("edits")
    )
    return joined.withColumn(into, leak).select(*dict.fromkeys([*docs.columns, into]))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    into = unused(docs, "leak")
    return flag(docs, benchmark, into, **options).where(F.size(F.col(into)["items"]) == 0).select(*docs.columns)
