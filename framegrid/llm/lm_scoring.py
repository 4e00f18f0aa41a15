"""LM scoring by logistic mixing of hashed-context bit predictors.

A text is coded token by token, a token bit by bit: the frequent training words, an escape and the end have Huffman
codes, and after an escape the word's bytes follow, each in a Huffman code of its own, with a closing byte. Every bit is
predicted. One predictor knows the bit's place in the code alone; the others hash a context of the running text with that
place into tables of counts: for words the last frequent word and the word before; for bytes the last two with the last
frequent word, the last four (across word ends), and the whole word so far. Stretched
predictions are joined by weights that a gate selects (the longest context seen, how often, and the bit's place); the
weights are learned from all bits of all training texts, a text's own counts left out, and a probability map then refines
the mixed prediction. For that, one pass counts the bits by gate and by what the predictors say, on a scale of 32 values
each; these counts have a bound, and weights and map follow from them. So known and new words alike get their probability from the mixed bits, over all token sequences it sums to
one, and the order of words counts.

Counts cover all training texts and slots grow with them, 2 ** MOST_BITS for each predictor at most: what a task can
hold. Beyond that, contexts share slots, as hashed contexts do; the weights are learned on the tables as they are. Counts
are whole numbers, and costs are summed as whole numbers of 2 ** -24, so a score depends neither on
partitions nor on the order of rows.

The base score needs the exact count of every word: words with a code have it in the code book, the others are joined,
once for each block of texts.

Cases: a null text is empty and holds just the end; null ids count as empty text for the split; words of any length are
spelled whole; texts are read whole, long ones in segments that overlap by all that a context can see; without training
texts the tables are empty and all bytes alike; repeated rows are scored alike and learned from each; an empty table
gives an empty result; further columns are not read. Ids are whole numbers; other text as an id is an error of the cast.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from framegrid.llm.common import row_key, saved, utf8

END = b"\n"
CLOSE = 0x20
ESCAPE, STOP = 0, 1  # symbols of the code for words; coded words follow
#: Most words with a code of their own, the least count and the most bytes of such a word; so the code book has a bound.
CODED_WORDS, LEAST_COUNT, CODED_BYTES = 262_144, 8, 64
#: The most frequent words, which are remembered over what follows them, for so many tokens.
FREQUENT, REACH = 64, 64
PREDICTORS = 3
#: Slots of a predictor: 2 ** bits, some four for each training token, within these.
LEAST_BITS, MOST_BITS = 15, 22
CHUNK_SLOTS = 1 << 14
#: Levels of a code whose slots lie side by side.
GROUP = 3
#: Bits of text that are worked on together: small enough for the processor's cache.
STEP_BITS = 16_384
#: Of pairs of words, so many.
PAIRS = 1024
#: Bits from which a text's own are counted in slices, so that memory follows the slice.
LONG_BITS = 1 << 20
#: Tokens of a segment, bytes that are encoded together, bytes of a block of texts.
SEGMENT, BATCH_BYTES, BLOCK_BYTES = 100_000, 600_000, 64_000_000
#: Bytes of text for which one table of counts is kept while counting.
COUNT_BYTES = 128_000_000
DELTA = 0.05
#: Newton's steps at most, while the weights are learned.
NEWTON_STEPS = 30
PLACES = 5
LEVELS = 3 * PREDICTORS + 1
GATES = PLACES * LEVELS
BINS, MAP_BINS, REACH_LOG = 385, 33, 12.0
FIXED, EXACT = float(1 << 24), float(1 << 32)
_MUL = np.uint32(0x9E3779B1)
_MIX = np.uint32(0x85EBCA6B)
_BASE = 0x9E3779B97F4A7C15
_PAD = b"\0" * 8
#: Counts on a log scale; a pair of them is packed with that of 0 in the low byte.
_N = 2 ** (np.arange(256) / 10) - 1
#: What a slot says, in a byte: the prediction, finer near even odds (low six bits), and how much stands behind it.
VALUES = np.sign(np.arange(64) - 32) * (np.exp(np.abs(np.arange(64) - 32) / 10) - 1) / 2
_SEEN = (_N[:, None] + _N[None, :]).ravel()
_STRETCH = np.log((_N[:, None] + DELTA) / (_N[None, :] + DELTA)).ravel()
SAYS = (np.searchsorted((VALUES[1:] + VALUES[:-1]) / 2, _STRETCH) | np.where(_SEEN == 0, 0, 1 + (_SEEN > 1.5) + (_SEEN > 4.5)) << 6).astype(np.uint8)
INPUT = np.tile(VALUES, 4).astype(np.float32)
#: Fields of a step of a code: the bit, the node's place in its group, its kind of place for the gate, its own prediction, its group's hash.
LOCAL_AT, PLACE_AT, PRIOR_AT, HASH_AT = 1, 4, 8, 32
PRIOR_UNITS = 1024
#: What a packed count is on that scale when so many of it are left out.
LESS = np.minimum(255, np.rint(np.log2(1 + np.maximum(_N[:, None] - np.arange(256), 0)) * 10)).astype(np.uint16).ravel()
LESS_ONE = LESS << np.uint16(8)
#: Cells of the counts that weights are learned from: place and level, 32 values a predictor, 32 (for bytes 16) of the place's own prediction, the bit.
WORD_CELLS, BYTE_CELLS = 3 * LEVELS << 16, 2 * LEVELS << 20
TALLY_CHUNK = 1 << 16
#: Predictions in pairs; even odds, which a slot without counts gives, stay alone.
COARSE = np.tile(16 + np.sign(np.arange(64) - 32) * np.minimum(15, (np.abs(np.arange(64) - 32) + 1) // 2), 4)
#: What a slot says with its prediction in pairs (low five bits), and how much stands behind it.
TOLD = (COARSE[SAYS] | SAYS >> 6 << 5).astype(np.uint8)
#: The value from 0 on that is nearest to a place's own prediction.
PRIOR_BIN = np.searchsorted((VALUES[33:] + VALUES[32:-1]) / 2, np.arange(1 << 16).astype(np.uint16).view(np.int16) / PRIOR_UNITS).astype(np.uint8)


def tokens(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased words, then the end."""
    return [*(text or b"").lower().split(), END]


class Code:
    """A Huffman code: symbol s takes the steps start[s] to start[s] + length[s], each packed with all that is known of it.

    It is sent to tasks as its tree: what stands above each symbol and node, on which side, and each node's fields. The steps are some ten times that.
    """

    def __init__(self, above: np.ndarray, side: np.ndarray, packed: np.ndarray) -> None:
        self.above, self.side, self.packed = above, side, packed
        n, top = len(packed) + 1, len(above) - 1
        self.length, at = np.zeros(n, np.int64), np.arange(n)
        while (below := at < top).any():  # from the symbols up, all at once
            self.length += below
            at = np.where(below, above[np.minimum(at, top - 1)], top)
        self.start = np.cumsum(self.length) - self.length
        self.steps = np.empty(int(self.length.sum()), np.uint64)
        at, place = np.arange(n), self.start + self.length - 1
        while len(at):
            self.steps[place] = packed[above[at] - n] | side[at]
            at, place = above[at], place - 1
            below = at != top
            at, place = at[below], place[below]

    def __reduce__(self) -> tuple:
        return Code, (self.above, self.side, self.packed)

    @staticmethod
    def of(counts: list[int], salt: int, places: list[int]) -> Code:
        """``places`` are the depths at which a new kind of place begins, of which the first is ``salt``."""
        n = len(counts)
        heap = [(c, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        above, side, zeros, ones = [0] * (2 * n - 1), [0] * (2 * n - 1), [], []
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            new = n + len(zeros)
            above[i], above[j], side[j] = new, new, 1
            zeros.append(a)
            ones.append(b)
            heapq.heappush(heap, (a + b, new))
        top = 2 * n - 2
        depth, group, local = ([0] * (n - 1) for _ in range(3))
        for at in range(top, n - 1, -1):  # from the top down
            node = at - n
            if at < top:
                up = above[at] - n
                depth[node] = depth[up] + 1
            if depth[node] % GROUP == 0:
                group[node], local[node] = node, 1
            else:
                group[node], local[node] = group[up], 2 * local[up] + side[at]
        prior = np.rint(PRIOR_UNITS * np.log((np.array(ones) + 0.4) / (np.array(zeros) + 0.4))).astype(np.int16).view(np.uint16)
        hashes = _hash32(np.array(group, np.uint64) + np.uint64((salt + 1) << 32))
        place = salt + np.digitize(depth, places)
        packed = sum(np.asarray(x).astype(np.uint64) << np.uint64(at) for x, at in ((local, LOCAL_AT), (place, PLACE_AT), (prior, PRIOR_AT), (hashes, HASH_AT)))
        return Code(np.array(above, np.int32), np.array(side, np.uint8), packed)


def _hash32(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return (x ^ (x >> np.uint64(33))).astype(np.uint32)


class Book:
    """The coded words with their counts, the codes of words and bytes, and what each node of both adds to a context."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, escaped: int, spelled: list[int]) -> None:
        self.index = {w: i + 2 for i, w in enumerate(words)} | {END: STOP}
        self.counts = np.array([0, ends, *counts], np.int64)
        self.words = Code.of([escaped + 1, max(ends, 1), *counts], 0, [1, 5])
        self.bytes = Code.of([c + 1 for c in spelled], 3, [2])
        self.hashes = _hash32(np.arange(len(words) + 2, dtype=np.uint64) + np.uint64(1))
        #: Of no frequent word, then of each.
        self.frequent = np.concatenate([np.array([7], np.uint32), self.hashes[STOP + 1 : STOP + 1 + FREQUENT]])
        self._short()

    def __reduce__(self) -> tuple:
        return _book, ({k: v for k, v in vars(self).items() if k not in ("keys", "symbols")},)

    def _short(self) -> None:
        """A hash table of the words of up to 7 bytes: their keys, and their symbols. What is not free is sought in the next slot."""
        words = [w for w in self.index if len(w) < 8]
        key = np.array([int.from_bytes(w, "little") | len(w) << 56 for w in words], np.uint64)
        symbol = np.array([self.index[w] for w in words], np.int64)
        size = 1 << (4 * len(words)).bit_length()
        self.keys, self.symbols = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        at = _spots(key, size)
        while len(key):
            free = self.keys[at] == 0
            self.keys[at[free]] = key[free]
            put = self.keys[at] == key
            self.symbols[at[put]] = symbol[put]
            key, symbol, at = key[~put], symbol[~put], (at[~put] + 1) & (size - 1)

    def find(self, words: list[bytes], raw: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The symbol of each word, which is also given by its place in ``raw``; 8 bytes at least stand from each on."""
        out = np.full(len(words), ESCAPE, np.int64)
        long = np.flatnonzero(lengths > 7)
        out[long] = np.fromiter(map(self.index.get, map(words.__getitem__, long.tolist()), repeat(ESCAPE)), np.int64, len(long))
        eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
        for lo in range(0, len(words), STEP_BITS):
            here = starts[lo : lo + STEP_BITS]
            size = np.minimum(lengths[lo : lo + STEP_BITS], 8).astype(np.uint64)
            key = eight[here[0] : here[-1] + 1].copy().take(here - here[0], mode="wrap")
            key &= (np.uint64(1) << (size << np.uint64(3))) - np.uint64(1)
            key |= size << np.uint64(56)
            key[size > 7] = 0  # found above
            at, short = _spots(key, len(self.keys)), None
            while len(key):
                there = self.keys.take(at, mode="wrap")
                hit = np.flatnonzero((there == key) & (key > 0))
                out[lo + (hit if short is None else short[hit])] = self.symbols.take(at[hit], mode="wrap")
                left = np.flatnonzero((there != key) & (there > 0) & (key > 0))
                short, key, at = left if short is None else short[left], key[left], (at[left] + 1) & (len(self.keys) - 1)
        return out


def _book(state: dict) -> Book:
    book = Book.__new__(Book)
    vars(book).update(state)
    book._short()
    return book


def _spots(key: np.ndarray, size: int) -> np.ndarray:
    """Where keys are sought first in a table of 2 ** n slots."""
    with np.errstate(over="ignore"):
        h = (key ^ key >> np.uint64(29)) * np.uint64(_BASE)
    return (h >> np.uint64(65 - size.bit_length())).astype(np.intp)


@dataclass
class Encoded:
    """Symbols of texts with the contexts of the predictors and the text of each; words first, spelled bytes after."""

    word: np.ndarray
    word_doc: np.ndarray
    word_contexts: list[np.ndarray]
    byte: np.ndarray
    byte_doc: np.ndarray
    byte_contexts: list[np.ndarray]
    frequent: np.ndarray  # the number of each word's last frequent word, or 0

    def steps(self, book: Book) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """(texts, their first bits, contexts, steps of the code) in slices."""
        for code, symbols, doc, contexts in ((book.words, self.word, self.word_doc, self.word_contexts), (book.bytes, self.byte, self.byte_doc, self.byte_contexts)):
            length, start = code.length[symbols], code.start[symbols]
            ends = np.cumsum(length)
            at = 0
            while at < len(symbols):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP_BITS)))
                n = length[at:to]
                first = ends[at:to] - n - (ends[at - 1] if at else 0)
                d = doc[at:to]
                new = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                yield d[new], first[new], *_spread(code, start[at:to], n, [c[at:to] for c in contexts])
                at = to


def _spread(code: Code, start: np.ndarray, n: np.ndarray, contexts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Contexts and steps of the code for each bit of symbols, which take n steps from start."""
    ends = np.cumsum(n)
    place = np.arange(int(ends[-1]))
    place += np.repeat(start - (ends - n), n)
    return [np.repeat(c, n) for c in contexts], code.steps.take(place, mode="wrap")


def _both(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a * _MUL + b + np.uint32(salt)) * _MIX
        return (h ^ (h >> np.uint32(15))) * _MUL


def segments(words: list[bytes]) -> list[tuple[list[bytes], int]]:
    """Parts of a text's tokens, each after as many of those before it as a context can see."""
    if len(words) <= SEGMENT:
        return [(words, 0)]
    return [(words[max(0, at - REACH) : at + SEGMENT], min(at, REACH)) for at in range(0, len(words), SEGMENT)]


def encode(texts: list[list[bytes]], book: Book) -> Encoded:
    """Tokens of texts to symbols and contexts; all in arrays, as the whole text is known."""
    every, buffer, skip, doc, sizes = [], [], [], [], []
    for d, words in enumerate(texts):
        for part, seen in segments(words):
            every += part
            buffer += (_PAD, b" ".join(part), b" ")
            skip.append(seen)
            doc.append(d)
            sizes.append(len(part))
    sizes, skip = np.array(sizes, np.int64), np.array(skip, np.int64)
    part = np.repeat(np.arange(len(sizes)), sizes)
    first = (np.cumsum(sizes) - sizes)[part]
    n = len(every)
    at = np.arange(n)
    joined = b"".join([*buffer, _PAD])
    raw = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(raw == CLOSE)  # a space after each token, and none inside
    starts = np.concatenate([[0], ends[:-1] + 1]) + len(_PAD) * (at == first)
    lengths = ends - starts
    raw = raw.astype(np.uint32)
    symbol = book.find(every, joined, starts, lengths)

    spelled = np.flatnonzero(symbol == ESCAPE)
    long = lengths[spelled] + 1
    total = int(long.sum())
    begin = np.cumsum(long) - long
    owner = np.repeat(spelled, long)
    spot = np.arange(total) + np.repeat(starts[spelled] - begin, long)
    with np.errstate(over="ignore"):
        power = np.full(total + 1, np.uint64(_BASE))
        back = np.full(total + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
        power[0] = back[0] = 1
        power, back = np.cumprod(power), np.cumprod(back)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw[spot].astype(np.uint64) + np.uint64(1)) * power[:-1])])
        so_far = _hash32((run[:-1] - np.repeat(run[begin], long)) * np.repeat(back[begin], long))
    hashes = book.hashes[symbol]
    hashes[spelled] = so_far[begin + long - 1]

    often = np.where((symbol > STOP) & (symbol < FREQUENT + 2), at, -1)
    last = np.concatenate([[-1], np.maximum.accumulate(often)[:-1]]) if n else often
    known = (last >= first) & (last >= at - REACH)
    of = np.where(known, symbol[np.maximum(last, 0)] - STOP, 0)
    frequent = book.frequent[of]
    before = np.concatenate([np.zeros(1, np.uint32), hashes[:-1]])
    before[at == first] = 0
    words = [_both(frequent, np.uint32(0), 11), _both(before, np.uint32(0), 17)]
    wanted = at - first >= skip[part]
    doc = np.array(doc, np.int64)[part]

    wanted_bytes = wanted[owner]
    spot, owner = spot[wanted_bytes], owner[wanted_bytes]
    two = raw[spot - 1] | raw[spot - 2] << np.uint32(8)
    four = two | raw[spot - 3] << np.uint32(16) | raw[spot - 4] << np.uint32(24)
    spelled_contexts = [_both(frequent[owner], two, 23), _both(four, np.uint32(0), 31), _both(so_far[wanted_bytes], np.uint32(0), 37)]
    return Encoded(symbol[wanted], doc[wanted], [w[wanted] for w in words], raw[spot].astype(np.int64), doc[owner], spelled_contexts, of[wanted])


def slots(contexts: list[np.ndarray], step: np.ndarray, bits: int) -> list[np.ndarray]:
    """Each predictor's slot; three levels of a code lie side by side, so that they are one place in memory."""
    local, hashes = step.astype(np.uint8) >> np.uint8(LOCAL_AT) & np.uint8((1 << GROUP) - 1), (step >> np.uint64(HASH_AT)).astype(np.uint32)
    found = []
    with np.errstate(over="ignore"):
        for c in contexts:
            slot = c + hashes
            slot *= _MUL
            slot >>= np.uint32(32 - bits + GROUP)
            slot <<= np.uint32(GROUP)
            slot |= local
            found.append(slot.astype(np.intp))
    return found


def _gate(low: np.ndarray) -> np.ndarray:
    """The first gate of a step's place, from the step's low byte."""
    return (low >> np.uint8(PLACE_AT) & np.uint8(7)) * np.uint8(LEVELS)


def _prior(step: np.ndarray) -> np.ndarray:
    """The place's own prediction."""
    prior = (step >> np.uint64(PRIOR_AT)).astype(np.uint16).view(np.int16).astype(np.float32)
    prior *= np.float32(1 / PRIOR_UNITS)
    return prior


def _level(seen: list[np.ndarray]) -> np.ndarray:
    """The longest context that was seen, and how often; from how often each was, 0 to 3."""
    level = seen[0]
    for k, x in enumerate(seen[1:], 1):
        level = np.maximum(level, (x + np.uint8(3 * k)) * (x > 0))
    return level


def plain_weights() -> np.ndarray:
    """One row for each gate: the place's own prediction, then the predictors."""
    return np.tile(np.array([0.5] + [0.2] * PREDICTORS, np.float32), (GATES, 1))


def plain_map() -> np.ndarray:
    return np.tile(1 / (1 + np.exp(-np.linspace(-REACH_LOG, REACH_LOG, MAP_BINS))), (GATES, 1))


def costs(refine: np.ndarray) -> np.ndarray:
    """log10 of each bit's probability, in whole 2 ** -24, by gate, mixed prediction and bit; half of it is the map's."""
    x = np.linspace(-REACH_LOG, REACH_LOG, BINS)
    at = (x + REACH_LOG) * ((MAP_BINS - 1) / (2 * REACH_LOG))
    low = np.minimum(at.astype(np.int64), MAP_BINS - 2)
    part = at - low
    mapped = refine[:, low] * (1 - part) + refine[:, low + 1] * part
    p = np.clip((1 / (1 + np.exp(-x)) + mapped) / 2, 1e-7, 1 - 1e-7)
    return np.rint(np.log10(np.stack([1 - p, p], axis=2)) * FIXED).astype(np.int32)


@dataclass
class Model:
    """What each predictor's slots say, gated weights and the bits' costs."""

    book: Book
    says: np.ndarray
    weights: np.ndarray
    cost: np.ndarray

    @staticmethod
    def of(book: Book, table: np.ndarray, weights: np.ndarray, refine: np.ndarray) -> Model:
        return Model(book, SAYS.take(table), weights.astype(np.float32), costs(refine))

    @property
    def bits(self) -> int:
        return int(self.says.shape[1]).bit_length() - 1

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 of the probability of each text's tokens, in whole 2 ** -24."""
        return self.score_encoded(encode(texts, self.book), len(texts))

    def score_encoded(self, texts: Encoded, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        bits, flat = self.bits, self.cost.ravel()
        own = np.ascontiguousarray(self.weights[:, 0])
        parts = [(w[:, None] * INPUT).ravel() for w in self.weights.T[1:]]  # by gate and what a predictor says
        for docs, firsts, contexts, step in texts.steps(self.book):
            low = step.astype(np.uint8)
            gate, prior = _gate(low), _prior(step)
            said = [self.says[k].take(slot, mode="wrap") for k, slot in enumerate(slots(contexts, step, bits))]
            gate += _level([x >> np.uint8(6) for x in said])
            mixed = own.take(gate)
            mixed *= prior
            row = gate.astype(np.uint16) << np.uint16(8)
            for part, x in zip(parts, said):  # a byte has more predictors than a word
                mixed += part.take(row | x)
            np.clip(mixed, -REACH_LOG, REACH_LOG, out=mixed)
            mixed += np.float32(REACH_LOG)
            mixed *= np.float32((BINS - 1) / (2 * REACH_LOG))
            cell = np.rint(mixed, out=mixed).astype(np.intp)
            cell <<= 1
            cell += gate.astype(np.intp) * (2 * BINS)
            cell += low & np.uint8(1)
            out[docs] += np.add.reduceat(flat.take(cell), firsts, dtype=np.int64)
        return out


def quantised(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.rint(np.log2(1 + counts) * 10)).astype(np.uint8)


def _batched(it: Iterator[pa.RecordBatch], column: int) -> Iterator[list[bytes | None]]:
    held: list[bytes | None] = []
    size = 0
    for batch in it:
        for text in utf8(batch.column(column)):
            held.append(text)
            size += len(text or b"")
            if size >= BATCH_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their words and how often each is met, block by block."""
    sums: Counter = Counter()
    size = 0

    def block() -> Iterator[pa.RecordBatch]:
        words, counts = list(sums), list(sums.values())
        for at in range(0, len(words), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 100_000], pa.binary()), pa.array(counts[at : at + 100_000], pa.int64())], ["word", "n"])
        sums.clear()

    for texts in _batched(it, 0):
        for text in texts:
            sums.update(tokens(text))
            size += len(text or b"")
        if size >= BLOCK_BYTES:
            yield from block()
            size = 0
    yield from block()


def _spelled(coded: frozenset[bytes]):
    def spelled(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (word, c) to the number of each byte in the words without a code, closing bytes included."""
        sums = np.zeros(256, np.int64)
        for batch in it:
            rest = [(w, c) for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w not in coded]
            if rest:
                raw = np.frombuffer(b" ".join(w for w, _ in rest) + b" ", np.uint8)
                times = np.repeat([c for _, c in rest], [len(w) + 1 for w, _ in rest])
                sums += np.bincount(raw, times, 256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(sums)], ["byte", "n"])

    return spelled


class Counts:
    """How often each bit is met in each predictor's slots.

    Words after a frequent word are counted as such, as there are few different ones, and their bits at the end.
    """

    def __init__(self, book: Book, bits: int) -> None:
        self.book, self.bits = book, bits
        self.table = np.zeros((PREDICTORS, 2 << bits), np.uint32)
        self.pairs = np.zeros(len(book.frequent) * len(book.counts), np.uint32)

    def _count(self, k: int, slot: np.ndarray, step: np.ndarray, times: np.ndarray | np.uint32) -> None:
        slot <<= 1
        slot |= step.astype(np.uint8) & np.uint8(1)
        np.add.at(self.table[k], slot, times)

    def add(self, texts: Encoded) -> None:
        np.add.at(self.pairs, texts.frequent * len(self.book.counts) + texts.word, np.uint32(1))
        for _, _, contexts, step in texts.steps(self.book):
            first = 1 if len(contexts) < PREDICTORS else 0  # a word
            for k, slot in enumerate(slots(contexts[first:], step, self.bits), first):
                self._count(k, slot, step, np.uint32(1))

    def done(self) -> np.ndarray:
        book, filled = self.book, np.flatnonzero(self.pairs)
        for lo in range(0, len(filled), PAIRS):
            at = filled[lo : lo + PAIRS]
            of, word = np.divmod(at, len(book.counts))
            n = book.words.length[word]
            contexts, step = _spread(book.words, book.words.start[word], n, [_both(book.frequent[of], np.uint32(0), 11)])
            self._count(0, slots(contexts, step, self.bits)[0], step, np.repeat(self.pairs[at], n))
        self.pairs[:] = 0
        return self.table


def _count(shared, bits: int):
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to the counts of their bits in each predictor's slots, in compressed parts."""
        book = shared.value
        found = Counts(book, bits)
        for texts in _batched(it, 0):
            found.add(encode([tokens(t) for t in texts], book))
        table = found.done()
        pack = zstandard.ZstdCompressor(level=1)
        for k in range(PREDICTORS):
            parts = table[k].reshape(-1, min(2 * CHUNK_SLOTS, 2 << bits))
            full = np.flatnonzero(parts.any(axis=1))
            for c in full:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([pack.compress(parts[c].tobytes())], pa.binary())], ["k", "chunk", "counts"])

    return count


def _sum(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of compressed parts to the packed counts of each; one part is held at a time."""
    unpack = zstandard.ZstdDecompressor()
    name, total = None, np.empty(0, np.int64)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name[0]], pa.int32()), pa.array([name[1]], pa.int32()), pa.array([quantised(total).tobytes()], pa.binary())], ["k", "chunk", "counts"])

    for batch in it:
        for k, c, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            part = np.frombuffer(unpack.decompress(raw), np.uint32)
            if (k, c) != name:
                if name is not None:
                    yield done()
                name, total = (k, c), np.zeros(len(part), np.int64)
            total += part
    if name is not None:
        yield done()


def _aligned(encoded: Encoded, book: Book) -> Iterator[tuple[bool, np.ndarray, Callable[[], Iterator[tuple[list[np.ndarray], np.ndarray]]]]]:
    """(whether bytes, first bits of texts, what gives contexts and steps of the code), texts whole; of a text of over ``LONG_BITS``, in slices."""
    for spelled, code, symbols, doc, contexts in (
        (False, book.words, encoded.word, encoded.word_doc, encoded.word_contexts), (True, book.bytes, encoded.byte, encoded.byte_doc, encoded.byte_contexts),
    ):
        if not len(symbols):
            continue
        length, start = code.length[symbols], code.start[symbols]
        ends = np.concatenate([[0], np.cumsum(length)])
        cuts = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]])
        upto = ends[cuts]

        def slices(lo: int, hi: int, code=code, length=length, start=start, ends=ends, contexts=contexts) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
            while lo < hi:
                to = min(hi, max(lo + 1, int(np.searchsorted(ends, ends[lo] + LONG_BITS, "right")) - 1))
                yield _spread(code, start[lo:to], length[lo:to], [c[lo:to] for c in contexts])
                lo = to

        at = 0
        while at < len(cuts) - 1:
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + STEP_BITS, "right")) - 1)
            yield spelled, upto[at : to + 1] - upto[at], partial(slices, int(cuts[at]), int(cuts[to]))
            at = to


def _told(packed: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What slots say once so many bits are left out: the prediction, in pairs, and how often it was seen."""
    many = np.flatnonzero((zeros > 255) | (ones > 255)) if max(zeros.max(), ones.max()) > 255 else ()
    zero, one = packed << np.uint16(8), packed & np.uint16(0xFF00)
    zero |= zeros.astype(np.uint8)
    one |= ones.astype(np.uint8)
    left = LESS_ONE.take(one)
    left |= LESS.take(zero)
    if len(many):
        few = (quantised(np.maximum(_N[q[many] >> 8] - mine[many], 0)).astype(np.uint16) for q, mine in ((zero, zeros), (one, ones)))
        left[many] = next(few) | next(few) << np.uint16(8)
    return TOLD.take(left)


class Tally:
    """How often each bit is met under each gate, prediction of the predictors and prediction of its place, a text's own bits left out."""

    def __init__(self, book: Book, table: np.ndarray) -> None:
        self.book, self.table = book, table
        self.bits = int(table.shape[1]).bit_length() - 1
        self.counts = np.zeros(WORD_CELLS + BYTE_CELLS, np.uint32)
        self.own: dict[int, np.ndarray] = {}  # of the text at hand: bits of 0 in the low half, of 1 in the high half; by the bytes of a half

    def _count(self, spelled: bool, step: np.ndarray, low: np.ndarray, told: list[np.ndarray]) -> None:
        level = _level([x >> np.uint8(5) for x in told])
        level += _gate(low)
        cell = np.zeros(len(step), np.uint32)
        for x in told:
            cell <<= np.uint32(5)
            cell |= x & np.uint8(31)
        prior = PRIOR_BIN.take((step >> np.uint64(PRIOR_AT)).astype(np.uint16))
        if spelled:
            cell |= (level - np.uint8(3 * LEVELS)).astype(np.uint32) << np.uint32(15)
            cell <<= np.uint32(5)
            cell |= prior >> np.uint8(1) << np.uint8(1)
            cell |= low & np.uint8(1)
            cell += np.uint32(WORD_CELLS)
        else:
            cell |= level.astype(np.uint32) << np.uint32(10)
            cell <<= np.uint32(6)
            cell |= prior << np.uint8(1)
            cell |= low & np.uint8(1)
        np.add.at(self.counts, cell.astype(np.intp), np.uint32(1))

    def _own(self, slot: np.ndarray, low: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each bit's slot, how often its text has 0 and 1 there."""
        half = 2 if firsts[-1] < 1 << 16 else 4
        if half not in self.own:
            self.own[half] = np.zeros(1 << self.bits, f"u{2 * half}")
        own = self.own[half]
        one, found = np.array([1, 1 << 8 * half], own.dtype).take(low & np.uint8(1)), np.empty(len(slot), own.dtype)
        for lo, hi in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            part = slot[lo:hi]
            np.add.at(own, part, one[lo:hi])
            own.take(part, out=found[lo:hi], mode="wrap")
            own[part] = 0
        packed = found.view(f"u{half}")
        return packed[::2], packed[1::2]

    def add(self, texts: list[list[bytes]]) -> None:
        for spelled, firsts, slices in _aligned(encode(texts, self.book), self.book):
            if firsts[-1] <= LONG_BITS:
                for contexts, step in slices():
                    low, places = step.astype(np.uint8), slots(contexts, step, self.bits)
                    self._count(spelled, step, low, [_told(self.table[k].take(x, mode="wrap"), *self._own(x, low, firsts)) for k, x in enumerate(places)])
                continue
            owns = np.zeros((PREDICTORS, 2 << self.bits), np.uint32)  # one text, over ``LONG_BITS``
            for again in (False, True):
                for contexts, step in slices():
                    low = step.astype(np.uint8)
                    places = slots(contexts, step, self.bits)
                    if again:
                        self._count(spelled, step, low, [_told(self.table[k].take(x), owns[k].take(2 * x), owns[k].take(2 * x + 1)) for k, x in enumerate(places)])
                        continue
                    for k, x in enumerate(places):
                        np.add.at(owns[k], x << 1 | low & 1, np.uint32(1))


def _cells(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cells to their gates and inputs, the place's own prediction first."""
    priors = VALUES[32:]
    values = np.bincount(COARSE[:64], VALUES, 32) / np.maximum(np.bincount(COARSE[:64], minlength=32), 1)
    spelled = at >= WORD_CELLS // 2
    word, byte = at[~spelled], at[spelled] - WORD_CELLS // 2
    gate, x = np.empty(len(at), np.int64), np.zeros((PREDICTORS + 1, len(at)))
    gate[~spelled], gate[spelled] = word >> 15, 3 * LEVELS + (byte >> 19)
    x[0, ~spelled], x[0, spelled] = priors[word & 31], ((priors[::2] + priors[1::2]) / 2)[byte & 15]
    for k in range(2):
        x[k + 1, ~spelled] = values[word >> (10 - 5 * k) & 31]
    for k in range(3):
        x[k + 1, spelled] = values[byte >> (14 - 5 * k) & 31]
    return gate, x


def solved(at: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of least cost over all bits, by Newton's steps in each gate, and the map; from the filled pairs of cells, in order, with their counts."""
    gate, x = _cells(at)
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    plain = plain_weights().astype(np.float64)
    size = PREDICTORS + 1

    def mixed(w: np.ndarray) -> np.ndarray:
        return np.clip(sum(w[gate, k] * x[k] for k in range(size)), -REACH_LOG, REACH_LOG)

    def cost(w: np.ndarray) -> np.ndarray:
        m = mixed(w)
        return np.bincount(gate, ones * np.logaddexp(0, -m) + zeros * np.logaddexp(0, m), GATES) + ((w - plain) ** 2).sum(axis=1) / 2

    weights = plain
    least = cost(weights)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-mixed(weights)))
        off, curve = ones - (ones + zeros) * p, (ones + zeros) * p * (1 - p)
        slope = np.stack([np.bincount(gate, off * x[k], GATES) for k in range(size)], axis=1) - (weights - plain)
        bend = np.tile(np.eye(size), (GATES, 1, 1))
        for i in range(size):
            for j in range(i, size):
                bend[:, i, j] += (found := np.bincount(gate, curve * x[i] * x[j], GATES))
                if j > i:
                    bend[:, j, i] += found
        step = np.linalg.solve(bend, slope[:, :, None])[:, :, 0]
        for _ in range(8):  # shorter in gates that a whole step would make worse
            new = cost(weights + step)
            worse = new > least
            if not worse.any():
                break
            step[worse] /= 4
        step[new > least] = 0
        weights, least = weights + step, np.minimum(new, least)
        if np.abs(step).max() < 1e-6:
            break
    weights = weights.astype(np.float32)
    bins = gate * MAP_BINS + np.rint((mixed(weights.astype(np.float64)) + REACH_LOG) * ((MAP_BINS - 1) / (2 * REACH_LOG))).astype(np.int64)
    hits, shots = np.bincount(bins, ones, GATES * MAP_BINS), np.bincount(bins, ones + zeros, GATES * MAP_BINS)
    refine = plain_map()
    return weights, (hits.reshape(refine.shape) + 8 * refine) / (shots.reshape(refine.shape) + 8)


def fit(texts: list[bytes], book: Book, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and map learned from texts; a text's own bits are taken out of the counts that predict it."""
    tally = Tally(book, table)
    tally.add([tokens(t) for t in texts])
    pairs = tally.counts.reshape(-1, 2)
    at = np.flatnonzero(pairs.any(axis=1))
    return solved(at, pairs[at, 0], pairs[at, 1])


def shares(lengths: list[int], most: int) -> int:
    """The length to which texts are cut so that all of them together have about ``most`` bytes."""
    left, n = most, len(lengths)
    for x in sorted(lengths):
        if x * n >= left:
            return left // n
        left, n = left - x, n - 1
    return max(lengths, default=0)


def part(text: bytes, most: int) -> bytes:
    """About ``most`` bytes of whole words from a place that the text's own hash picks."""
    if len(text) <= most:
        return text
    at = int.from_bytes(hashlib.sha256(text).digest()[:8], "big") % (len(text) - most + 1)
    words = text[at : at + most].split()
    cut = words[at > 0 : len(words) - 1] if len(words) > 2 else words
    return b" ".join(cut)


def _tally(shared):
    def tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to how often bits are met, in compressed parts."""
        found = Tally(*(x.value for x in shared))
        for texts in _batched(it, 0):
            found.add([tokens(t) for t in texts])
        pack = zstandard.ZstdCompressor(level=1)
        parts = found.counts.reshape(-1, TALLY_CHUNK)
        for c in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([pack.compress(parts[c].tobytes())], pa.binary())], ["chunk", "counts"])

    return tally


def _filled(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of compressed parts to the filled pairs of cells of each, with their counts."""
    unpack = zstandard.ZstdDecompressor()
    name, total = None, np.empty(0, np.int64)

    def done() -> pa.RecordBatch:
        pairs = total.reshape(-1, 2)
        at = np.flatnonzero(pairs.any(axis=1))
        packed = [(at + name * (TALLY_CHUNK // 2)).astype("<i4"), pairs[at, 0].astype("<i8"), pairs[at, 1].astype("<i8")]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], ["chunk", "at", "zeros", "ones"])

    for batch in it:
        for c, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if c != name:
                if name is not None:
                    yield done()
                name, total = c, np.zeros(TALLY_CHUNK, np.int64)
            total += np.frombuffer(unpack.decompress(raw), np.uint32)
    if name is not None:
        yield done()


DOC, WORD = 0, 1
_FIELDS = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()),
     ("n_known", pa.int64()), ("base", pa.int64()), ("score", pa.float64()), ("ids", pa.binary()), ("id", pa.int32()), ("word", pa.binary())]
)
_SCHEMA = "kind int, block long, doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base long, score double, ids binary, id int, word binary"


def logs(c: np.ndarray, unknown: int) -> np.ndarray:
    """The base score of words met c times, in whole 2 ** -32, so that sums do not depend on their order."""
    return np.rint(np.log10((c + 1) / unknown) * EXACT).astype(np.int64)


def _score(shared, weights: np.ndarray, refine: np.ndarray, unknown: int):
    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (doc_id, held_out, text) to scored texts, with the block's words that have no code."""
        model = Model.of(*(x.value for x in shared), weights, refine)
        log, met = logs(model.book.counts, unknown), model.book.counts > 0
        log[ESCAPE] = 0
        part, n, size = TaskContext.get().partitionId(), 0, 0
        known: dict[bytes, int] = {}
        held: list[tuple] = []

        def scored() -> pa.RecordBatch:
            every = [tokens(text) for _, _, text in held]
            texts = encode(every, model.book)
            points = model.score_encoded(texts, len(held)) / FIXED
            flat = [w for words in every for w in words]
            rare = np.flatnonzero(texts.word == ESCAPE)
            ids = np.array([known.setdefault(flat[i], len(known)) for i in rare.tolist()], np.int32)
            sizes = np.array([len(words) for words in every])
            starts = np.cumsum(sizes) - sizes
            cuts = np.searchsorted(rare, starts)
            columns = {
                "kind": pa.array(np.full(len(held), DOC, np.int32)), "block": pa.array(np.full(len(held), (part << 32) + n)),
                "doc_id": pa.array([h[0] for h in held], pa.int64()), "held_out": pa.array([h[1] for h in held], pa.bool_()),
                "n_tokens": pa.array(sizes), "n_bytes": pa.array([len(h[2] or b"") for h in held], pa.int64()),
                "n_known": pa.array(np.add.reduceat(met[texts.word], starts, dtype=np.int64)), "base": pa.array(np.add.reduceat(log[texts.word], starts)),
                "score": pa.array(points), "ids": pa.array([x.tobytes() for x in np.split(ids, cuts[1:])], pa.binary()),
            }
            held.clear()
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(sizes), f.type)) for f in _FIELDS], schema=_FIELDS)

        def block() -> Iterator[pa.RecordBatch]:
            words = list(known)
            for at in range(0, len(words), 100_000):
                some = words[at : at + 100_000]
                columns = {
                    "kind": pa.array(np.full(len(some), WORD, np.int32)), "block": pa.array(np.full(len(some), (part << 32) + n)),
                    "id": pa.array(np.arange(at, at + len(some), dtype=np.int32)), "word": pa.array(some, pa.binary()),
                }
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(some), f.type)) for f in _FIELDS], schema=_FIELDS)
            known.clear()

        pending = 0
        for batch in it:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                held.append(row)
                pending += len(row[2] or b"")
                if pending >= BATCH_BYTES:
                    yield scored()
                    size, pending = size + pending, 0
                    if size >= BLOCK_BYTES:
                        yield from block()
                        n, size = n + 1, 0
        if held:
            yield scored()
        yield from block()

    return score


def _gather(unknown: int):
    def gather(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        """One block: its texts, and its words without a code with their counts."""
        every = [np.frombuffer(ids, np.int32) for ids in docs["ids"]]
        c = np.zeros(max((int(at.max(initial=-1)) for at in every), default=-1) + 1, np.int64)  # words that training lacks stay 0
        c[words["id"].to_numpy()] = words["c"].to_numpy()
        log = logs(c, unknown)
        known = [n + int((c[at] > 0).sum()) for at, n in zip(every, docs["n_known"], strict=True)]
        base = [(part + int(log[at].sum())) / EXACT for at, part in zip(every, docs["base"], strict=True)]
        return docs[["doc_id", "held_out", "n_tokens", "n_bytes", "score"]].assign(n_known=known, base_score=base)[["doc_id", "held_out", "n_tokens", "n_bytes", "n_known", "base_score", "score"]]

    return gather


def code_book(vocabulary: DataFrame, n: int, coded_words: int = CODED_WORDS) -> Book:
    """The most frequent words of (word, c), ties in order of bytes, and the bytes of all others."""
    ends = vocabulary.where(F.col("word") == F.lit(END)).first()
    usual = (F.length("word") <= CODED_BYTES) & (F.col("c") >= LEAST_COUNT) & (F.col("word") != F.lit(END))
    rows = vocabulary.where(usual).orderBy(F.desc("c"), "word").limit(coded_words).select("word", "c").toArrow()
    words, counts, ends = rows.column("word").to_pylist(), rows.column("c").to_pylist(), ends.c if ends else 0
    spelled = [0] * 256
    for r in vocabulary.mapInArrow(_spelled(frozenset([*words, END])), "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        spelled[r.byte] = r.n
    return Book(words, counts, ends, n - ends - sum(counts), spelled)


def picked(train: DataFrame, sample_texts: int) -> DataFrame:
    """The rows with a text that have the least hashes, in order, in one partition; as many at any size of the table."""
    return train.where("text is not null").orderBy("at", "text").limit(sample_texts).repartition(1).sortWithinPartitions("at", "text")


def learn(
    train: DataFrame, n: int, vocabulary: DataFrame, size: int, sample_texts: int | None = None, most_bits: int = MOST_BITS
) -> tuple[list[Broadcast], np.ndarray, np.ndarray]:
    """What ``Model.of`` takes, book and table sent to the executors (each once), from the rows (text, at) of ``train``, with ``n`` tokens and ``size`` bytes; ``at`` is a hash.

    Weights come from all texts, or from ``sample_texts`` of them where a caller asks for that.
    """
    spark = train.sparkSession
    book = code_book(vocabulary, n)
    bits = max(LEAST_BITS, min(most_bits, (4 * n).bit_length()))
    shared = [spark.sparkContext.broadcast(book)]
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // COUNT_BYTES))
    parts = train.select("text").coalesce(tasks).mapInArrow(_count(shared[0], bits), "k int, chunk int, counts binary")
    summed = parts.repartition("k", "chunk").sortWithinPartitions("k", "chunk").mapInArrow(_sum, "k int, chunk int, counts binary")
    table = np.zeros((PREDICTORS, 1 << bits), "<u2")
    for r in summed.collect():  # at most 2 ** (MOST_BITS + 1) bytes for each predictor
        part = np.frombuffer(r["counts"], "<u2")
        table[r.k, r.chunk * len(part) : (r.chunk + 1) * len(part)] = part
    shared.append(spark.sparkContext.broadcast(table))
    chosen = picked(train, sample_texts) if sample_texts else train.coalesce(tasks)
    parts = chosen.select("text").mapInArrow(_tally(shared), "chunk int, counts binary")
    filled = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_filled, "chunk int, at binary, zeros binary, ones binary")
    rows = sorted(filled.collect())  # at most WORD_CELLS + BYTE_CELLS counts, of which few are filled
    return shared, *solved(*(np.frombuffer(b"".join(r[i] for r in rows), kind) for i, kind in ((1, "<i4"), (2, "<i8"), (3, "<i8"))))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row; rows with ``held_out`` are not learned from."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(held_out).alias("held_out"), F.col(text).alias("text"))
    train = rows.where("not held_out")
    vocabulary = saved(train.select("text").mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    n, v, size = (x or 0 for x in vocabulary.agg(F.sum("c"), F.count("*"), F.sum(F.col("c") * (F.length("word") + 1))).first())
    shared, weights, refine = learn(train.select("text", F.xxhash64(row_key(F.col("doc_id"), F.col("text"))).alias("at")), n, vocabulary, size)
    unknown = n + v + 1
    scored = saved(rows.select("doc_id", "held_out", "text").mapInArrow(_score(shared, weights, refine, unknown), _SCHEMA), "scored", ["kind"])
    for x in shared:  # what follows reads stored tables only
        x.destroy()
    words = scored.where(f"kind = {WORD}").select("word", F.col("block").alias("of"), "id")
    looked_up = words.join(vocabulary, "word").select("of", "id", "c")
    texts = scored.where(f"kind = {DOC}").select("block", "doc_id", "held_out", "n_tokens", "n_bytes", "n_known", "base", "score", "ids")
    schema = "doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base_score double, score double"
    joined = texts.groupBy("block").cogroup(looked_up.groupBy("of")).applyInPandas(_gather(unknown), schema)
    per_byte = -F.col("score") * F.lit(float(np.log2(10))) / F.greatest("n_bytes", F.lit(1))
    return joined.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", per_byte.alias("bits_per_byte"))
