"""Byte-level BPE in two tiers: whole pre-tokens by a minimal perfect hash, all others by a heap of merges over linked bytes.

The vocabulary gives each byte string a rank, which is its id. A pattern splits a text into pre-tokens. The first tier takes the
pre-tokens of many texts at once as one array of bytes: a 64-bit hash of each finds its bucket, the bucket's displacement its
slot, of which there are exactly as many as entries, and the bytes in the slot are compared. What the vocabulary does not
hold goes to the second tier: the bytes are a linked list, a heap gives the adjacent pair of least rank, the leftmost of
equals, until no pair is an entry; in a short piece a search of the list gives that pair, which is faster there. A word that a task has merged is kept, also for its next tasks, until its table is full.

Cases: a null text counts as empty and gives no ids; a text that is not valid UTF-8 has its bad bytes replaced by U+FFFD;
long texts are split in parts between matches, so memory follows the longest match and not the text; repeated rows give the
same ids each; an empty table gives an empty result; other columns stay, one that has the result's name is replaced. Letters
and digits are those of the Unicode version of the installed tiktoken library; later ones count as neither.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of texts that are taken together, and matches of a long text.
GROUP_CHARS, GROUP_MATCHES = 1 << 20, 1 << 18
#: Bytes of words that a worker keeps with their ids.
KEPT_BYTES = 1 << 27
#: A vocabulary goes to every task, so its size has a bound.
MOST_VOCABULARY_BYTES = 1 << 26
#: Entries per bucket of the hash, and displacements that are tried at a time.
PER_BUCKET, TRIED = 4, 64
#: Bytes of a piece whose least pair is found by search, and what is more than any rank.
SHORT_PIECE, NO_RANK = 32, 1 << 62
#: What stands for a later code point while a text is split: a sign that is no letter, digit or space.
PLAIN_SIGN = "␀"

_STEP, _GOLDEN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The place of each byte in its own string."""
    return np.arange(int(lengths.sum())) - np.repeat(starts, lengths)


class PerfectHash:
    """Slots of byte strings, as many as there are strings; none is empty and no two are equal."""

    def __init__(self, keys: list[bytes]) -> None:
        if not keys or not all(keys) or len(set(keys)) < len(keys):
            raise ValueError("keys must be different and not empty")
        self.n, self.longest = len(keys), max(map(len, keys))
        self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, _STEP)]))
        lengths = np.array([len(k) for k in keys])
        data = np.frombuffer(b"".join(keys), np.uint8)
        hashes = self.hashes(data, np.cumsum(lengths) - lengths, lengths)
        if len(np.unique(hashes)) < self.n:
            raise ValueError("two keys share 64 bits")
        buckets = max(1, self.n // PER_BUCKET)
        self.moved = np.zeros(buckets, np.int64)
        slots = np.full(self.n, -1)
        order = np.argsort(hashes % np.uint64(buckets), kind="stable")
        of = (hashes[order] % np.uint64(buckets)).astype(np.int64)
        groups = np.split(order, np.flatnonzero(np.diff(of)) + 1)
        free = np.ones(self.n, bool)
        for group in sorted((g for g in groups if len(g) > 1), key=len, reverse=True):
            d = 0
            while True:
                at = self._slot(hashes[group][None, :], np.arange(d, d + TRIED)[:, None])
                lined = np.sort(at, axis=1)
                fits = np.flatnonzero(free[at].all(axis=1) & (np.diff(lined, axis=1) > 0).all(axis=1))
                if len(fits):
                    break
                d += TRIED
            self.moved[int(hashes[group[0]] % np.uint64(buckets))] = d + fits[0]
            slots[group] = at[fits[0]]
            free[at[fits[0]]] = False
        # a bucket of one names its slot itself
        singles = np.array([g[0] for g in groups if len(g) == 1], np.int64)
        slots[singles] = np.flatnonzero(free)[: len(singles)]
        self.moved[(hashes[singles] % np.uint64(buckets)).astype(np.int64)] = -1 - slots[singles]
        by_slot = np.argsort(slots)
        self.key = by_slot  # the number of the key in each slot
        self.lengths = lengths[by_slot]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(keys[i] for i in by_slot), np.uint8)

    def hashes(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """64 bits of each string; of those longer than any key only the first bytes count."""
        power = self.powers[np.minimum(_within(starts, lengths), self.longest)]
        return _mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power, starts))

    def _slot(self, hashes: np.ndarray, moved: np.ndarray) -> np.ndarray:
        return (_mixed(hashes ^ ((moved.astype(np.uint64) + np.uint64(1)) * _GOLDEN)) % np.uint64(self.n)).astype(np.int64)

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of the key that each string equals, or -1; strings are not empty and lie one after the other in ``data``."""
        hashes = self.hashes(data, starts, lengths)
        moved = self.moved[(hashes % np.uint64(len(self.moved))).astype(np.int64)]
        slot = np.where(moved < 0, -1 - moved, self._slot(hashes, np.maximum(moved, 0)))
        alike = self.lengths[slot] == lengths
        at = np.minimum(np.repeat(self.starts[slot] - starts, lengths) + np.arange(len(data)), len(self.data) - 1)
        differs = np.add.reduceat((self.data[at] != data).astype(np.int64), starts) > 0
        return np.where(alike & ~differs, self.key[slot], -1)


@dataclass
class Vocabulary:
    """Entries in order of their ids, their hash, and the pattern that splits texts."""

    entries: list[bytes]
    ids: np.ndarray
    hash: PerfectHash
    pattern: str
    later: frozenset[int]  # letters and digits of later Unicode versions

    def encoder(self) -> Encoder:
        """One for each worker, which goes on using it, and the words it has kept, in its next tasks."""
        if "_encoder" not in self.__dict__:
            self.__dict__["_encoder"] = Encoder(self)
        return self.__dict__["_encoder"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_encoder"}

    def decoder(self) -> Decoder:
        return Decoder(self)


def later_code_points() -> frozenset[int]:
    """Letters and digits of the ``regex`` module's Unicode version that the installed tiktoken does not know."""
    import tiktoken

    kinds = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and kinds.match(chr(c))]
    single = tiktoken.Encoding("single", pat_str=r"[\p{L}\p{N}]", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    known = single.decode_bytes(single.encode_ordinary("".join(map(chr, new)))).decode()
    return frozenset(new) - set(map(ord, known))


def vocabulary(ranks: dict[bytes, int], pattern: str, later: frozenset[int] | None = None) -> Vocabulary:
    """All single bytes must be entries, so that every text can be encoded."""
    if not all(bytes([i]) in ranks for i in range(256)):
        raise ValueError("a vocabulary holds all single bytes")
    if sum(map(len, ranks)) + 64 * len(ranks) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary is over {MOST_VOCABULARY_BYTES} bytes")
    entries = sorted(ranks, key=ranks.__getitem__)
    return Vocabulary(entries, np.array([ranks[e] for e in entries], np.uint32), PerfectHash(entries), pattern, later_code_points() if later is None else later)


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """A rank file: lines of an entry in base 64 and its rank; read on the driver."""
    with open(path, "rb") as f:
        return vocabulary({base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, f)}, pattern)


class Splitter:
    """The matches of a pattern in a text, in blocks; all characters are matched by the patterns in use."""

    def __init__(self, pattern: str, later: Iterable[int]) -> None:
        self.pattern = regex.compile(pattern)
        self.plain = dict.fromkeys(later, PLAIN_SIGN)
        self.later = frozenset(map(chr, later))

    def __call__(self, text: str) -> Iterator[list[str]]:
        plain = text
        if not text.isascii() and not self.later.isdisjoint(set(text)):
            plain = text.translate(self.plain)
        if plain is text and len(text) <= GROUP_CHARS:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(plain)
        while block := [text[m.start() : m.end()] for m in islice(found, GROUP_MATCHES)]:
            yield block


def pairs_of_bytes(rank: dict[bytes, int]) -> list[int | None]:
    """The ranks of all pairs of bytes, None where they are no entry."""
    return [rank.get(bytes((a, b))) for a in range(256) for b in range(256)]


def _merged_short(piece: bytes, rank: dict[bytes, int], pairs: list[int | None]) -> list[int]:
    cuts = list(range(len(piece) + 1))
    ranks = [NO_RANK if (r := pairs[a << 8 | b]) is None else r for a, b in zip(piece, piece[1:], strict=False)]
    get = rank.get
    while ranks and (least := min(ranks)) < NO_RANK:
        i = ranks.index(least)
        del ranks[i], cuts[i + 1]
        if i < len(ranks):
            ranks[i] = get(piece[cuts[i] : cuts[i + 2]], NO_RANK)
        if i:
            ranks[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], NO_RANK)
    return [rank[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def merged(piece: bytes, rank: dict[bytes, int], pairs: list[int | None]) -> list[int]:
    """The ids of a piece: always the pair of least rank is joined, the leftmost of equals.

    A short piece is searched for that pair each time. The heap of a longer one holds a pair's rank, begin and end as one number.
    """
    n = len(piece)
    if n <= SHORT_PIECE:
        return _merged_short(piece, rank, pairs)
    bits = n.bit_length()
    ones = (1 << bits) - 1
    end = list(range(1, n + 1))  # the end of the part that begins here, where the part after it begins; 0 for a part that was joined
    before = list(range(-1, n - 1))
    get = rank.get
    heap = [(r << bits | i) << bits | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:], strict=False)) if (r := pairs[a << 8 | b]) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        key = pop(heap)
        i, j = key >> bits & ones, key & ones
        k = end[i]
        if not k or k >= n or end[k] != j:
            continue  # one of the two parts has been joined since
        end[k], end[i] = 0, j
        if j < n:
            before[j] = i
            if (r := get(piece[i : end[j]])) is not None:
                push(heap, (r << bits | i) << bits | end[j])
        if (h := before[i]) >= 0 and (r := get(piece[h:j])) is not None:
            push(heap, (r << bits | h) << bits | j)
    out, i = [], 0
    while i < n:
        out.append(rank[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    def __init__(self, model: Vocabulary) -> None:
        self.model = model
        self.split = Splitter(model.pattern, model.later)
        self.rank = {e: int(i) for e, i in zip(model.entries, model.ids, strict=True)}
        self.pairs = pairs_of_bytes(self.rank)
        self.kept: dict[str, list[int]] = {}
        self.kept_bytes = 0

    def _words(self, words: list[str]) -> list[list[int]]:
        if self.kept_bytes > KEPT_BYTES:
            self.kept, self.kept_bytes = {}, 0
        for w in set(words).difference(self.kept):
            self.kept[w] = ids = merged(w.encode(), self.rank, self.pairs)
            self.kept_bytes += 240 + len(w) + 8 * len(ids)
        return [self.kept[w] for w in words]

    def pieces(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens one after the other, and how many each has; equal pre-tokens are looked up once."""
        held = pa.array(tokens, pa.large_string()).dictionary_encode()
        words, place = held.dictionary, held.indices.to_numpy(zero_copy_only=False)
        ends = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        found = self.model.hash.find(np.frombuffer(words.buffers()[2], np.uint8)[: ends[-1]], ends[:-1], np.diff(ends))
        hit, missed = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
        ids = self._words(words.take(pa.array(missed)).to_pylist())
        n = np.ones(len(words), np.int64)
        n[missed] = [len(x) for x in ids]
        first = np.cumsum(n) - n
        flat = np.empty(int(n.sum()), np.uint32)
        flat[first[hit]] = self.model.ids[found[hit]]
        flat[np.repeat(found < 0, n)] = np.fromiter(chain.from_iterable(ids), np.uint32)
        every = n[place]
        return flat[np.repeat(first[place], every) + _within(np.cumsum(every) - every, every)], every

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, and how many each has."""
        counts = np.zeros(len(texts), np.int64)
        out: list[np.ndarray] = []
        tokens: list[str] = []
        owners: list[tuple[int, int]] = []

        def settle() -> None:
            if tokens:
                ids, n = self.pieces(tokens)
                out.append(ids)
                upto = np.concatenate([[0], np.cumsum(n)])
                at = 0
                for owner, k in owners:
                    counts[owner] += upto[at + k] - upto[at]
                    at += k
            tokens.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for block in self.split(text) if text else ():
                tokens += block
                owners.append((i, len(block)))
                if len(tokens) >= GROUP_MATCHES:
                    settle()
        settle()
        return np.concatenate(out) if out else np.empty(0, np.uint32), counts


class Decoder:
    def __init__(self, model: Vocabulary) -> None:
        size = int(model.ids.max()) + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[model.ids] = [len(e) for e in model.entries]
        self.starts = np.zeros(size, np.int64)
        self.starts[model.ids] = np.cumsum(self.lengths[model.ids]) - self.lengths[model.ids]
        self.data = np.frombuffer(b"".join(model.entries), np.uint8)
        self.known = np.zeros(size, bool)
        self.known[model.ids] = True

    def decode(self, ids: np.ndarray) -> bytes:
        """The entries' bytes one after the other; an id that is no entry is an error."""
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id that is not in the vocabulary")
        parts = []
        for at in range(0, len(ids), GROUP_MATCHES):
            part = ids[at : at + GROUP_MATCHES]
            n = self.lengths[part]
            parts.append(self.data[np.repeat(self.starts[part], n) + _within(np.cumsum(n) - n, n)].tobytes())
        return b"".join(parts)


def strings(column: pa.Array) -> list[str]:
    """Null counts as empty; bytes that are not UTF-8 are replaced."""
    return [x.decode("utf-8", "replace") if x else "" for x in column.cast(pa.large_binary()).to_pylist()]


def _groups(texts: list[str]) -> Iterator[slice]:
    """Slices of texts of about ``GROUP_CHARS``; a longer text stands alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARS:
            yield slice(first, i)
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield slice(first, len(texts))


def encode(docs: DataFrame, model: Vocabulary, text: str = "text", into: str = "ids", packed: bool = False) -> DataFrame:
    """``docs`` with the ids of each text: an array<int>, or little-endian unsigned 32-bit numbers if ``packed``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(into)
    place = rest.columns.index(text)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in it:
            texts = strings(batch.column(place))
            for part in _groups(texts):
                ids, n = encoder.encode(texts[part])
                ends = np.concatenate([[0], np.cumsum(n)])
                if packed:
                    column = pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                else:
                    column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
                held = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*held.columns, column], [*held.schema.names, into])

    kind = "binary" if packed else "array<int>"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{fields}, `{into}` {kind}")


def decode(encoded: DataFrame, model: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of each row's ids, in either form; null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        if not held:
            held.append(shared.value.decoder())
        out = []
        for x in column:
            if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
                numbers = np.frombuffer(x.as_py() or b"", "<u4").astype(np.int64)
            else:
                numbers = x.values.to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.empty(0, np.int64)
            out.append(held[0].decode(numbers))
        return pa.array(out, pa.binary())

    held: list[Decoder] = []
    return encoded.withColumn(into, run(F.col(ids)))
