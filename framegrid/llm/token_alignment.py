"""Which tokens of one tokenizer cover which tokens of another, and how often each pair of ids is linked in the corpus.

Both tokenizers cover the same bytes. The union of both arrays of token ends cuts them into elementary intervals; the owner of an
interval on each side is the first token that ends at or after the interval's end. Each interval is one overlap of two tokens. Where
both arrays have an end, a group closes; all pairs of one group's tokens are linked.

A group's pairs are the product of its different ids with the product of their occurrences, so a long run of equal tokens stays
small. Counts of id pairs over the corpus are gathered by blocks: each task numbers the different pairs of its documents, starting
a new block when it has ``BLOCK_PAIRS`` of them, and stores for each document only numbers and occurrences. The pairs of blocks
are summed by pair, the greatest count of each first id is found, and the values go back to their block, where each document adds
up its own. So a pair is shuffled once for each block that has it, not once for each document.

Cases: documents whose texts are null or empty, or of which the bytes of one tokenizer differ from the text after a space, have no
tokens and zeros; long texts are tokenized whole; repeated rows and null or repeated ids count row by row; an empty table gives an
empty result; of the table's columns only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from framegrid.llm.byte_bpe import GROUP_CHARS, later_code_points, strings, vocabulary
from framegrid.llm.common import saved

#: Different pairs in a block, and bytes of its documents' numbers; a block is put together again in one task.
BLOCK_PAIRS, BLOCK_BYTES = 1 << 19, 1 << 25
#: Products of long groups that are made at a time.
MADE_PRODUCTS = 1 << 20
#: A tokenizer file goes to every task, so its size has a bound.
MOST_MODEL_BYTES = 1 << 26
#: Code points of the longest text that the faster library is given.
LIBRARY_CHARS = 1 << 19


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        content = f.read(MOST_MODEL_BYTES + 1)
    if len(content) > MOST_MODEL_BYTES:
        raise ValueError(f"{path} is over {MOST_MODEL_BYTES} bytes")
    return content


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 is itself, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class ByteLevel:
    """A byte-level BPE file of the ``tokenizers`` library; ids of the text after a space, special tokens' strings as plain text.

    The file's merges stand in the order of the ids that they make, which is checked; so an entry's id is its rank, and the ``tiktoken``
    library gives the same ids faster. That library's pattern matcher gives up on runs of a million spaces, so texts over
    ``LIBRARY_CHARS`` are encoded by ``byte_bpe``. Every byte is an entry, so the tokens' bytes are always the text's.
    """

    ranks: dict[bytes, int]
    pattern: str
    later: frozenset[int]

    @classmethod
    def read(cls, path: str, pattern: str) -> ByteLevel:
        """``pattern`` is the one by which the file's own pre-tokenizer splits."""
        held = json.loads(_model(path))
        signs = _byte_of_sign()
        special = {x["content"] for x in held["added_tokens"]}
        ids = held["model"]["vocab"]
        merges = [x.split(" ") if isinstance(x, str) else x for x in held["model"]["merges"]]
        made = [ids[left + right] for left, right in merges]
        singles = [i for entry, i in ids.items() if len(entry) == 1]
        if any(x >= y for x, y in zip(made, made[1:], strict=False)) or (made and max(singles) > made[0]) or held["normalizer"] is not None:
            raise ValueError(f"{path}: ids are not ranks")
        return cls({bytes(signs[c] for c in entry): i for entry, i in ids.items() if entry not in special}, pattern, later_code_points())

    def open(self) -> _ByteLevel:
        return _ByteLevel(self)


class _ByteLevel:
    def __init__(self, model: ByteLevel) -> None:
        import tiktoken

        self.library = tiktoken.Encoding("own", pat_str=model.pattern, mergeable_ranks=model.ranks, special_tokens={})
        self.bytes = {i: entry for entry, i in model.ranks.items()}
        self.model, self.own = model, None

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self.library.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) if len(t) <= LIBRARY_CHARS else self._long(t) for t in texts]

    def _long(self, text: str) -> np.ndarray:
        if self.own is None:
            self.own = vocabulary(self.model.ranks, self.model.pattern, self.model.later).encoder()
        return self.own.encode([" " + text])[0].astype(np.int64)


@dataclass
class Pieces:
    """A file of the ``sentencepiece`` library; the model itself puts the space before the text."""

    content: bytes

    @classmethod
    def read(cls, path: str) -> Pieces:
        return cls(_model(path))

    def open(self) -> _Pieces:
        return _Pieces(self)


class _Pieces:
    def __init__(self, model: Pieces) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model.content)
        pieces = range(self.model.get_piece_size())
        one = lambda i: bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
        self.bytes = {i: one(i) for i in pieces}

    def __call__(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where their bytes are not those of the text after a space."""
        found = self.model.encode(texts, num_threads=1)
        return [np.array(x, np.int64) if b"".join(map(self.bytes.__getitem__, x)) == b" " + t.encode() else None for x, t in zip(found, texts, strict=True)]


class Side:
    """An opened tokenizer with its tokens' lengths and names by id; a name is followed by a comma, or by ``close`` at its group's end."""

    def __init__(self, model: ByteLevel | Pieces, close: str) -> None:
        self.encode = model.open()
        most = max(self.encode.bytes) + 1
        self.lengths = np.array([len(self.encode.bytes.get(i, b"")) for i in range(most)])
        self.names = [f"{i}," for i in range(most)] + [f"{i}{close}" for i in range(most)]


@dataclass
class Alignment:
    """Overlaps as pairs of token places; for each token of both sides the number of its group, and how many tokens stand up to each group's end."""

    overlap_a: np.ndarray
    overlap_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    upto_a: np.ndarray
    upto_b: np.ndarray

    @property
    def groups(self) -> int:
        return len(self.upto_a)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Ends are strictly increasing byte offsets, both with the same last one."""
    there = np.zeros(int(ends_a[-1]) + 1, bool)  # the union of two arrays of places below a known one, in order
    there[ends_a] = there[ends_b] = True
    ends = np.flatnonzero(there)
    a, b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    closes_a, closes_b = ends_a[a] == ends, ends_b[b] == ends
    shared = closes_a & closes_b
    group = np.cumsum(shared) - shared
    return Alignment(a, b, group[closes_a], group[closes_b], 1 + np.flatnonzero(shared[closes_a]), 1 + np.flatnonzero(shared[closes_b]))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers begin, and how long they are."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    begin = np.flatnonzero(new)
    n = np.empty(len(begin), np.int64)
    np.subtract(begin[1:], begin[:-1], out=n[:-1])
    n[-1:] = len(keys) - begin[-1:]
    return begin, n


def _products(first: np.ndarray, many: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of one side with all rows of the other in its group, of which ``first`` and ``many`` say where they are."""
    width = many[group]
    left = np.repeat(np.arange(len(group)), width)
    return left, np.repeat(first[group] - (np.cumsum(width) - width), width) + np.arange(len(left))


def linked(ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of linked ids as a * 2**32 + b, in order, and how many occurrences of tokens each links."""
    before_b = np.concatenate([[0], found.upto_b[:-1]])
    many_a, many_b = np.diff(found.upto_a, prepend=0), found.upto_b - before_b
    if int((many_a * many_b).sum()) <= 4 * (len(ids_a) + len(ids_b)):
        left, right = _products(before_b, many_b, found.group_a)
        keys = np.sort(ids_a[left] << 32 | ids_b[right])
        begin, n = _runs(keys)
        return keys[begin], n
    # long groups: the different ids of each, with their occurrences
    sides = []
    for ids, group in ((ids_a, found.group_a), (ids_b, found.group_b)):
        key = np.sort(group << 32 | ids)
        begin, n = _runs(key)
        sides.append((key[begin] >> 32, key[begin] & 0xFFFFFFFF, n))
    (group_a, id_a, n_a), (group_b, id_b, n_b) = sides
    first, many = np.searchsorted(group_b, np.arange(found.groups)), np.bincount(group_b, minlength=found.groups)
    out_keys, out_n = np.empty(0, np.int64), np.empty(0, np.int64)
    width = np.cumsum(many[group_a])
    cut = np.searchsorted(width, np.arange(MADE_PRODUCTS, int(width[-1]), MADE_PRODUCTS))
    for part in np.split(np.arange(len(group_a)), np.unique(cut)):
        left, right = _products(first, many, group_a[part])
        left = part[left]
        keys, n = np.concatenate([out_keys, id_a[left] << 32 | id_b[right]]), np.concatenate([out_n, n_a[left] * n_b[right]])
        order = np.argsort(keys, kind="stable")
        begin, _ = _runs(keys[order])
        out_keys, out_n = keys[order][begin], np.add.reduceat(n[order], begin)
    return out_keys, out_n


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment, names: list[str], n_a: int) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group in order. ``names`` are those of both sides, ``n_a`` of the first."""
    name = np.empty(len(ids_a) + len(ids_b), np.int64)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[found.upto_a - 1] = last_b[found.upto_b - 1] = True
    # before a token stand the own side's tokens and the other's: of earlier groups, for the second side also of its own group
    name[np.arange(len(ids_a)) + np.concatenate([[0], found.upto_b])[found.group_a]] = ids_a + last_a * (n_a // 2)
    name[np.arange(len(ids_b)) + found.upto_a[found.group_b]] = ids_b + last_b * ((len(names) - n_a) // 2) + n_a
    return "".join(map(names.__getitem__, name.tolist()))[:-1]


#: Rows of documents have n_a and what follows, rows of pairs have a and what follows.
GATHERED = (
    "block string, row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, numbers binary, occurrences binary, "
    "a int, b int, number int, docs long"
)


class _Block:
    """The pairs of a block in the order in which they came, with their numbers, and the documents that hold each."""

    def __init__(self) -> None:
        self.keys = np.empty(0, np.int64)  # in order
        self.numbers = np.empty(0, np.int64)
        self.docs = np.zeros(0, np.int64)  # by number
        self.bytes = 0

    def add(self, per_doc: list[np.ndarray]) -> list[np.ndarray]:
        """The numbers of each document's pairs."""
        every = np.concatenate(per_doc)
        keys, inverse, n = np.unique(every, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        number = np.empty(len(keys), np.int64)
        number[known] = self.numbers[at[known]]
        number[~known] = len(self.docs) + np.arange(int((~known).sum()))
        self.docs = np.concatenate([self.docs, np.zeros(int((~known).sum()), np.int64)])
        self.docs[number] += n
        self.keys = np.insert(self.keys, at[~known], keys[~known])
        self.numbers = np.insert(self.numbers, at[~known], number[~known])
        return np.split(number[inverse], np.cumsum([len(x) for x in per_doc])[:-1])


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _gather(model_a, model_b, id_type: pa.DataType):
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in GATHERED.format(id="id").split(", ")]
    schema = pa.schema([(name, id_type if kind == "id" else kinds[kind]) for name, kind in fields])

    def close(block: _Block, name: str) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(block.keys), 1 << 16):
            keys, numbers = block.keys[at : at + (1 << 16)], block.numbers[at : at + (1 << 16)]
            yield _rows(schema, block=[name] * len(keys), a=keys >> 32, b=keys & 0xFFFFFFFF, number=numbers, docs=block.docs[numbers])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = Side(model_a.value, "|"), Side(model_b.value, ";")
        names = a.names + b.names
        task, made, rows = TaskContext.get().partitionId(), 0, 0
        block = _Block()
        for batch in it:
            ids, texts = batch.column(0), strings(batch.column(1))
            for first, last in _slices(texts):
                part = texts[first:last]
                name = f"{task}-{made}"
                out = {f.name: [] for f in schema if f.name not in ("doc_id", "a", "b", "number", "docs", "numbers", "occurrences")}
                per_doc, occurrences = [], []
                for text, x, y in zip(part, a.encode(part), b.encode(part), strict=True):
                    if not text or y is None:
                        row, keys, n = (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
                    else:
                        found = align(np.cumsum(a.lengths[x]), np.cumsum(b.lengths[y]))
                        keys, n = linked(x, y, found)
                        row = (len(x), len(y), found.groups, int(n.sum()), hashlib.sha256(groups_text(x, y, found, names, len(a.names)).encode()).hexdigest())
                    for values, v in zip(out.values(), (name, rows, *row), strict=True):
                        values.append(v)
                    per_doc.append(keys)
                    occurrences.append(n)
                    rows += 1
                numbers = [x.astype("<u4").tobytes() for x in block.add(per_doc)]
                times = [x.astype("<u4" if not len(x) or x.max() < 1 << 32 else "<u8").tobytes() for x in occurrences]
                block.bytes += sum(map(len, numbers)) + sum(map(len, times))
                yield _rows(schema, doc_id=ids.slice(first, last - first), numbers=numbers, occurrences=times, **out)
                if len(block.keys) >= BLOCK_PAIRS or block.bytes >= BLOCK_BYTES:
                    yield from close(block, name)
                    block, made = _Block(), made + 1
        yield from close(block, f"{task}-{made}")

    return run


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


RESULT = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _settle(schema: pa.Schema):
    """Documents of a block with the values of its pairs."""

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        count = np.zeros(values.num_rows, np.int64)
        best = np.zeros(values.num_rows, np.int64)
        number = values.column("number").to_numpy()
        count[number], best[number] = values.column("count").to_numpy(), values.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for numbers, occurrences in zip(docs.column("numbers"), docs.column("occurrences"), strict=True):
            at = np.frombuffer(numbers.as_py(), "<u4")
            times = occurrences.as_py()
            n = np.frombuffer(times, "<u4" if len(times) == 4 * len(at) else "<u8").astype(np.int64)
            n_best.append(int(n @ best[at]))
            count_sum.append(int(n @ count[at]))
        columns = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        columns |= {"n_best": pa.chunked_array([pa.array(n_best, pa.int64())]), "count_sum": pa.chunked_array([pa.array(count_sum, pa.int64())])}
        return pa.table([columns[f.name] for f in schema], schema=schema)

    return run


def gather(docs: DataFrame, a: ByteLevel | Pieces, b: ByteLevel | Pieces, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored rows of two kinds: documents with the numbers of their pairs, and the pairs of blocks."""
    context = docs.sparkSession.sparkContext
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = read.schema["doc_id"].dataType.simpleString()
    made = read.mapInArrow(_gather(context.broadcast(a), context.broadcast(b), to_arrow_type(read.schema["doc_id"].dataType)), GATHERED.format(id=id_type))
    return saved(made, "aligned")


def pair_counts(gathered: DataFrame) -> DataFrame:
    """How many documents hold each pair of ids linked, and whether no pair of the same first id has more."""
    counted = gathered.where("number is not null").groupBy("a", "b").agg(F.sum("docs").alias("count"))
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def links(docs: DataFrame, a: ByteLevel | Pieces, b: ByteLevel | Pieces, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens of both sides, groups, links, links whose pair is the most frequent of its first id, the sum of the links' counts."""
    gathered = gather(docs, a, b, doc_id, text)
    pairs = gathered.where("number is not null").select("block", "a", "b", "number")
    values = saved(pairs.join(saved(pair_counts(gathered), "pair-counts"), ["a", "b"]).select("block", "number", "count", F.col("best").cast("long").alias("best")), "pair-values")
    rows = gathered.where("row is not null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "occurrences")
    id_type = rows.schema["doc_id"].dataType
    kinds = {"long": pa.int64(), "string": pa.string(), "{id}": to_arrow_type(id_type)}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RESULT.split(", "))])
    return rows.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_settle(schema), RESULT.format(id=id_type.simpleString()))
