"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities of the pieces of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, found by the forward algorithm; a text's is the product over its words. Probabilities come
from expectation maximisation over a sample of labelled texts with a bound for each language.

Words are lower-cased runs between white space, scored whole whatever their length; a character that the vocabulary lacks
counts alike in all languages. Words are fitted whole, too: those over ``UNSCALED`` characters by sums that are scaled at each.
Lower case joins pieces that differ in case only (the public vocabulary's 31,741 pieces become 25,614); 14 with an inner mark are left out.
Expected counts are summed in a fixed number of sorted parts of the sample, so a model does not depend on partitions.

Cases: a null text or one without a letter is ``und`` with score 0, as is every text where nothing is labelled; texts
are read whole; ties go to the language that sorts first; repeated rows are judged alike; null languages are not
learned; an empty table gives an empty result; the input's columns stay as they are, but for one with the result's name,
which is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import saved

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Expected number of texts of one language that are learned from; they are picked by a hash of id and text.
SAMPLE_TEXTS = 4_000
#: Words whose scores a task keeps at hand.
MOST_KNOWN = 300_000
#: More languages than this raise an error.
MOST_LANGUAGES = 500
LONGEST, RUN, LONG_BLOCK = 16, 256, 4096
#: Words over so many characters are fitted one by one, with sums that are scaled at each character.
UNSCALED = 40
#: Parts that the sample is dealt into.
SAMPLE_PARTS = 16
UNKNOWN = 1e-6
_B = 0x100000001B3
_MASK = (1 << 64) - 1
_BITS = 20


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces that stay within a word, sorted."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    pieces = {model.id_to_piece(i).lower() for i in ids}
    return sorted(p for p in pieces if p and "▁" not in p[1:] and len(p) <= LONGEST)


class Lattice:
    """Finds the pieces at every place of a list of words."""

    def __init__(self, pieces: list[str]) -> None:
        self.pieces = pieces
        self.none, self.unknown = len(pieces) + 1, len(pieces)
        hashes = []
        for p in pieces:
            h = 0
            for c in p:
                h = (h * _B + ord(c) + 1) & _MASK
            hashes.append(h)
        every = np.array(hashes, np.uint64)
        self.order = np.argsort(every)
        self.hashes = every[self.order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)

    def places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts and lengths of the words, and for each piece length the piece that begins at each character."""
        text = "▁" + "▁".join(words)
        lengths = np.array([len(w) + 1 for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        n = len(code)
        found, h = [], np.zeros(n, np.uint64)
        for k in range(1, min(LONGEST, int(lengths.max())) + 1):
            with np.errstate(over="ignore"):
                h = h[: n - k + 1] * np.uint64(_B) + code[k - 1 :]
            at = np.full(n, self.none if k > 1 else self.unknown, np.int32)
            maybe = np.flatnonzero(self.seen[self._slot(h)])
            where = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            real = self.hashes[where] == h[maybe]
            at[maybe[real]] = self.order[where[real]]
            found.append(at)
        return starts, lengths, found

    def _ends(self, word: str) -> np.ndarray:
        """For each place of a word the pieces that end there, by their length."""
        _, lengths, found = self.places([word])
        n = int(lengths[0])
        ends = np.full((n + 1, len(found)), self.none, np.int32)
        for k, at in enumerate(found):
            ends[k + 1 :, k] = at[: n - k]
        return ends

    def expect_long(self, word: str, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The expected pieces of one long word that is met ``weight`` times in each column.

        Forward, each place's pieces get their shares of the sum that ends there; backward, a place's share of all segmentations is dealt
        out to its pieces and to where they begin. Shares are kept for a block of places at a time and made again from the block's start.
        """
        ends = self._ends(word)
        n, width = len(ends) - 1, ends.shape[1]

        def step(before: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
            terms = before * p[ends[j]]
            total = terms.sum(axis=0)
            return np.concatenate([np.ones((1, p.shape[1])), before[:-1] / total]), terms / total

        before = np.zeros((width, p.shape[1]))  # forward sums over the latest one, the latest first
        before[0] = 1
        starts = []
        for j in range(1, n + 1):
            if (j - 1) % LONG_BLOCK == 0:
                starts.append(before)
            before, _ = step(before, j)
        reached = np.zeros((n + 1, p.shape[1]))  # how often segmentations have a border here
        reached[n] = weight
        out = np.zeros((len(p), p.shape[1]))
        for block in range(len(starts) - 1, -1, -1):
            first, last = block * LONG_BLOCK + 1, min(n, (block + 1) * LONG_BLOCK)
            before, shares = starts[block], np.empty((last - first + 1, width, p.shape[1]))
            for j in range(first, last + 1):
                before, shares[j - first] = step(before, j)
            for j in range(last, first - 1, -1):
                shares[j - first] *= reached[j]
                k = min(width, j)
                reached[j - k : j] += shares[j - first, :k][::-1]
            which = ends[first : last + 1].ravel()
            for c in range(p.shape[1]):
                out[:, c] += np.bincount(which, shares[:, :, c].ravel(), len(p))
        return out

    def walk_long(self, word: str, p: np.ndarray) -> np.ndarray:
        """As ``walk`` for one long word: all pieces that end at a character at once, rescaled at each."""
        ends = self._ends(word)
        n, width = len(ends) - 1, ends.shape[1]
        before = np.zeros((width, p.shape[1]))  # forward sums, the latest first
        before[0] = 1
        log = np.zeros(p.shape[1])
        for j in range(1, n + 1):
            total = (before * p[ends[j]]).sum(axis=0)
            log += np.log(total)
            before[1:] = before[:-1] / total
            before[0] = 1
        return log

    def walk(self, words: list[str], p: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """log probability of each word under each column of p; with weights, also the expected pieces."""
        if weight is None and max(map(len, words), default=0) > RUN:
            out = np.empty((len(words), p.shape[1]))
            short = [i for i, w in enumerate(words) if len(w) <= RUN]
            if short:
                out[short] = self.walk([words[i] for i in short], p)[0]
            for i, w in enumerate(words):
                if len(w) > RUN:
                    out[i] = self.walk_long(w, p)
            return out, None
        starts, lengths, found = self.places(words)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        longest, n_columns = int(lengths[0]), p.shape[1]
        active = np.searchsorted(-lengths, -np.arange(longest + 1), side="right")
        forward = [np.ones((len(words), n_columns))]
        scale = np.zeros(len(words))
        log = np.empty((len(words), n_columns))
        for j in range(1, longest + 1):
            m = active[j]
            total = np.zeros((m, n_columns))
            for k in range(1, min(len(found), j) + 1):
                piece = found[k - 1][starts[:m] + (j - k)]
                hit = np.flatnonzero(piece != self.none)
                if len(hit):
                    total[hit] += forward[j - k][hit] * p[piece[hit]]
            forward.append(total)
            if j % LONGEST == 0 and weight is None:
                most = total.max(axis=1)
                scale[:m] += np.log(most)
                for i in range(max(0, j - LONGEST), j + 1):
                    forward[i] = forward[i][:m] / most[:, None]
                for i in range(max(0, j - LONGEST)):
                    forward[i] = forward[i][:0]
            done = slice(active[j + 1] if j < longest else 0, m)
            log[done] = np.log(forward[j][done]) + scale[done, None]
        out = np.empty_like(log)
        out[order] = log
        return out, None if weight is None else self._expect(starts, lengths, found, active, forward, p, weight[order])

    def _expect(self, starts, lengths, found, active, forward, p, weight) -> np.ndarray:
        longest, n_columns = int(lengths[0]), p.shape[1]
        backward = [np.zeros((active[j], n_columns)) for j in range(longest + 1)]
        which, share = [], []
        for j in range(longest, 0, -1):
            m = active[j]
            ends = lengths[:m] == j
            whole = forward[j][:m][ends]
            backward[j][ends] = weight[:m][ends] / whole
            for k in range(1, min(len(found), j) + 1):
                piece = found[k - 1][starts[:m] + (j - k)]
                hit = np.flatnonzero(piece != self.none)
                if len(hit):
                    step = p[piece[hit]] * backward[j][hit]
                    which.append(piece[hit])
                    share.append(forward[j - k][hit] * step)
                    backward[j - k][hit] += step
        every, part = np.concatenate(which), np.concatenate(share)
        return np.stack([np.bincount(every, part[:, c], len(p)) for c in range(n_columns)], axis=1)


def words_of(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    p: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self, Lattice(self.pieces), {}, np.empty((0, len(self.languages))))


@dataclass
class Scorer:
    """A task's copy of a model with the words that it has met."""

    model: Model
    lattice: Lattice
    known: dict[str, int]
    logs: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """log probability of each text under each language."""
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        met, place = len(self.known), self.known.setdefault
        ids, ends = [], [0]
        for t in texts:
            ids += [place(w, len(self.known)) for w in words_of(t)]
            ends.append(len(ids))
        if len(self.known) > met:
            new, _ = self.lattice.walk(list(islice(self.known, met, None)), self.model.p)
            self.logs = np.concatenate([self.logs[:met], new])
        out = np.zeros((len(texts), self.logs.shape[1]))
        starts, n = np.array(ends[:-1]), np.diff(ends)
        if len(ids):  # each text's own sum, so it does not depend on the texts beside it
            out[n > 0] = np.add.reduceat(self.logs[np.array(ids, np.int64)], starts[n > 0], axis=0)
        return out


def _probabilities(counts: np.ndarray) -> np.ndarray:
    """Rows for the pieces, the unknown character and no piece; languages lean on all of them together."""
    n = len(counts) - 2
    every = counts[:n].sum(axis=1) + 0.5
    every /= every.sum()
    p = counts[:n] + 200.0 * every[:, None]
    return np.concatenate([p / p.sum(axis=0), np.full((1, p.shape[1]), UNKNOWN), np.zeros((1, p.shape[1]))])


def _tally(pieces: list[str], languages: list[str], p: np.ndarray):
    def tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        place = {x: i for i, x in enumerate(languages)}
        sums = np.zeros(p.shape)
        for batch in it:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and lang in place:
                    counts.setdefault(lang, Counter()).update(words_of(text))
            known = list(dict.fromkeys(w for c in counts.values() for w in c))
            if known:
                at = {w: i for i, w in enumerate(known)}
                weight = np.zeros((len(known), len(languages)))
                for lang, c in counts.items():
                    weight[[at[w] for w in c], place[lang]] = list(c.values())
                short = [i for i, w in enumerate(known) if len(w) <= UNSCALED]
                if short:
                    sums += lattice.walk([known[i] for i in short], p, weight[short])[1]
                for i, w in enumerate(known):
                    if len(w) > UNSCALED:
                        sums += lattice.expect_long(w, p, weight[i])
        piece, lang = np.nonzero(sums[: len(pieces)] >= 2**-10)
        # rounded to whole numbers, so that sums do not depend on their order
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(lang), pa.array(np.rint(sums[piece, lang] * 1024).astype(np.int64))], ["piece", "lang", "n"]
        )

    return tally


def learn(labelled: DataFrame, rounds: int = 2, sample_texts: int = SAMPLE_TEXTS, vocabulary: str = VOCABULARY, text: str = "text", lang: str = "lang") -> Model:
    """Fit on rows with a language; at most about ``sample_texts`` of each are used."""
    pieces = read_pieces(vocabulary)
    by = [F.col(text), *([F.col("doc_id")] if "doc_id" in labelled.columns else [])]  # so that not all copies of a text are picked
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(*by).alias("at")).where("lang is not null and text is not null")
    totals = {r.lang: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    languages = sorted(totals)
    if not languages:
        return Model([], pieces, np.zeros((len(pieces) + 2, 0)))
    part = F.element_at(F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, sample_texts / totals[k])))), F.col("lang"))
    sample = saved(rows.where(F.pmod("at", F.lit(1 << 52)) < part * float(1 << 52)), "sample")
    counts = np.ones((len(pieces) + 2, len(languages)))
    for _ in range(rounds):
        dealt = sample.repartition(SAMPLE_PARTS, "at").sortWithinPartitions("at", "lang", "text").select("lang", "text")
        tallied = dealt.mapInArrow(_tally(pieces, languages, _probabilities(counts)), "piece long, lang long, n long")
        counts = np.zeros_like(counts)
        for r in tallied.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():  # pieces times languages at most
            counts[r.piece, r.lang] = r["n"] / 1024
    return Model(languages, pieces, _probabilities(counts))


def language(text: Column, model: Model) -> Column:
    """struct<lang, score>: the likeliest language and its posterior under equal priors."""

    held: list[Scorer] = []  # made once in each task

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(model.scorer())
        plain = [t or "" for t in texts.to_pylist()]
        letters = [bool(model.languages) and any(map(str.isalpha, t)) for t in plain]
        if not any(letters):
            return pa.array([{"lang": "und", "score": 0.0}] * len(plain), pa.struct([("lang", pa.string()), ("score", pa.float64())]))
        log = held[0].score(plain)
        best = log.argmax(axis=1)
        share = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
        names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.where(letters, share, 0.0))], ["lang", "score"])

    return predict(text)


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with the struct ``into``."""
    return docs.withColumn(into, language(F.col(text), model))
