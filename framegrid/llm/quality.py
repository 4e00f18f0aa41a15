"""Quality rules: base counts, then zstandard compression bands.

The ratio of compressed to plain UTF-8 bytes is taken over the whole text and over each full chunk of ``CHUNK`` bytes;
where bytes are left over, the last chunk is the text's final ``CHUNK`` bytes.
Text below the lower limit of its length's band repeats itself; text above the upper limit is noise. Limits follow the
length because short texts carry the frame header and little history; under 64 bytes the header outweighs the text, ratios
of good and bad texts overlap (0.9 to 1.4), and only the base rule decides.

Cases: a null text has no words and fails the base rule, as an empty one does; repeated rows are judged alike; texts of
any length are compressed whole; an empty table gives an empty result; the input's columns stay as they are, and a
column that already has the result's name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import utf8

#: Fixed values, set from labelled documents: UTF-8 length from which a band holds, least and greatest ratio.
BANDS = (
    (0, 0.0, 9.0),
    (64, 0.45, 1.30),
    (128, 0.50, 1.05),
    (256, 0.50, 0.95),
    (512, 0.48, 0.85),
    (1024, 0.44, 0.75),
    (2048, 0.42, 0.70),
    (4096, 0.40, 0.66),
    (8192, 0.39, 0.62),
    (16384, 0.37, 0.60),
    (32768, 0.35, 0.58),
)
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Bytes that begin no code point of a word: white space and UTF-8 continuation bytes.
NOT_COUNTED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))

SCHEMA = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, "
    "base_failed: boolean, kept: boolean, ratio: double, chunks: bigint, odd_chunks: bigint>"
)


@dataclass(frozen=True)
class Rules:
    least_words: int = 10
    most_repeated: int = 20
    level: int = 3
    chunk: int = 4096
    #: Least and greatest ratio of a full chunk, and the greatest share of chunks outside of them.
    chunk_band: tuple[float, float] = (0.36, 0.66)
    odd_share: float = 0.25
    bands: tuple[tuple[int, float, float], ...] = BANDS


def dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[bytes] = set()
    count = 0
    for line in lines:
        if line in seen:
            count += 1
        elif line.strip():
            seen.add(line)
    return count


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    starts: set[int] = set()
    for i, w in enumerate(windows):
        if (j := first.setdefault(w, i)) != i:
            starts.update((i, j))
    covered, end = 0, 0
    for i in sorted(starts):
        covered += i + window - max(i, end)
        end = i + window
    return covered


def bands(text: bytes, rules: Rules, pack: zstandard.ZstdCompressor) -> tuple[bool, float, int, int]:
    """The method's verdict, the whole text's ratio, chunks and those out of band."""
    size = len(text)
    ratio = len(pack.compress(text)) / size if size else 0.0
    low, high = next((lo, hi) for least, lo, hi in reversed(rules.bands) if size >= least)
    chunks = -(-size // rules.chunk) if size >= rules.chunk else 0
    odd = 0
    for i in range(chunks):
        start = min(i * rules.chunk, size - rules.chunk)
        r = len(pack.compress(text[start : start + rules.chunk])) / rules.chunk
        odd += not rules.chunk_band[0] <= r <= rules.chunk_band[1]
    return low <= ratio <= high and odd <= rules.odd_share * chunks, ratio, chunks, odd


def quality(text: Column, rules: Rules | None = None) -> Column:
    """A struct of counts and verdicts for each text."""
    rules = rules or Rules()

    @F.arrow_udf(SCHEMA)
    def measure(texts: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor(level=rules.level)
        out: list[list] = [[] for _ in range(10)]
        for t in utf8(texts):
            t = t or b""
            words = t.split()
            n, repeated = len(words), repeat_words(words)
            failed = n < rules.least_words or 100 * repeated > rules.most_repeated * n
            good, ratio, chunks, odd = bands(t, rules, pack)
            row = (
                n, len(t.translate(None, NOT_COUNTED)), len(t) - len(t.translate(None, SYMBOLS)), dup_lines(t), repeated,
                failed, good and not failed, ratio, chunks, odd,
            )
            for values, v in zip(out, row, strict=True):
                values.append(v)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
        names = [
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "chunks",
            "odd_chunks",
        ]
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names)

    return measure(text)


def judge(docs: DataFrame, rules: Rules | None = None, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with the struct ``into``."""
    return docs.withColumn(into, quality(F.col(text), rules))


def keep(docs: DataFrame, rules: Rules | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return docs.where(quality(F.col(text), rules)["kept"])
