"""Fill-in-middle: a text is cut at two places into prefix, middle and suffix, which change places around marks.

Places count code points, texts are UTF-8. A text is held as its maximal runs of one character class, the class being the
bytes that a code point takes: each run has the place of its first code point and of its first byte. The run that holds a cut is
found by binary search over the runs' places, and the byte is the run's first byte and the class times the code points from
there. No text is decoded, and a text of one class is one run.

Cases: a null text counts as empty; an empty text, one that holds a mark and the share that is not cut stay plain; cuts may be
equal, so parts may be empty; long texts are scanned in blocks; repeated rows give the same output, as it follows from the id and
the text; a null id counts as empty text; other columns stay, one that has the result's name is replaced; an empty table gives
an empty result. Bytes that begin no code point of valid UTF-8 count as parts of the one before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import unused, utf8

#: Bytes that are scanned at a time.
BLOCK = 1 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"

#: The class of each first byte: how many bytes its code point takes; 0 for bytes that continue one.
CLASS = np.zeros(256, np.int64)
CLASS[:0x80], CLASS[0xC0:0xE0], CLASS[0xE0:0xF0], CLASS[0xF0:] = 1, 2, 3, 4


@dataclass(frozen=True)
class Plan:
    """The seed of the cuts, per cent of texts that are cut, per cent of those that have the suffix first, and the three marks."""

    seed: str = "1"
    cut_percent: int = 90
    suffix_first_percent: int = 20
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")


@dataclass
class Runs:
    """Maximal runs of one class; the last entry of each array closes the text."""

    units: np.ndarray  # code points before the run
    starts: np.ndarray  # bytes before the run
    classes: np.ndarray

    @property
    def n(self) -> int:
        return int(self.units[-1])

    def byte(self, unit: int) -> int:
        """The byte at which the code point ``unit`` begins."""
        i = int(np.searchsorted(self.units, unit, side="right")) - 1
        return int(self.starts[i] + (unit - self.units[i]) * self.classes[i])


def runs(text: bytes) -> Runs:
    units, starts, classes = [], [], []
    seen, last = 0, 0
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data), BLOCK):
        part = CLASS[data[at : at + BLOCK]]
        first = np.flatnonzero(part)
        part = part[first]
        if len(part):
            begin = np.flatnonzero(np.diff(part, prepend=last))  # a run goes on over the border of blocks
            units.append(seen + begin)
            starts.append(at + first[begin])
            classes.append(part[begin])
            seen, last = seen + len(part), int(part[-1])
    return Runs(np.concatenate([*units, [seen]]), np.concatenate([*starts, [len(text)]]), np.concatenate([*classes, [0]]))


def _arranged(text: bytes, held: Runs, h: tuple[int, int, int, int], plan: Plan) -> tuple[str, int | None, int | None, bytes]:
    p, s, m = (x.encode() for x in plan.marks)
    if not held.n or h[2] % 100 >= plan.cut_percent or p in text or s in text or m in text:
        return PLAIN, None, None, text
    a, b = sorted((h[0] % (held.n + 1), h[1] % (held.n + 1)))
    i, j = held.byte(a), held.byte(b)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h[3] % 100 < plan.suffix_first_percent:
        return SPM, a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return PSM, a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def transform(docs: DataFrame, plan: Plan = Plan(), doc_id: str = "doc_id", text: str = "text", into: str = "fim") -> DataFrame:
    """``docs`` with the struct ``into``: code points, form, code points of prefix and middle (null if plain), and the output."""
    firsts = {x[:1] for x in plan.marks}
    if len(set(plan.marks)) < 3 or "" in firsts or any(c in firsts for x in plan.marks for c in x[1:]):
        raise ValueError("marks are three, and what begins one stands at no other place of any")  # else an output could be read in two ways
    rest = docs.drop(into)
    drawn = unused(rest, "drawn")
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    place = rest.columns.index(text)
    kinds = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: list[list] = [[] for _ in kinds]
            for t, h in zip(utf8(batch.column(place)), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                t = t or b""
                held = runs(t)
                for values, v in zip(out, (held.n, *_arranged(t, held, (h["h0"], h["h1"], h["h2"], h["h3"]), plan)), strict=True):
                    values.append(v)
            columns = [pa.array(v, k) if k != pa.string() else pa.array(v, pa.binary() if n == "output" else k) for v, (n, k) in zip(out, kinds, strict=True)]
            columns[-1] = columns[-1].view(pa.string())
            made = pa.StructArray.from_arrays(columns, [n for n, _ in kinds])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*batch.schema.names[:-1], into])

    return rest.withColumn(drawn, F.struct(*numbers)).mapInArrow(run, f"{fields}, `{into}` {SCHEMA}")


def restored(form: Column, output: Column, plan: Plan = Plan()) -> Column:
    """The text that an output was made of, found from the output and its form alone."""
    p, s, m = plan.marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        left = F.substring(body, F.length(one) + len(second) + 1, F.length(output))
        two = F.substring_index(left, m, 1)
        return one, two, F.substring(left, F.length(two) + len(m) + 1, F.length(output))

    prefix, suffix, middle = parts(p, s)
    suffix_1, prefix_1, middle_1 = parts(s, p)
    return F.when(form == PSM, F.concat(prefix, middle, suffix)).when(form == SPM, F.concat(prefix_1, middle_1, suffix_1)).otherwise(output)
