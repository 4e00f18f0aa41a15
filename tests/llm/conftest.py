"""Small tables that hold the awkward cases."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = "ta ko mi ren su el dor va lin que por as ti on er".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def documents() -> list[tuple]:
    rows = [(i, prose(i, 40 + i), "en" if i % 2 else "fr", f"s{i % 4}", 0) for i in range(40)]
    rows += [(100 + i, rows[3][1], "en", "s0", 0) for i in range(12)]  # copies
    rows += [(200 + i, rows[5][1].replace(" ", "  ", i) + f" end{i}", "en", "s1", 0) for i in range(6)]  # near copies
    shared = prose(99, 70)
    rows += [(300 + i, f"{prose(300 + i, 20)} {shared} {prose(400 + i, 15)}", "fr", None, 0) for i in range(5)]
    rows += [
        (500, None, None, None, None), (501, "", "en", "s0", 0), (502, " \n\t ", None, "s9", 0), (503, "one", "en", "s0", 3), (504, "a b c d", "en", "s0", 7),
        (None, "no id but some words here", "en", None, 5), (None, None, "en", None, None), (505, "x" * 5000, "fr", "s2", 5000), (506, prose(7, 20000), "en", "s0", 0),
        (507, "la la la " * 200, "fr", "s3", 0), (508, "漢字 кириллица Ünïcode\u00a0nbsp\x1cfs", "en", "s3", 0), (1, prose(1, 41), "en", "s1", 0), (1, "same id, other text " * 20, "en", "s1", 0),
    ]
    return rows + [rows[0], rows[0]]  # repeated rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with columns that operators use as names."""
    names = ["key", "row", "id", "tid", "size", "quality", "leak", "shard", "_row", "finish", "held", "block", "bucket", "set_key"]
    return docs.selectExpr("*", *(f"'x' as `{n}`" for n in names))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
