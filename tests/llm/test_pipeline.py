"""The whole pipeline against plain-Python versions of its five stages."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import zstandard

from test_corpus import brute_groups
from test_filters import base, fewest_edits

from framegrid.llm import decontaminate as D
from framegrid.llm import quality as Q

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def good(text: str | None) -> bool:
    raw = (text or "").encode()
    if base(text)[-1]:
        return False
    ratio = lambda part: len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)
    low, high = [(a, b) for least, a, b in Q.BANDS if len(raw) >= least][-1]
    chunks = [raw[i : i + 4096] for i in range(0, len(raw) - 4095, 4096)] + ([raw[-4096:]] if len(raw) > 4096 and len(raw) % 4096 else [])
    odd = sum(not 0.36 <= ratio(c) <= 0.66 for c in chunks)
    return low <= ratio(raw) <= high and 4 * odd <= len(chunks)


def one_of_each(rows: list) -> list:
    groups = brute_groups([(r.doc_id, r.text) for r in rows])
    return [min((rows[i] for i in g), key=lambda r: (r.doc_id is None, r.doc_id)) for g in groups]


def clean(rows: list, items: list[str]) -> list:
    out, known = [], {}
    for r in rows:
        plain = D.normal(r.text)
        if plain not in known:
            text = D.codes(plain).astype(int)
            known[plain] = any(x and fewest_edits(x, text) <= int(0.08 * len(x)) for x in items)
        if not known[plain]:
            out.append(r)
    return out


def goals(sizes: list[int], weights: list[int]) -> list[float]:
    """Shares by weight; what is over three times a source's size goes to the others, until none is."""
    goal, full = [0.0] * len(sizes), set()
    while len(full) < len(sizes):
        left = sum(sizes) - sum(3 * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        for i, w in enumerate(weights):
            goal[i] = 3.0 * sizes[i] if i in full else left * w / weight
        over = {i for i in range(len(sizes)) if i not in full and goal[i] > 3 * sizes[i]}
        if not over:
            break
        full |= over
    return goal


def mixed(rows: list) -> Counter:
    """How often each document is taken."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.doc_id, len((r.text or "").encode().split())))
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in by if s is None]
    sizes = [sum(n for _, _, n in by[s]) for s in names]
    sent = []
    for s, size, goal in zip(names, sizes, goals(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True):
        upto = 0
        for _, doc_id, n in sorted(by[s]):
            upto += n
            sent += [((upto + e * size) / goal, n, doc_id) for e in range(3)]
    by_time = defaultdict(list)
    for at, n, doc_id in sent:
        by_time[at].append((n, doc_id))
    taken, total, out = 0, sum(sizes), Counter()
    for at in sorted(by_time):
        taken += sum(n for n, _ in by_time[at])
        if taken > total:
            break
        out.update(d for _, d in by_time[at])
    return out


def test_pipeline_against_plain_stages(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    items = [D.normal(b.text) for b in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    passed = [r for r in rows if good(r.text)]
    single = one_of_each(passed)
    unleaked = clean(single, items)
    assert len(rows) > len(passed) > len(single) > len(unleaked) > 0
    want = mixed(unleaked)
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter(r.doc_id for r in got) == want
    texts = {r.doc_id: (r.text or "").encode() for r in rows}
    assert all((r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in got)
    shards, sums, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in got:
        shards[texts[r.doc_id]].add(r.shard)
        sums[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shards.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(Counter({t: n * (len(t) + 1) for t, n in Counter(texts[r.doc_id] for r in got).items()}).values())
    assert set(sums) <= set(range(8)) and max(sums.values()) - min(sums.values()) <= largest


def test_stages_on_awkward_tables(spark, clashing, empty):
    """Nulls, empty texts, repeated rows, clashing names and empty tables pass all stages with their columns."""
    for table in (clashing, empty):
        stage = table
        for _, step in corpus_pipeline.STAGES[:4]:
            stage = spark.createDataFrame(step(spark, stage, DATA).collect(), table.schema)
            assert stage.columns == table.columns
        last = corpus_pipeline.STAGES[4][1](spark, stage, DATA)
        assert last.count() == stage.count()
    kept = spark.createDataFrame(corpus_pipeline.STAGES[0][1](spark, clashing, DATA).collect(), clashing.schema)
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in clashing.collect()} and {r._row for r in kept.collect()} == {"x"}
