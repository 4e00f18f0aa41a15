"""Fill-in-middle, byte-level BPE and alignment against plain versions of their own."""

from __future__ import annotations

import base64
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from framegrid.llm import byte_bpe, fill_in_middle, queries, token_alignment

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ODD = [
    "", " ", "a", "  x", "\n\n \t", "don't we'll", "漢字かな交じり文", "naïve Ünïcode nbsp", "🙂🙃👩‍👩‍👧 emoji", "12345 6.78", "<|endoftext|> <s> </s> <unk> <0x41>", "▁▁x",
    "a" * 3000, "ab" * 2000, " " * 5000 + "x", "\x00\x01\x1c", "é" * 999, "\U0001fae8 ՘ \U0003fffd", "<P>marks</P>", "ends with <", "<<P", "x" + chr(0xFFFD),
]


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# fill-in-middle


def plain_fim(doc_id, text: str) -> tuple:
    d = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if spm else "psm", a, b - a, sha(out), sha(text)


def test_runs():
    for t in [*ODD, "é" * 10 + "a" * 5 + "漢🙂" * 3]:
        data = t.encode()
        held = fill_in_middle.runs(data)
        assert held.n == len(t) and [held.byte(i) for i in range(len(t) + 1)] == [len(t[:i].encode()) for i in range(len(t) + 1)]
        assert (np.diff(held.classes[:-1]) != 0).all()  # runs are maximal


def test_runs_over_blocks(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "BLOCK", 7)
    test_runs()


@pytest.mark.parametrize("seed", range(4))
def test_fim_of_any_table(spark, docs, clashing, empty, seed):
    plan = fill_in_middle.Plan(seed=str(seed), cut_percent=100, suffix_first_percent=50)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    out = fill_in_middle.transform(odd, plan).select("*", fill_in_middle.restored(*(fill_in_middle.F.col(f"fim.{c}") for c in ("form", "output")), plan).alias("back"))
    rows = out.collect()
    assert all(r.back == r.text for r in rows) and {r.fim.form for r in rows} == {"plain", "psm", "spm"}
    if seed == 0:
        assert fill_in_middle.transform(empty).count() == 0
        wide = fill_in_middle.transform(clashing.withColumn("fim", fill_in_middle.F.lit(1)))
        assert wide.columns == [*clashing.columns, "fim"] and wide.count() == docs.count()
        with pytest.raises(ValueError):
            fill_in_middle.transform(odd, fill_in_middle.Plan(marks=("<P>", "<<", "x")))


def test_op11(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in queries.op11_run_lengths(spark, str(tmp_path)).collect())
    assert got == Counter((r.doc_id, *plain_fim(r.doc_id, r.text or "")) for r in docs.collect())


def test_op11_against_sql(spark, against_sql):
    against_sql(queries.op11_run_lengths(spark, DATA), entry.oracle_sql()["op11_run_lengths"])


# byte-level BPE


def ranks() -> dict[bytes, int]:
    with open(f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def model():
    return byte_bpe.read_vocabulary(f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken", queries.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks(), special_tokens={})


def test_perfect_hash(model):
    h = model.hash
    assert sorted(h.key.tolist()) == list(range(len(model.entries)))  # as many slots as entries, each taken once
    rng = random.Random(1)
    strange = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 60))) for _ in range(3000)] + [e + b"x" for e in model.entries[300:900]]
    asked = model.entries + strange
    lengths = np.array([len(x) for x in asked])
    found = h.find(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(lengths) - lengths, lengths)
    at = {e: i for i, e in enumerate(model.entries)}
    assert found.tolist() == [at.get(x, -1) for x in asked]
    for keys in ([b"a"], [b"a", b"b"], [bytes([i]) for i in range(256)], [b"x" * i for i in range(1, 40)]):
        small = byte_bpe.PerfectHash(keys)
        n = np.array([len(k) for k in keys])
        assert small.find(np.frombuffer(b"".join(keys), np.uint8), np.cumsum(n) - n, n).tolist() == list(range(len(keys)))
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash([b"a", b"a"])


def plain_merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        r, i = min((rank.get(x + y, 1 << 30), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)))
        if r == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [rank[p] for p in parts]


def test_merges_by_heap():
    rng = random.Random(0)
    for _ in range(200):  # small vocabularies with many ties and overlaps
        rank = {bytes([b]): b for b in range(256)}
        for _ in range(30):
            a, b = rng.sample(sorted(k for k in rank if set(k) <= set(b"abc")), 2)
            rank.setdefault(a + b, len(rank))
        piece = bytes(rng.choices(b"abc", k=rng.randrange(1, 60)))
        assert byte_bpe.merged(piece, rank, byte_bpe.pairs_of_bytes(rank)) == plain_merge(piece, rank)


def test_short_pieces_need_no_heap(model, monkeypatch):
    """Pieces about the bound, by search and by heap, against the definition."""
    rng = random.Random(11)
    rank = {e: int(i) for e, i in zip(model.entries, model.ids, strict=True)}
    pairs = byte_bpe.pairs_of_bytes(rank)
    words = ["".join(rng.choices("etaoinshr dlu", k=rng.randrange(2, 45))).encode() for _ in range(300)] + [b"a" * k for k in range(1, 40)] + ["é漢ж".encode() * 3, bytes(range(200, 230))]
    want = [plain_merge(w, rank) for w in words]
    for bound in (0, byte_bpe.SHORT_PIECE, 100):
        monkeypatch.setattr(byte_bpe, "SHORT_PIECE", bound)
        assert [byte_bpe.merged(w, rank, pairs) for w in words] == want

    def no_heap(*_):
        raise AssertionError("a heap for a short piece")

    monkeypatch.undo()
    monkeypatch.setattr(byte_bpe.heapq, "heapify", no_heap)
    assert byte_bpe.merged(b" thonerenhast", rank, pairs) == plain_merge(b" thonerenhast", rank)


def random_texts() -> list[str]:
    rng = random.Random(5)
    pool = [*map(chr, range(32, 127)), *"éàüßñçœ漢字かなкириллица  \n\t  ٣४", *(chr(rng.randrange(0x80, 0x3000)) for _ in range(300)), *(chr(rng.randrange(0x1F300, 0x1FAFF)) for _ in range(60))]
    later = [chr(c) for c in sorted(byte_bpe.later_code_points())[::97]]
    return ["".join(rng.choices(pool + later * (i % 2), k=rng.randrange(0, 400))) for i in range(300)]


def test_encoder_is_the_library(model, reference):
    texts = ODD + random_texts()
    for at in (1 << 19, 50):  # whole groups, and parts between matches
        byte_bpe.GROUP_CHARS, held = at, byte_bpe.GROUP_CHARS
        try:
            ids, n = model.encoder().encode(texts)
        finally:
            byte_bpe.GROUP_CHARS = held
        want = [reference.encode_ordinary(t) for t in texts]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    decoder = model.decoder()
    assert [decoder.decode(np.array(x, np.int64)) for x in want] == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        decoder.decode(np.array([99999]))


def test_long_texts_and_kept_words(model, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 1000)
    monkeypatch.setattr(byte_bpe, "GROUP_MATCHES", 16)
    encoder = model.encoder()
    text = "".join(f" qzx{i}w" for i in range(500))
    few = model.encoder().encode([text[:200]])[0]
    ids, _ = encoder.encode([text, text])
    assert ids[: len(ids) // 2].tolist() == ids[len(ids) // 2 :].tolist() and ids[: len(few) - 3].tolist() == few[:-3].tolist()
    assert model.decoder().decode(ids.astype(np.int64)) == (text * 2).encode()
    blank, n = model.encoder().encode([" " * 2_000_000 + "x"])  # the library gives up here
    assert model.decoder().decode(blank.astype(np.int64)) == b" " * 2_000_000 + b"x"


def plain_op13(reference, text: str) -> tuple:
    ids = reference.encode_ordinary(text)
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text)


def test_op13(spark, docs, reference, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in queries.op13_two_tier_bpe(spark, str(tmp_path)).collect())
    assert got == Counter((r.doc_id, *plain_op13(reference, r.text or "")) for r in docs.collect())


def test_op13_whole_table(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in queries.op13_two_tier_bpe(spark, DATA).collect()}
    assert got == {i: plain_op13(reference, t) for i, t in texts.items()}


def test_bpe_of_any_table(spark, clashing, empty, model, reference):
    wide = byte_bpe.encode(clashing.withColumn("ids", byte_bpe.F.lit(1)), model)
    rows = byte_bpe.decode(wide, model).collect()
    assert all(list(r.ids) == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(empty, model), model).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), model).first().decoded == b""
    with pytest.raises(ValueError):
        byte_bpe.vocabulary({b"a": 0}, ".")


# alignment


def plain_alignment(texts: list[str]) -> list[tuple]:
    """Ends as sets, groups token by token, all pairs written out."""
    a = Tokenizer.from_file(f"{queries.TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{queries.TOKENIZERS}/piece_bpe_32k.model")
    printable = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    signs = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def bytes_a(i: int) -> bytes:
        return bytes(signs[c] for c in a.id_to_token(i))

    def bytes_b(i: int) -> bytes:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    rows, held = [], []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        want = (" " + t).encode()
        if not t or b"".join(map(bytes_a, x)) != want or b"".join(map(bytes_b, y)) != want:
            rows.append((0, 0, [], ""))
            held.append([])
            continue
        sides = []
        for ids, of in ((x, bytes_a), (y, bytes_b)):
            end, ends = 0, []
            for i in ids:
                end += len(of(i))
                ends.append(end)
            sides.append(ends)
        shared = set(sides[0]) & set(sides[1])
        groups = []
        for ids, ends in zip((x, y), sides, strict=True):
            parts, part = [], []
            for i, e in zip(ids, ends, strict=True):
                part.append(i)
                if e in shared:
                    parts.append(part)
                    part = []
            groups.append(parts)
        pairs = [(p, q) for g, k in zip(*groups, strict=True) for p in g for q in k]
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, k))}" for g, k in zip(*groups, strict=True))
        rows.append((len(x), len(y), groups[0], sha(text)))
        held.append(pairs)
    count = Counter(p for pairs in held for p in set(pairs))
    best: dict[int, int] = {}
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    return [
        (n_a, n_b, len(groups), len(pairs), sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs), digest)
        for (n_a, n_b, groups, digest), pairs in zip(rows, held, strict=True)
    ]


def rows_of(df) -> Counter:
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_intervals():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})) for _ in range(2))
        found = token_alignment.align(a, b)
        spans = [[(lo, hi) for lo, hi in zip([0, *x.tolist()], x.tolist(), strict=False)] for x in (a, b)]
        want = [(i, j) for i, (p, q) in enumerate(spans[0]) for j, (r, s) in enumerate(spans[1]) if max(p, r) < min(q, s)]
        assert sorted(zip(found.overlap_a.tolist(), found.overlap_b.tolist(), strict=True)) == sorted(want)
        assert found.groups == len(set(a.tolist()) & set(b.tolist()))
        ids = [np.array([rng.randrange(4) for _ in x]) for x in (a, b)]
        keys, times = token_alignment.linked(ids[0], ids[1], found)
        plain = Counter((int(p) << 32) | int(q) for p, g in zip(ids[0], found.group_a, strict=True) for q, h in zip(ids[1], found.group_b, strict=True) if g == h)
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == plain and (np.diff(keys) > 0).all()


def test_long_groups_and_long_texts(monkeypatch):
    """Groups in which ends never meet: the products of different ids, some at a time, are those of all tokens."""
    rng = np.random.default_rng(0)
    a, b = np.append(np.arange(2, 3000, 2), 3001), np.append(np.arange(1, 3000, 2), 3001)
    ids = [rng.integers(0, 40, len(x)) for x in (a, b)]
    found = token_alignment.align(a, b)
    assert found.groups == 1
    want = Counter((int(p) << 32) | int(q) for p in ids[0] for q in ids[1])
    for made in (1 << 20, 100):
        monkeypatch.setattr(token_alignment, "MADE_PRODUCTS", made)
        keys, times = token_alignment.linked(*ids, found)
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == want
    model = token_alignment.ByteLevel.read(f"{queries.TOKENIZERS}/byte_bpe_50k.json", queries.PATTERN)
    texts = ODD + random_texts()[:50]
    plain = [x.tolist() for x in model.open()(texts)]
    monkeypatch.setattr(token_alignment, "LIBRARY_CHARS", -1)
    assert [x.tolist() for x in model.open()(texts)] == plain


@pytest.mark.parametrize("limits", [(1 << 19, 1 << 25), (40, 1 << 25), (1 << 19, 2000)])
def test_op12(spark, docs, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(token_alignment, "BLOCK_PAIRS", limits[0])
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", limits[1])
    monkeypatch.setattr(token_alignment, "GROUP_CHARS", 1 << (19 if limits[0] > 40 else 9))
    odd = spark.createDataFrame([(900 + i, t, None, None, 0) for i, t in enumerate([*ODD, *random_texts()[:60]])], docs.schema)
    table = docs.union(odd)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    rows = table.collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, plain_alignment([r.text or "" for r in rows]), strict=True))
    assert rows_of(queries.op12_elementary_intervals(spark, str(tmp_path))) == want


def test_op12_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, plain_alignment([r.text or "" for r in rows]), strict=True))
    assert rows_of(queries.op12_elementary_intervals(spark, DATA)) == want


def test_alignment_of_any_table(spark, clashing, empty):
    a = token_alignment.ByteLevel.read(f"{queries.TOKENIZERS}/byte_bpe_50k.json", queries.PATTERN)
    b = token_alignment.Pieces.read(f"{queries.TOKENIZERS}/piece_bpe_32k.model")
    assert token_alignment.links(empty, a, b).count() == 0
    text_ids = clashing.withColumn("doc_id", token_alignment.F.concat(token_alignment.F.lit("id"), "doc_id"))
    assert token_alignment.links(text_ids, a, b).count() == clashing.count()
