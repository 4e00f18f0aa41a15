"""Quality rules, language, decontamination, urls and html, against plain Python."""

from __future__ import annotations

import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from pyspark.sql import functions as F

from framegrid.llm import decontaminate as D
from framegrid.llm import html_extract as H
from framegrid.llm import language_id as L
from framegrid.llm import quality as Q
from framegrid.llm import queries
from framegrid.llm import url_filters as U

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked), n < 10 or 100 * len(marked) > 20 * n)


def test_quality_counts_and_verdicts(docs):
    rows = Q.judge(docs).select("text", "quality.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
        size = len((r.text or "").encode())
        if size:
            assert r.ratio == len(zstandard.ZstdCompressor(level=3).compress(r.text.encode())) / size
        low, high = [(a, b) for least, a, b in Q.BANDS if size >= least][-1]
        raw = (r.text or "").encode()
        chunks = [raw[i : i + 4096] for i in range(0, size - 4095, 4096)] + ([raw[-4096:]] if size > 4096 and size % 4096 else [])
        odd = sum(not 0.36 <= len(zstandard.ZstdCompressor(level=3).compress(c)) / 4096 <= 0.66 for c in chunks)
        assert (r.chunks, r.odd_chunks) == (len(chunks), odd)
        assert r.kept == (not r.base_failed and low <= r.ratio <= high and 4 * odd <= len(chunks))


def test_quality_rejects_repetition_and_noise():
    pack, rules = zstandard.ZstdCompressor(level=3), Q.Rules()
    noise = random.Random(0).randbytes(20000).hex().encode()
    assert not Q.bands(b"abcdefgh " * 3000, rules, pack)[0]
    assert not Q.bands(bytes(random.Random(1).choices(range(33, 127), k=20000)), rules, pack)[0]
    assert Q.bands(noise[:40], rules, pack)[0]


def test_chunks_cover_the_whole_text():
    pack, rules = zstandard.ZstdCompressor(level=3), Q.Rules()
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(900)]
    good = " ".join(rng.choices(words, k=4000)).encode()
    noise = random.Random(5).randbytes(4008)
    assert Q.bands(good[:12200], rules, pack)[2:] == (3, 0)
    assert Q.bands(good[:8192] + noise, rules, pack)[2:] == (3, 1) and not Q.bands(good[:8192] + noise, rules, pack)[0]
    assert [Q.bands(good[:n], rules, pack)[2] for n in (4095, 4096, 4097, 8192)] == [0, 1, 2, 2]


def test_quality_keeps_labelled_documents(spark):
    good = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").select("doc_id")
    rows = Q.judge(spark.read.parquet(f"{DATA}/documents.parquet").join(good, "doc_id")).select("quality.*").collect()
    assert rows and all(r.kept for r in rows if not r.base_failed)


def test_quality_keeps_columns(clashing, empty):
    kept = Q.keep(clashing)
    assert kept.columns == clashing.columns and 0 < kept.count() < clashing.count()
    assert Q.judge(clashing).columns == clashing.columns
    assert Q.keep(empty).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return L.read_pieces()


def test_forward_sums_all_segmentations(pieces):
    rng = np.random.default_rng(0)
    p = L._probabilities(rng.random((len(pieces) + 2, 2)) * 50)
    at = {x: i for i, x in enumerate(pieces)}

    def plain(word, c):
        s = "▁" + word
        a = [1.0] + [0.0] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - L.LONGEST), j):
                if s[i:j] in at:
                    a[j] += a[i] * p[at[s[i:j]], c]
                elif j - i == 1:
                    a[j] += a[i] * L.UNKNOWN
        return np.log(a[-1])

    words = ["the", "schreibung", "été", "ñandú", "x", "漢字", "a" * 50, "verwaltungsvorschrift" * 3]
    lattice = L.Lattice(pieces)
    log, _ = lattice.walk(words, p)
    assert np.allclose(log, [[plain(w, c) for c in (0, 1)] for w in words], rtol=1e-9)
    _, counts = lattice.walk(["the", "été"], p, np.array([[2.0, 0], [0, 3.0]]))
    lengths = np.array([len(x) for x in pieces] + [1, 0])
    assert np.allclose(counts.T @ lengths, [2 * 4, 3 * 4])  # expected pieces cover each word's characters


def plain_probabilities(counts, n, languages):
    every = [sum(counts[i]) + 0.5 for i in range(n)]
    share = [e / sum(every) for e in every]
    p = [[counts[i][c] + 200.0 * share[i] for c in range(languages)] for i in range(n)]
    total = [sum(p[i][c] for i in range(n)) for c in range(languages)]
    return [[p[i][c] / total[c] for c in range(languages)] for i in range(n)]


def segmentations(s, at):
    """All ways to cut s into known pieces or single characters."""
    if not s:
        yield []
    for j in range(1, len(s) + 1):
        if s[:j] in at or j == 1:
            for rest in segmentations(s[j:], at):
                yield [s[:j], *rest]


def test_op2_against_brute_force(spark, monkeypatch):
    """Learning and prediction over a tiny vocabulary, all segmentations listed one by one."""
    small = sorted(["▁", "▁a", "a", "b", "c", "ab", "▁ab", "bc", "abc", "d", "▁d", "cd"])
    monkeypatch.setattr(L, "read_pieces", lambda path: small)
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(1, 5)))
    monkeypatch.setattr(L, "UNSCALED", 3)  # half of the words count as long ones
    rows = [(i, " ".join(word("aab" if i % 2 else "bcd") for _ in range(4)), "x" if i % 2 else "y") for i in range(40)]
    rows += [(90, "zz q", "x"), (91, "123 !", "y"), (92, None, "y"), (93, "ab cd", None), (94, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = L.learn(docs.where("doc_id % 3 != 1"))
    assert model.languages == ["x", "y"]
    at = {x: i for i, x in enumerate(small)}
    counts = [[1.0, 1.0] for _ in small]
    for _ in range(2):
        p = plain_probabilities(counts, len(small), 2)
        counts = [[0.0, 0.0] for _ in small]
        for d, text, lang in rows:
            if d % 3 != 1 and text and lang:
                c = "xy".index(lang)
                for w in text.split():
                    ways = [(s, float(np.prod([p[at[x]][c] if x in at else L.UNKNOWN for x in s]))) for s in segmentations("▁" + w, at)]
                    total = sum(v for _, v in ways)
                    for s, v in ways:
                        for x in s:
                            if x in at:
                                counts[at[x]][c] += v / total
    p = plain_probabilities(counts, len(small), 2)
    assert np.allclose(model.p[: len(small)], p, atol=1e-4)
    for r in L.identify(docs, model).collect():
        logs = [0.0, 0.0]
        for w in (r.text or "").split():
            for c in (0, 1):
                logs[c] += np.log(sum(float(np.prod([p[at[x]][c] if x in at else L.UNKNOWN for x in s])) for s in segmentations("▁" + w, at)))
        if not any(map(str.isalpha, r.text or "")):
            assert tuple(r.language) == ("und", 0.0)
        elif abs(logs[0] - logs[1]) > 0.01:
            assert r.language.lang == "xy"[int(logs[1] > logs[0])] and abs(r.language.score - 1 / (1 + np.exp(-abs(logs[0] - logs[1])))) < 1e-3


def test_long_words_are_summed_whole(pieces):
    p = L._probabilities(np.random.default_rng(1).random((len(pieces) + 2, 3)) * 50)
    lattice = L.Lattice(pieces)
    words = ["verwaltungsvorschrift" * 11, "x" * 200, "漢字かな" * 60]
    short, _ = lattice.walk(words, p)
    assert np.allclose([lattice.walk_long(w, p) for w in words], short, rtol=1e-9)
    assert np.isfinite(lattice.walk(["ab" * 5000, "the"], p)[0]).all()


def test_long_words_are_fitted_whole(pieces, monkeypatch):
    """Expected pieces of long words are those of the sums without a scale, where those still work, and add up to the word's characters."""
    p = L._probabilities(np.random.default_rng(2).random((len(pieces) + 2, 3)) * 50)
    lattice = L.Lattice(pieces)
    weight = np.array([1.0, 0.0, 2.5])
    lengths = np.array([len(x) for x in pieces] + [1, 0])
    for word in ("verwaltungsvorschrift" * 5, "x" * 100, "漢字かな" * 10, "a"):
        want = lattice.walk([word], p, weight[None])[1]
        for block in (4096, 7):
            monkeypatch.setattr(L, "LONG_BLOCK", block)
            got = lattice.expect_long(word, p, weight)
            assert np.allclose(got, want, rtol=1e-9) and np.allclose(lengths @ got, weight * (len(word) + 1))
    assert np.allclose(lengths @ lattice.expect_long("ab" * 3000, p, weight), weight * 6001)


def test_scores_do_not_depend_on_the_texts_beside(docs):
    model = L.learn(docs)
    texts = [r.text or "" for r in docs.collect()]
    together = model.scorer().score(texts)
    alone = np.concatenate([model.scorer().score([t]) for t in texts])
    assert (together == alone).all()


def test_models_do_not_depend_on_partitions(docs):
    one, two = (L.learn(docs.repartition(n)).p for n in (2, 7))
    assert (one == two).all()


def test_language_on_held_out_texts(spark):
    found = queries.op2_segment_unigrams(spark, DATA).alias("p").join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_cases(docs, clashing, empty):
    model = L.learn(docs)
    rows = L.identify(clashing.select("*"), model).select("text", "language.*").collect()
    for r in rows:
        assert (r.lang == "und") == (not any(map(str.isalpha, r.text or ""))) and r.lang in ("en", "fr", "und")
    assert {r.lang for r in L.identify(docs, L.learn(empty)).select("language.lang").collect()} == {"und"}
    assert L.identify(empty, model).count() == 0


def edits(a: str, b: str) -> int:
    """Fewest edits of a against any part of b."""
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_decontamination_against_brute_force():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeo", k=rng.randint(2, 7)))
    items = [" ".join(word() for _ in range(rng.randint(3, 30))) for _ in range(12)] + ["tiny", "exact q ab"]
    texts = []
    for i in range(60):
        body = [word() for _ in range(30)]
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, max(1, len(item) // 10))):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice(["", "z", item[at] + "y"])
        body.insert(rng.randrange(30), "".join(item) if i % 3 else "")
        texts.append(D.normal(" ".join(body)))
    index = D.Index(list(range(len(items))), [D.normal(x) for x in items], 10, 0.08)
    found = index.find(texts)
    for text, got in zip(texts, found, strict=True):
        want = {i: edits(x, text) for i, x in enumerate(index.texts)}
        assert got == {i: e for i, e in want.items() if e <= index.k[i]}


def test_fewest_edits_of_several_places():
    item = "what is the height of the tallest mountain in the country"
    index = D.Index([7], [item], 10, 0.08)
    assert index.find([item.replace("height", "hieght") + " and then " + item]) == [{0: 0}]
    assert index.find([item[:-3] + "xyz and " + item.replace("tallest", "talest")]) == [{0: 1}]


def test_short_items_keep_their_share_of_edits():
    for m in range(10, 45):
        item = "".join(random.Random(m).choices("abcdefgh ", k=m)).replace("  ", "xy").strip().ljust(m, "q")
        index = D.Index([1], [item], 10, 0.08)
        k = int(0.08 * m)
        assert index.k[0] == k and (m < 10 or index.bound[0] >= 1)
        rng = random.Random(m + 100)
        damaged = list(item)
        for at in rng.sample(range(m), k):
            damaged[at] = "Z"
        assert index.find(["0123 " + "".join(damaged) + " 4567"]) == [{0: edits(item, "0123 " + "".join(damaged) + " 4567")}]


def test_decontamination_cases(spark, docs, clashing, empty):
    item = "Secret  Question about the mountain and the river that nobody may see"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, item)], "item_id long, text string")
    more = docs.unionByName(spark.createDataFrame([(900, "pre " + item.upper() + " post", "en", "s", 0), (901, "x" * 3000 + item.replace("river", "rivr") + "y", "en", "s", 0)], docs.schema))
    rows = {r.doc_id: r.leak["items"] for r in D.flag(more, bench).collect() if r.leak["items"]}
    assert rows == {900: [1, 4], 901: [1, 4]}
    assert D.clean(clashing, bench).columns == clashing.columns
    assert D.clean(more, bench).count() == docs.count()
    assert D.clean(docs, bench.where("false")).count() == docs.count() and D.clean(empty, bench).count() == 0
    D.BLOCK_CHARS, kept = 60, D.BLOCK_CHARS
    try:
        in_blocks = {r.doc_id: (r.leak["items"], r.leak["edits"]) for r in D.flag(more, bench).collect() if r.leak["items"]}
        assert in_blocks == {900: ([1, 4], [0, 0]), 901: ([1, 4], [1, 1])}
        assert D.flag(clashing, bench).columns == clashing.columns and D.clean(more, bench).count() == docs.count()
    finally:
        D.BLOCK_CHARS = kept


def fewest_edits(item: str, text: np.ndarray) -> int:
    """As ``edits``, one row of the table at a time."""
    row, steps = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for c in map(ord, item):
        best = row + 1
        best[1:] = np.minimum(best[1:], row[:-1] + (text != c))
        row = np.minimum.accumulate(best - steps) + steps
    return int(row.min())


def test_op10_against_brute_force(spark):
    tables = {t: spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("documents", "benchmark")}
    got = {r.doc_id: (r.contaminated, list(zip(r.item_ids, r.edits, strict=True))) for r in queries.op10_qgram_lemma(spark, DATA).collect()}
    items = sorted((b.item_id, D.normal(b.text)) for b in tables["benchmark"])
    assert len(got) == len(tables["documents"])
    known = {}
    for d in tables["documents"]:
        plain = D.normal(d.text)
        if plain not in known:
            text = D.codes(plain).astype(np.int64)
            known[plain] = [(i, e) for i, x in items if x and (e := fewest_edits(x, text)) <= int(0.08 * len(x))]
        assert got[d.doc_id] == (bool(known[plain]), known[plain])


def test_cascade_is_exact(spark):
    universe = spark.range(5000).selectExpr("concat('h', id, '.example') as key")
    listed = universe.where("hash(key) % 7 = 0")
    cascade = U.BloomCascade.build(universe, listed, bits_per_key=4, hashes=2)
    wrong = universe.withColumn("hit", cascade.holds(F.col("key"))).where("hit != (hash(key) % 7 = 0)")
    assert wrong.count() == 0 and len(cascade.levels) > 2


def test_urls(spark, against_sql):
    df = queries.op7_url_filter(spark, DATA)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()
    against_sql(df, queries.oracle_sql()["op7_url_filter"])


def test_url_cases(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.NET", "x://a.b.net/p", "http://www.Example.NET/en/x?q#f", "https://example.com/de/", "http://notexample.com/de/", "ftp://Spam.org/x://y", "http://spam.org?x", "http://net"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("spam.org",), (None,)], "key string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in U.judge(df, listed, queries.URL_RULES).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "", None, "allow"), ("a.b.net", "/p", "net/", "block"),
        ("www.example.net", "/en/x", "example.net/en/", "allow"), ("example.com", "/de/", "example.com/de/", "block"), ("notexample.com", "/de/", None, "allow"),
        ("spam.org", "/x://y", None, "block"), ("spam.org", "", None, "block"), ("net", "", None, "allow"),
    ]
    assert U.judge(df.where("false"), listed, queries.URL_RULES).count() == 0
    assert U.judge(df, listed.where("false"), []).where("verdict = 'block'").count() == 0


def test_main_text_of_pages(spark):
    def plain(page):
        import html

        part = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", part)]
        return "\n".join(b for b in blocks if b)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.op9_scoring_subsequence(spark, DATA).collect():
        assert r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text)


def test_html_cases(spark):
    words = "many words of the main story that goes on for a while and says something of interest"
    page = (
        f"<html><body><nav><a>menu</a></nav><div class='sidebar'><p>{words}</p></div><article><header><h1>Title &amp; more</h1></header><p>{words} a&nbsp;b<b>c</b><br>d"
        f"<aside>not this</aside><form>nor this</form><ul><li>one<li>two</ul><script>var x='<p>no</p>'</script><p>{words}</p><div id=comments><p>shouting</p></div></article><footer>end</footer>"
    )
    scorer = H.learn(spark.createDataFrame([(page,)] * 3, "html string"))
    text = scorer.extract(page)
    assert text.split("\n") == ["Title & more", f"{words} a bc d", "one", "two", words]
    odd = [None, "", "plain text only", "<", "<p", "<p>a < b</p>", "<script>x", "<!-- open", "<a b='c>" + "d" * 50, "&am &lt;tag&gt; &#x41;", "<div>" * 3000 + "deep"]
    df = spark.createDataFrame([(i, None, o) for i, o in enumerate(odd)], "page_id long, text string, html string")
    got = {r.page_id: r.text for r in H.extract(df, scorer=H.learn(df)).collect()}
    assert got[0] == got[1] == "" and got[2] == "plain text only" and got[5] == "a < b" and got[9] == "&am <tag> A" and got[10] == "deep"
    assert H.extract(df.where("false")).count() == 0


def learned(pages):
    sums = Counter()
    for page in pages:
        H.count(page, sums)
    inside, outside = (sum(n for (_, labelled), n in sums.items() if labelled is k) for k in (True, False))
    share = np.log((outside + 1) / (inside + 1))
    return H.Scorer({k: (np.log((sums[k, True] + 0.5) / (sums[k, False] + 0.5)) + share, sums[k, True] + sums[k, False]) for k, _ in sums})


def unlabelled(page):
    for name, box in (("article", "c7"), ("nav", "t1"), ("footer", "b2")):
        page = page.replace(f"<{name}>", f'<div class="{box}">').replace(f"</{name}>", "</div>")
    return page


def test_learned_weights_decide_on_pages_without_labels(spark):
    pages = [r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    scorer = H.learn(spark.createDataFrame([(p,) for p in pages], "html string").repartition(3))
    want = learned(pages).learned
    assert scorer.learned.keys() == want.keys() and all(np.isclose(scorer.learned[k], want[k]).all() for k in want)
    right = [scorer.extract(unlabelled(p)) == scorer.extract(p) for p in pages]
    assert sum(right) >= 0.95 * len(right)
    assert sum(H.Scorer().extract(unlabelled(p)) == scorer.extract(p) for p in pages) < 0.5 * len(pages)


def test_marks_are_whole_names():
    kept = '<h1 class="post-header">A</h1><h2 class="section-header">B</h2><p class="share-price">C</p><p id="notice-of-meeting">D</p><div class="share-price">E</div>'
    gone = '<div class="comment-list"><p>x y z</p></div><p class="notice">n</p><ul class="menu"><li>m</ul><section id="related-links">r</section><div role="navigation">v</div>'
    assert H.Scorer().extract(f"<article>{kept}{gone}<p>F</article>") == "A\nB\nC\nD\nE\nF"


def test_links_around_the_main_text():
    page = "<div><a>Home</a><a>About</a></div><div><p>story with a <a>link</a> in it</p></div><div><a>Imprint</a></div>"
    assert H.Scorer().extract(page) == "story with a link in it"
    assert H.Scorer().extract("<div>only a box</div>") == "only a box"


def test_closing_is_linear():
    import time

    for page in ("<div>" * 100_000 + "</x>" * 100_000, "<p><b>" * 50_000 + "x", "<div>" * 100_000 + "</div>" * 100_000, "<li>" * 100_000):
        began = time.process_time()
        H.Scorer().extract(page)
        assert time.process_time() - began < 4


def brute_region(weights):
    sums = [(sum(weights[i:j]), -i, j) for i in range(len(weights)) for j in range(i + 1, len(weights) + 1)]
    return max(s for s, _, _ in sums) if sums else 0.0


def test_region_has_the_greatest_sum():
    rng = random.Random(6)
    scorer = H.Scorer()
    for _ in range(100):
        page = "".join(rng.choice(["<p>a b</p>", "<a>c d e</a>", "<b>x</b>", "<div>", "</div>", "<nav>m</nav>", "z "]) for _ in range(rng.randint(1, 12)))
        seen = list(H.events(page))
        weight = {H.TEXT: lambda e: scorer.word(e) * len(e.run.split()), H.TAG: lambda e: scorer.tag(e) if e.key else 0.0, H.OUT: lambda e: H.LEFT_OUT, H.INSIDE: lambda e: 0.0}
        weights = [weight[e.kind](e) for e in seen]
        start, end = scorer.region(seen)
        assert np.isclose(sum(weights[start:end]), max(0.0, brute_region(weights)))


def test_excluded_blocks_do_not_cut_the_main_text(spark):
    words = "many words of the main story that goes on for a while and says something of interest"
    ad = "<div class='ad'>" + "<a href=x>buy <b>now</b></a> " * 60 + "</div>"
    menu = "<nav>" + "<a>menu</a> " * 40 + "</nav>"
    train = f"<html><body><p>stray</p>{menu}<div class='ad'>{'buy now ' * 200}</div><article><h1>A title</h1><div class='story'><p>{words}</p></div></article><footer>end</footer>"
    scorer = H.learn(spark.createDataFrame([(train,)] * 5, "html string"))
    inner = f"<h1>Title</h1>{ad}<p>{words}</p><p>{words}</p>{ad}<p>last one</p>"
    want = ["Title", words, words, "last one"]
    for page in (f"<article>{inner}</article>", f"<div role='main'>{inner}</div>", f"<div class='story'>{inner}</div>"):
        assert scorer.extract(f"<html><body><p>stray</p>{menu}{page}{menu}<p>stray</p></body></html>").split("\n") == want


def test_foreign_elements_and_stray_quotes():
    read = H.Scorer().extract
    assert read('<article><p>one two three</p><svg class="i"/><p>four five six seven</p></article>') == "one two three\nfour five six seven"
    assert read('<article><p>one two</p><svg><title>icon</title><path d="M0"/><g><text>no</text></g></svg><p>three four</p></article>') == "one two\nthree four"
    assert read("<article><p>one two <svg><circle/>lost</p><p>three four</p></article>") == "one two\nthree four"  # never closed: ends with the block
    assert read("<article><noscript><p>turn it on</p></noscript><template><p>not shown</p></template><p>one two</p></article>") == "one two"
    assert read('<p title="x>one two</p>') == "one two"
    assert read("<p class=it's>one two</p>") == "one two"
    assert read("<p title='x>one two</p><p>it is so</p>") == "one two\nit is so"
    assert read('<article><p data-x="a > b" title = \'"\'>one two</p><p a="" b=c"d>three</p></article>') == "one two\nthree"
    for page in ('<p a="' * 20000, "<svg" * 20000, "<svg>" * 20000, "<p =" * 20000, "<p ='\"" * 20000, "<p a=" * 20000):
        began = time.time()
        read(page)
        assert time.time() - began < 2


def test_listed_domains_from_a_table(spark, tmp_path):
    """Half of the corpus's own hosts as the list: membership is exact for hosts and subdomains, whatever is listed."""
    pages = queries.op7_url_filter(spark, DATA).select("host").where("host <> ''").distinct()
    pages.where("crc32(host) % 2 = 0").select(F.col("host").alias("key")).write.parquet(str(tmp_path / "listed"))
    listed = {r["key"] for r in spark.read.parquet(str(tmp_path / "listed")).collect()}
    rows = queries.op7_url_filter(spark, DATA, str(tmp_path / "listed")).collect()
    assert listed and {"allow", "block"} == {r.verdict for r in rows if r.rule is None}
    for r in rows:
        if r.rule is None:
            parts = r.host.split(".")
            assert (r.verdict == "block") == any(".".join(parts[i:]) in listed for i in range(len(parts)))
