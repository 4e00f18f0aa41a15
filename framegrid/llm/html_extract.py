"""HTML extraction by the maximum-scoring contiguous subsequence of words (positive) and tags (negative).

Weights are log odds learned from labelled pages, those that mark their text with ``<article>``, ``<main>`` or
``role="main"``: of words by the block and class they stand in and whether they are linked, of tags by name. Learned
weights carry their own sign: words of a kind that labelled pages hold outside of their text count against a region.
Keys are hashed into ``WEIGHTS`` buckets, so a model has one size whatever the names of classes. A linear scan finds the
best region; a page where learned weights leave no region is read once more by the priors. On a page that labels its
text, words outside of the labels are negative and words inside positive.

Menus, forms, notices, comments and the like are left out of a region: by element, by a class, id or role that is such a
mark as a whole, or (boxes only, not headings, paragraphs or cells) one made of marks and words for boxes alone, such as
``comment-list``. Such a block counts ``LEFT_OUT`` once, or nothing inside of a labelled region or of a box that training
pages hold mostly inside of theirs, so it does not cut the text around it; tags in there hardly count either.

Cases: null and empty html give an empty text; broken markup (open quotes, unclosed or cut tags) is read as far as it
goes, in time linear in its length; a page without words in a region gives an empty text; without labelled pages the
priors hold; null urls and ids pass through; repeated rows are read alike; an empty table gives an empty result; a column
with the result's name is replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: HTML elements that are never closed, that end a block of text, that hold text itself, and that hold no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
TEXTUAL = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 p pre summary td th".split())
OUTSIDE = frozenset("aside button dialog footer form head iframe menu nav noscript object option script select style svg template textarea title".split())
#: Names that mark a part as no main text wherever they stand.
TEXT_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies navigation "
    "newsletter notice notices pagination promo sponsor sponsored subscribe".split()
)
#: Further names that mark a box, and words that say nothing but that something is a box.
MARKS = TEXT_MARKS | frozenset(
    "banner contentinfo disqus footer header legal masthead menu modal nav navbar popup promoted related reply replies respond "
    "search share sharing sidebar social teaser toolbar widget".split()
)
BOXES = frozenset("area bar bottom box container form inner item items left links list outer panel right section signup site slot top unit wrap wrapper".split())
#: Elements that an opening one of the same kind closes.
CLOSED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: Buckets of the learned weights' keys.
WEIGHTS = 1 << 16
#: Words (or tags) of a kind, and boxes, that must have been met before what is learned of them holds.
LEAST_WORDS, LEAST_BOXES = 20, 3
MOST_OWN, MOST_SHARED = 4.0, 1.0
LEFT_OUT = -4.0
#: Priors of a word: in an element for text, elsewhere, linked; and of a tag.
PRIOR_TEXT, PRIOR_OTHER, PRIOR_LINKED, PRIOR_TAG = 1.0, 0.5, -1.0, -0.4
#: A tag within a region that holds main text: hardly more than none, so that a text of short blocks stays whole.
HELD_TAG = -0.01
#: Comments, declarations, elements that hold plain characters up to their end tag, tags. A quote opens a value only right after an equals
#: sign, and only if it is closed again; any other is a character like others, so the tag ends at the next angle bracket.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(script|style|textarea|iframe)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^=>]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
LABELS = frozenset(("article", "main"))


@dataclass(slots=True)
class Element:
    name: str
    key: str  # element and class of the innermost block
    linked: bool
    labelled: bool
    out: bool
    held: bool


@dataclass(slots=True)
class Event:
    """A tag, a run of text, or (once) a block that is left out."""

    kind: str
    key: str
    run: str = ""  # of a tag that opens a block, its name and class
    linked: bool = False
    labelled: bool = False
    held: bool = False
    ends: bool = False


TEXT, TAG, OUT, INSIDE = "text", "tag", "out", "inside"  # INSIDE: text within what is left out


def marked(name: str, attributes: dict[str, str]) -> bool:
    """Whether a class, id or role marks the element as no main text."""
    for value in attributes.values():
        for whole in value.split():
            if name in TEXTUAL or name in BLOCKS and name == "li":
                if whole in TEXT_MARKS:
                    return True
            elif whole in MARKS:
                return True
            else:
                parts = [p for p in re.split(r"[-_]+", whole) if p]
                if not MARKS.isdisjoint(parts) and all(p in MARKS or p in BOXES for p in parts):
                    return True
    return False


def events(page: str, inside: Callable[[str], bool] = lambda key: False) -> Iterator[Event]:
    """What a page is made of, in order; ``inside`` tells the boxes that hold main text."""
    root = Element("", "body.", False, False, False, False)
    stack = [root]
    boxes: list[int] = []  # places of open blocks
    open_names: Counter = Counter()
    at = 0

    def close(place: int) -> None:
        for e in stack[place:]:
            open_names[e.name] -= 1
        del stack[place:]
        while boxes and boxes[-1] >= place:
            boxes.pop()

    def text(run: str) -> Event:
        e = stack[-1]
        return Event(INSIDE if e.out else TEXT, e.key, run, e.linked, e.labelled, e.held)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield text(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:  # a comment, a declaration, a script with all that it holds
            continue
        if m[2]:
            was = stack[-1]
            if open_names[name] > 0:
                place = len(stack) - 1
                while stack[place].name != name:
                    place -= 1
                close(place)
            if not was.out:
                yield Event(TAG, name, "", False, was.labelled and stack[-1].labelled, was.held and stack[-1].held, name in BLOCKS)
            elif name in BLOCKS:
                yield Event(TAG, "", ends=True)
            continue
        if name == "br":
            yield text(" ")
            continue
        if name in BLOCKS:
            gone = CLOSED_BY.get(name, "").split()
            while boxes and (stack[boxes[-1]].name == "p" or stack[boxes[-1]].name in gone):
                close(boxes[-1])
        above = stack[-1]
        found = {a.lower(): (x or y or z).lower() for a, x, y, z in ATTRIBUTE.findall(m[4])} if m[4] else {}
        own = f"{name}.{found.get('class', '')}"
        out = above.out or name in OUTSIDE or name == "header" and not above.labelled or bool(found) and name not in ("html", "body") and marked(name, found)
        if out and not above.out:
            yield Event(OUT, own, held=above.held, ends=name in BLOCKS)
        elif not out:
            yield Event(TAG, name, own if name in BLOCKS else "", False, above.labelled, above.held, name in BLOCKS)
        elif name in BLOCKS:
            yield Event(TAG, "", ends=True)
        if name in VOID or m[4].endswith("/") and name not in BLOCKS:
            continue
        labels = not out and (name in LABELS or found.get("role") == "main")
        held = above.held or labels or not out and name in BLOCKS and (bool(found.get("class")) or name == "section") and inside(own)
        stack.append(Element(name, own if name in BLOCKS else above.key, above.linked or name == "a", above.labelled or labels, out, held))
        open_names[name] += 1
        if name in BLOCKS:
            boxes.append(len(stack) - 1)
    if at < len(page):
        yield text(page[at:])


def bucket(key: str) -> int:
    return zlib.crc32(key.encode("utf-8", "surrogatepass")) % WEIGHTS


def names(key: str, linked: bool) -> tuple[str, str]:
    """A run's own kind, and the kind it shares with all classes of its element."""
    return f"{key} a" if linked else key, f"{key.partition('.')[0]}{' a' if linked else ''}"


def count(page: str, into: Counter) -> None:
    """Add a labelled page's words and tags inside and outside of its labelled region; what is left out inside of it is neither."""
    seen = list(events(page))
    if not any(e.labelled for e in seen):
        return
    for e in seen:
        if e.kind in (TEXT, INSIDE) and not (e.kind == INSIDE and e.labelled):
            n = len(e.run.split())
            for name in names(e.key, e.linked):
                into[bucket(name), e.labelled] += n
        elif e.kind == TAG and e.key:
            into[bucket(f"tag {e.key}"), e.labelled] += 1
            if e.run:
                into[bucket(f"box {e.run}"), e.labelled] += 1


@dataclass
class Scorer:
    """Learned log odds and the number of words or tags behind each, by bucket; empty, the priors hold."""

    learned: dict[int, tuple[float, int]] = field(default_factory=dict)

    def word(self, e: Event) -> float:
        own, shared = names(e.key, e.linked)
        w, n = self.learned.get(bucket(own), (0.0, 0))
        if n >= LEAST_WORDS:
            return max(-MOST_OWN, min(MOST_OWN, w))
        w, n = self.learned.get(bucket(shared), (0.0, 0))
        if n >= LEAST_WORDS:
            return max(-MOST_SHARED, min(MOST_SHARED, w))
        return PRIOR_LINKED if e.linked else PRIOR_TEXT if e.key.partition(".")[0] in TEXTUAL else PRIOR_OTHER

    def tag(self, e: Event) -> float:
        w, n = self.learned.get(bucket(f"tag {e.key}"), (PRIOR_TAG, 0))
        return max(-2.0, min(-0.1, w)) if n >= LEAST_WORDS else PRIOR_TAG

    def inside(self, key: str) -> bool:
        w, n = self.learned.get(bucket(f"box {key}"), (0.0, 0))
        return n >= LEAST_BOXES and w > 0

    def region(self, seen: list[Event]) -> tuple[int, int]:
        labels = any(e.labelled for e in seen)
        weights: dict[tuple[str, str, bool], float] = {}
        best = total = 0.0
        start, region = 0, (0, 0)
        for i, e in enumerate(seen):
            if total <= 0:
                total, start = 0.0, i
            if e.kind == TEXT:
                if (n := len(e.run.split())) == 0:
                    continue
                kind = (TEXT, e.key, e.linked)
                if (w := weights.get(kind)) is None:
                    w = weights[kind] = self.word(e)
                if labels:
                    w = max(0.5, w) if e.labelled else min(-0.5, w)
                total += w * n
            elif e.kind == OUT:
                total += 0.0 if e.held else LEFT_OUT
            elif e.kind == TAG and e.key:
                kind = (TAG, e.key, False)
                if (w := weights.get(kind)) is None:
                    w = weights[kind] = self.tag(e)
                total += HELD_TAG if e.labelled or e.held else w
            if total > best:
                best, region = total, (start, i + 1)
        return region

    def extract(self, page: str) -> str:
        seen = list(events(page, self.inside))
        region = self.region(seen)
        if region == (0, 0) and self.learned:
            region = Scorer().region(seen)
        blocks: list[str] = []
        part: list[str] = []
        for e in seen[slice(*region)]:
            if e.kind == TEXT:
                part.append(entities.unescape(e.run))
            elif e.ends and part:
                blocks.append(" ".join("".join(part).split()))
                part = []
        blocks.append(" ".join("".join(part).split()))
        return "\n".join(b for b in blocks if b)


def learn(pages: DataFrame, html: str = "html") -> Scorer:
    """Log odds over all labelled pages; counts are summed in each task first, and there are ``WEIGHTS`` of them at most."""

    def tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in it:
            for page in batch.column(0).to_pylist():
                if page:
                    count(page, sums)
        rows = [(k, n, inside) for (k, inside), n in sums.items()]
        yield pa.RecordBatch.from_pydict(
            {"key": [r[0] for r in rows], "inside": [r[1] * r[2] for r in rows], "outside": [r[1] * (not r[2]) for r in rows]},
            pa.schema([("key", pa.int64()), ("inside", pa.int64()), ("outside", pa.int64())]),
        )

    parts = pages.select(html).mapInArrow(tally, "key long, inside long, outside long")
    rows = parts.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    share = math.log((sum(r.outside for r in rows) + 1) / (sum(r.inside for r in rows) + 1))
    return Scorer({r.key: (math.log((r.inside + 0.5) / (r.outside + 0.5)) + share, r.inside + r.outside) for r in rows})


def main_text(html: Column, scorer: Scorer) -> Column:
    learned = scorer.learned

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        own = Scorer(learned)
        return pa.array([own.extract(p or "") for p in pages.to_pylist()], pa.string())

    return extract(html)


def extract(pages: DataFrame, html: str = "html", into: str = "text", scorer: Scorer | None = None) -> DataFrame:
    """``pages`` with the main text of each as column ``into``; without a scorer, one is learned from the pages."""
    return pages.withColumn(into, main_text(F.col(html), scorer or learn(pages, html)))
