"""The main text of web pages: a maximum-scoring subsequence of words and tags.

A page becomes a sequence of words and tags.  Words score positive and tags negative; the
article is the contiguous run with the largest sum, found by one linear scan.  A word is known
by the block that holds it and by whether it is a link, a tag by its name and by whether words
follow; each of these kinds has its own weight.

Weights come from labelled pages: those whose markup itself names their article.  Over about
``examples`` of the pages, chosen by a hash of the page, tasks count how many words and tags
of each kind stand inside and outside the article.  A word weighs the share of its kind
inside, a tag the share of its kind outside times a price.  The price is the one of
``PRICES`` with the fewest wrong words on these pages when no part's name is looked at.
Where a page does name its article, words and tags in it have kinds of their own.

Parts that name themselves as something else (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, by element, role, class or id) count as one tag and give no
text.  Scripts, styles, comments in the markup and hidden elements are left out.

The text of the region is what its words say: character references are decoded, any white
space (a no-break space and ``<br>`` too) inside a block becomes one blank, blocks without
words are left out, the others are joined by line feeds.

Each page is worked on by itself: there is no shuffle of pages.  Defined cases: a null or
empty page, or one without words outside such parts, has the empty text; of regions with equal
sums the first and shortest counts; an element that is not closed ends with the element around
it; without labelled pages all kinds of words weigh the same, and all kinds of tags; repeated
rows are separate rows; no pages give no rows; only ``html`` and what is carried along are
read, other columns play no part.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.words import pieces

#: Pages that weights are counted over, about; pages of equal text come together.
EXAMPLES = 50_000
#: What a tag that is always outside costs, in words that are always inside; of equal ones the first.
PRICES = (3, 2, 5, 1, 8, 13)
#: The least that a word weighs, and that a tag costs before its price.
LEAST_WORD, LEAST_TAG = 0.25, 0.05
_UNIT = 1_000_000

# Elements of HTML by how they are read.
RAW = "script style title textarea xmp iframe noembed noframes noscript template svg math object canvas audio video"
VOID = "area base br col embed hr img input link meta param source track wbr"
BLOCK = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul caption colgroup"
)
INLINE = (
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr"
)
# What parts that are not the article call themselves.
OTHER_PARTS = "nav aside footer form button select dialog menu fieldset search"
OTHER_ROLES = "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar"
OTHER_NAMES = (
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar "
    "header masthead banner footer colophon copyright "
    "sidebar aside widget related recommended recommendations trending "
    "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe alert disclaimer "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsbygoogle "
    "form search login signup share sharing social "
    "comment comments disqus discussion replies respond"
)
COMMENT_NAMES = "comment comments disqus discussion replies respond"
#: A name with one of these words tells of a layout, not of the element.
LAYOUT = "has with no without show hide"
#: With one of these words, a header belongs to the article.
HEADED = "article entry post story title content"

_RAW, _VOID, _BLOCK = frozenset(RAW.split()), frozenset(VOID.split()), frozenset(BLOCK.split())
_KNOWN = _BLOCK | frozenset(INLINE.split())
_WITHIN = frozenset(INLINE.split()) - {"a"}
_PARTS, _ROLES, _NAMES = frozenset(OTHER_PARTS.split()), frozenset(OTHER_ROLES.split()), frozenset(OTHER_NAMES.split())
_COMMENTS, _LAYOUT, _HEADED = frozenset(COMMENT_NAMES.split()), frozenset(LAYOUT.split()), frozenset(HEADED.split())
_NEVER = frozenset(("html", "body", "main"))
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
_LISTS = frozenset(("ul", "ol", "dl", "menu", "table"))

_ATTRIBUTES = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>"""
MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>{'|'.join(RAW.split())})(?=[\s/>])(?:[^>]*?/>|[^>]*+>.*?(?:</(?P=raw)[^>]*+>|\Z))"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+){_ATTRIBUTES}"
    r"|<[/!?a-z][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?:^|[\s"'/])hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""",
    re.IGNORECASE,
)
_NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@lru_cache(maxsize=10_000)
def other_part(name: str, attributes: str) -> str:
    """How an element says that it is not the article: by its ``element``, its ``name`` (class,
    id or role), as reader ``comments`` or as ``hidden``; else empty."""
    if name in _NEVER:
        return ""
    if "=" in attributes or "hidden" in attributes:
        if _HIDDEN.search(attributes):
            return "hidden"
        for key, value in _NAMED.findall(attributes):
            for called in value.strip("\"'").split():
                if key.lower() == "role":
                    if called.lower() in _ROLES:
                        return "name"
                    continue
                words = {w.lower() for w in _NAME_WORDS.findall(called)}
                if words & _LAYOUT:
                    continue
                found = words & _NAMES
                if "header" in found and (words & _HEADED or name in ("h1", "h2", "h3", "h4", "h5", "h6")):
                    found -= {"header"}
                if found & _COMMENTS:
                    return "comments"
                if found and name != "article":
                    return "name"
    return "element" if name in _PARTS or name == "header" else ""


@dataclass
class Page:
    """A page as a sequence: the kind of each item, its number of words (tags have none), its
    text (None where a block begins or ends) and the element that holds it."""

    kinds: list[str] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    articles: list[int] = field(default_factory=list)
    mains: list[int] = field(default_factory=list)
    parts: list[int] = field(default_factory=list)
    opened: Counter = field(default_factory=Counter)

    def inside(self) -> np.ndarray:
        """Flags of the items in the element that the page names as its article."""
        held = self.articles if self.opened["article"] else self.mains
        return np.array(held, bool) & ~np.array(self.parts, bool)

    def labelled(self) -> bool:
        if self.opened["article"]:
            return self.opened["article"] == 1
        return self.opened["main"] == 1


class _Reader:
    """Reads the markup of one page; open blocks are kept on a stack.

    Other parts become one item, or, if they aren't to be ``folded``, items that are not inside.
    """

    def __init__(self, folded: bool):
        self.page = Page()
        self.folded = folded
        self.stack: list[str] = []
        self.marked: list[bool] = []
        self.parts = 0
        self.open: Counter = Counter()
        self.link = False
        self.skip: list[str] = []
        self.skipped: Counter = Counter()
        self.why = ""

    def add(self, kind: str, words: int, text: str | None) -> None:
        page = self.page
        page.kinds.append(kind), page.words.append(words), page.texts.append(text)
        page.articles.append(self.open["article"]), page.mains.append(self.open["main"])
        page.parts.append(self.parts)

    def text(self, raw: str) -> None:
        if self.skip:
            return
        said = html.unescape(raw) if "&" in raw else raw
        words = len(said.split())
        if words:
            kinds = self.page.kinds
            if kinds and kinds[-1][:1] == "<":
                kinds[-1] += " word"
            block = self.stack[-1] if self.stack else "body"
            self.add(block + " link" if self.link else block, words, said)
        elif said:
            self.add("", 0, said)

    def push(self, name: str, part: bool) -> None:
        self.stack.append(name), self.marked.append(part)
        self.open[name] += 1
        self.parts += part

    def pop_to(self, name: str) -> None:
        while True:
            top = self.stack.pop()
            self.open[top] -= 1
            self.parts -= self.marked.pop()
            if top == name:
                return

    def begin(self, name: str, attributes: str) -> None:
        if self.skip:
            returns = name == "main" or name == "article" and self.why != "comments" and "aside" not in self.skipped
            if not (returns and not other_part(name, attributes)):
                if name not in _VOID and attributes[-1:] != "/":
                    self.skip.append(name)
                    self.skipped[name] += 1
                return
            self.skip.clear(), self.skipped.clear()
        block = name in _BLOCK
        if block and self.stack:
            # What HTML closes by itself.
            if self.stack[-1] == "p":
                self.pop_to("p")
            for other in _SIBLINGS.get(name, ()):
                depth = len(self.stack) - 1
                while depth >= 0 and self.stack[depth] not in _LISTS and self.stack[depth] != other:
                    depth -= 1
                    if len(self.stack) - depth > 8:
                        break
                if depth >= 0 and self.stack[depth] == other:
                    while len(self.stack) > depth:
                        self.pop_to(self.stack[-1])
        why = other_part(name, attributes)
        if why == "element" and name == "header" and self.open["article"]:
            why = ""
        if why and name not in _VOID and self.folded:
            self.add("<part", 0, None if block else "")
            self.skip, self.why = [name], why
            self.skipped = Counter(self.skip)
            return
        self.add("<" + name if name in _KNOWN else "<other", 0, None if block else " " if name == "br" else "")
        if block and name not in _VOID:
            self.push(name, bool(why))
        if name in ("article", "main") and not self.parts:
            self.page.opened[name] += 1
        if name == "a":
            self.link = True

    def end(self, name: str) -> None:
        if self.skip:
            if self.skipped[name]:
                while True:
                    top = self.skip.pop()
                    self.skipped[top] -= 1
                    if top == name:
                        return
            if not self.open[name]:
                return
            self.skip.clear(), self.skipped.clear()
        block = name in _BLOCK
        if block:
            if not self.open[name]:
                return
            self.pop_to(name)
            self.link = False
        elif name == "a":
            self.link = False
        self.add("</" + name if name in _KNOWN else "</other", 0, None if block else "")


def read_page(text: str | None, folded: bool = True) -> Page:
    """The words and tags of a page."""
    reader, at = _Reader(folded), 0
    text = text or ""
    for found in MARKUP.finditer(text):
        if found.start() > at:
            reader.text(text[at : found.start()])
        at = found.end()
        name = found["name"]
        if name:
            if found["close"]:
                reader.end(name.lower())
            else:
                reader.begin(name.lower(), found[4])
    if at < len(text):
        reader.text(text[at:])
    return reader.page


@dataclass(frozen=True)
class Weights:
    """Shares of each kind inside articles, in millionths, and the price of a tag.

    ``inside`` holds the shares of items in an element that names itself the article."""

    plain: dict[str, int]
    inside: dict[str, int]
    price: int = PRICES[0]

    def of(self, kind: str, inside: bool) -> int:
        share = (self.inside if inside else self.plain).get(kind)
        if share is None:
            share = _UNIT * 9 // 10 if kind.strip("</").split(" ")[0] in _WITHIN else _UNIT // 2
        if kind[:1] == "<":
            return -max(int(LEAST_TAG * _UNIT), _UNIT - share)
        return max(int(LEAST_WORD * _UNIT), share)

    def scores(self, page: Page, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of words, and of tags at a price of one, of the items of a page."""
        known: dict[tuple[str, bool], int] = {}
        flat = np.empty(len(page.kinds), np.int64)
        for i, key in enumerate(zip(page.kinds, inside.tolist(), strict=True)):
            if key not in known:
                known[key] = self.of(*key)
            flat[i] = known[key]
        words = np.array(page.words, np.int64)
        return np.where(flat > 0, flat * words, 0), np.where(flat < 0, flat, 0)


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """Begin and end of the contiguous items with the largest sum; empty if no sum is positive."""
    if not len(scores):
        return 0, 0
    total = np.concatenate([[0], np.cumsum(scores)])
    low = np.minimum.accumulate(total[:-1])
    gain = total[1:] - low
    end = int(gain.argmax())
    if gain[end] <= 0:
        return 0, 0
    return int(np.flatnonzero(total[: end + 1] == low[end])[-1]), end + 1


def region_text(page: Page, begin: int, end: int) -> str:
    blocks, held = [], []
    for text in [*page.texts[begin:end], None]:
        if text is not None:
            held.append(text)
        elif held:
            blocks.append(" ".join("".join(held).split()))
            held = []
    return "\n".join(b for b in blocks if b)


def extract(text: str | None, weights: Weights) -> str:
    """The main text of one page."""
    page = read_page(text)
    words, tags = weights.scores(page, page.inside())
    return region_text(page, *best_region(words + weights.price * tags))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
    """Labelled pages, read as if other parts had no names."""
    for batch in pieces(batches, "html"):
        for text in batch.column("html"):
            page = read_page(text.as_py(), folded=False)
            if page.labelled():
                yield page


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[tuple[str, bool]] = Counter()
    for page in _pages(batches):
        for kind, words, flag in zip(page.kinds, page.words, page.inside().tolist(), strict=True):
            if kind:
                held[kind, flag] += words or 1
    yield pa.RecordBatch.from_pydict(
        {
            "kind": pa.array([k for k, _ in held], pa.string()),
            "inside": pa.array([f for _, f in held], pa.bool_()),
            "n": pa.array(held.values(), pa.int64()),
        }
    )


def _try_prices(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    """Wrong words at each price, looking at no names."""
    wrong = np.zeros(len(PRICES), np.int64)
    for page in _pages(batches):
        inside = page.inside()
        words, tags = weights.scores(page, np.zeros(len(page.kinds), bool))
        count = np.array(page.words, np.int64)
        for i, price in enumerate(PRICES):
            begin, end = best_region(words + price * tags)
            taken = np.zeros(len(count), bool)
            taken[begin:end] = True
            wrong[i] += count[taken != inside].sum()
    yield pa.RecordBatch.from_pydict({"price": pa.array(range(len(PRICES)), pa.int32()), "n": pa.array(wrong)})


def train(pages: DataFrame, examples: int = EXAMPLES) -> Weights:
    """Weights from the labelled pages among about ``examples`` pages.

    The driver receives one row per kind: at most some hundred.
    """
    total = max(1, pages.count())
    chosen = pages.select(F.col("html").cast("string").alias("html"))
    if total > examples:
        share = F.pmod(F.xxhash64("html"), F.lit(total)) < examples
        chosen = chosen.where(share)
    rows = chosen.mapInArrow(_count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n"))
    counts: dict[str, list[int]] = {}
    for kind, inside, n in rows.collect():
        counts.setdefault(kind, [0, 0])[int(inside)] = n
    plain = {k: _UNIT * (n[1] + 1) // (n[0] + n[1] + 2) for k, n in counts.items()}
    inside = {k: _UNIT * (n[1] + 1) // (n[1] + 2) for k, n in counts.items()}
    weights = Weights(plain, inside)
    tried = chosen.mapInArrow(lambda it: _try_prices(it, weights), "price int, n long").groupBy("price").agg(F.sum("n"))
    wrong = {price: n for price, n in tried.collect()}
    best = min(range(len(PRICES)), key=lambda i: (wrong.get(i, 0), i))
    return Weights(plain, inside, PRICES[best])


def _extract(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = [extract(t.as_py(), weights) for t in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("carried"), pa.array(texts, pa.string())], names=["carried", "text"]
        )


def main_text(pages: DataFrame, weights: Weights, carried: Column) -> DataFrame:
    """Per row ``carried`` and ``text``."""
    narrow = pages.select(carried.alias("carried"), F.col("html").cast("string").alias("html"))
    kind = narrow.schema["carried"].dataType.simpleString()
    return narrow.mapInArrow(lambda it: _extract(it, weights), f"carried {kind}, text string")
