"""Main text of web pages by text-to-tag ratios.

The events of the standard library's parser are turned into lines: one for each block. A line's ratio is its characters
by its tags; ratios are smoothed with a Gaussian over neighbouring lines and split into two clusters at the threshold
that parts them best. The lines above it show where the content is: all of them are main text. The innermost element that
holds nearly all their text is the article, and all its lines are main text, short ones too, as are those of further
article elements with lines above the threshold, and short lines between these within the least common container. Elements that are no reading matter
(menus, footers, forms, adverts, notices, comments, ...) never count, wherever they stand; those that only their names, roles
or a form tag tell count all the same where they hold most of the page's text.

Each page is parsed where it is; a page is the unit of work and memory.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, pick

# ---- fixed values ---------------------------------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul""".split()
)
#: Elements without reading matter.
SKIPPED = frozenset(
    """aside audio button canvas datalist dialog embed footer head iframe input map menu nav noscript object option script
    select style svg template textarea title video""".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Class and id names of such elements; a name counts when all its parts stand here or, but for one, in BESIDE.
NAMES = frozenset(
    """ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup
    promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social
    sponsor sponsored subscribe subscription toolbar widget""".split()
)
BESIDE = frozenset(
    """area bar block body bottom box button buttons column container entry form global group header icon icons inner item items left
    link links list main outer page panel post primary right row secondary section site slot text top unit wrap wrapper""".split()
)
_NAMES_AND_BESIDE = NAMES | BESIDE
#: Names of readers' comments, which may be longer than the text they are about.
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
#: Start tags before which an open paragraph ends.
_ENDS_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "legend", "summary"}
#: Elements that end an open one of the same group.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: A tag, comment or declaration that the end of the page cuts off: as in browsers, it and what follows show nothing.
_BEGUN = re.compile("<[a-zA-Z/!?]")
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: Lines within which neighbours weigh, and the share of the content's text the article must hold.
SIGMA, HELD = 1.0, 0.9
#: Share of the page's text above which an element is no menu, form or notice.
MOST = 0.5


class _Lines(HTMLParser):
    """Lines of a page: parts of text, number of tags and the innermost open element.

    Elements are numbered in page order and know the one around them (-1: none), so what an element holds are the numbers
    from its own to its last. Every tag costs the same, however many are open.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements: list[str] = []
        self.around: list[int] = []  # the element around each
        self.skipped: list[bool] = []
        self.doubtful: dict[int, float] = {}  # share of the page's text from which each counts all the same
        self.open: list[int] = []
        self.open_blocks: list[int] = []  # places in ``open``
        self.open_tags: dict[str, list[int]] = {}
        self.closable: list[int] = []  # menus and notices that an article ends
        self.open_articles = 0
        self.lines: list[tuple[list[tuple[str, int]], int, int]] = []
        self.parts: list[tuple[str, int]] = []
        self.tags = 0

    def parse_html_declaration(self, i):
        """Declarations are no reading matter; marked sections of any kind are comments up to the next ``>``."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def innermost(self) -> int:
        return self.open[-1] if self.open else -1

    def line_ends(self) -> None:
        if any(text.strip() for text, _ in self.parts):
            self.lines.append((self.parts, self.tags, self.innermost()))
            self.tags = 0
        self.parts = []

    def pop_to(self, depth: int) -> None:
        if self.open_blocks and self.open_blocks[-1] >= depth:
            self.line_ends()
        while len(self.open) > depth:
            tag = self.elements[self.open.pop()]
            self.open_tags[tag].pop()
            self.open_articles -= tag in ("article", "main")
            for places in (self.open_blocks, self.closable):
                if places and places[-1] == len(self.open):
                    places.pop()

    def push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        n, around = len(self.elements), self.innermost()
        skipped = around >= 0 and self.skipped[around]
        skipped = skipped or tag in SKIPPED or _is_hidden(attrs) or tag == "header" and not self.open_articles
        self.elements.append(tag)
        self.around.append(around)
        self.skipped.append(skipped)
        if not skipped and (share := _doubt(tag, attrs)):
            self.doubtful[n] = share
        if tag in BLOCKS:
            self.open_blocks.append(len(self.open))
        if (skipped or n in self.doubtful) and tag not in ("aside", "dialog", "template", "noscript", "form", "article"):
            self.closable.append(len(self.open))
        self.open_tags.setdefault(tag, []).append(len(self.open))
        self.open_articles += tag in ("article", "main")
        self.open.append(n)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.line_ends()
        self.tags += 1
        if tag in ("article", "main") and self.closable:  # a menu or notice left open ends here
            self.pop_to(self.closable[0])
        ends = _SIBLINGS.get(tag, frozenset()) | ({"p"} if tag in _ENDS_P else set())
        if ends and self.open_blocks and self.elements[self.open[self.open_blocks[-1]]] in ends:
            self.pop_to(self.open_blocks[-1])
        if tag == "br":
            self.parts.append((" ", -1))
        if tag not in VOID:
            self.push(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if places := self.open_tags.get(tag):
            self.pop_to(places[-1])
        elif tag in BLOCKS:
            self.line_ends()

    def handle_data(self, data):
        n = self.innermost()
        if n < 0 or not self.skipped[n]:
            self.parts.append((data, n))

    def within(self, sizes: list[int]) -> list[int]:
        """Sums of ``sizes``, one per element, over each element and all it holds."""
        out = list(sizes)
        for n in range(len(out) - 1, -1, -1):
            if self.around[n] >= 0:
                out[self.around[n]] += out[n]
        return out

    def inside(self, chosen) -> list[bool]:
        """Whether each element is one of ``chosen`` or stands in one."""
        out: list[bool] = []
        for n, around in enumerate(self.around):
            out.append(n in chosen or around >= 0 and out[around])
        return out

    def beside_articles(self) -> set[int]:
        """Doubtful elements while an article with text, itself not doubtful, stands neither in nor around them."""
        texts = [0] * len(self.elements)
        for _, _, n in self.lines:
            if n >= 0:
                texts[n] = 1
        articles = [int(tag in ("article", "main") and n not in self.doubtful and held > 0) for n, (tag, held) in enumerate(zip(self.elements, self.within(texts)))]
        held, above = self.within(articles), []
        for around in self.around:
            above.append(above[around] + articles[around] if around >= 0 else 0)
        every = sum(articles)
        return {n for n in self.doubtful if every > held[n] + above[n]}

    def reading_matter(self) -> list[tuple[str, int, int]]:
        """Lines without the doubtful elements that hold too little; their tags count for the next line, as other skipped tags do."""
        dropped: set[int] = set()
        if self.doubtful:
            sizes, every = [0] * len(self.elements), 0
            for parts, _, _ in self.lines:
                for text, n in parts:
                    size = len("".join(text.split()))
                    every += size
                    if n >= 0:
                        sizes[n] += size
            held = self.within(sizes)
            dropped = self.beside_articles() | {n for n, share in self.doubtful.items() if held[n] <= share * every}
        gone = self.inside(dropped)
        out, tags = [], 0
        for parts, own, n in self.lines:
            tags += own
            text = " ".join("".join(t for t, at in parts if at < 0 or not gone[at]).split())
            if text:
                out.append((text, tags, n))
                tags = 0
        return out


def _is_hidden(attrs: list[tuple[str, str | None]]) -> bool:
    if not attrs:
        return False
    values = {k: v or "" for k, v in attrs}
    return "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")) is not None


def _doubt(tag: str, attrs: list[tuple[str, str | None]]) -> float | None:
    """Share of the page's text from which the element counts all the same; None if nothing tells against it."""
    if tag == "form":
        return MOST
    if not attrs or tag in ("html", "body", "main"):
        return None
    values = {k: v or "" for k, v in attrs}
    named: set[str] = set()
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = {p.lower() for p in _NAME_PARTS.findall(name)}
        if parts <= _NAMES_AND_BESIDE:
            named |= parts & NAMES
    if named & COMMENTS:
        return HELD
    if tag == "article":
        return None
    return MOST if named or values.get("role", "").lower() in ROLES else None


def threshold(values: np.ndarray) -> float:
    """The value that parts ``values`` into the two clusters that differ most; the least one if they are all alike."""
    ordered = np.sort(values)
    n = len(ordered)
    if n < 2 or ordered[0] == ordered[-1]:
        return float(ordered[0]) if n else 0.0
    left = np.arange(1, n)
    sums = np.cumsum(ordered)[:-1]
    between = left * (n - left) * (sums / left - (ordered.sum() - sums) / (n - left)) ** 2
    between[ordered[1:] == ordered[:-1]] = -1
    return float(ordered[int(between.argmax()) + 1])


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = math.ceil(2 * sigma)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, weights)[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]


def main_text(html: str | None) -> str:
    """The article's blocks in page order, joined by empty lines; white space within a block is one space."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    if not _BEGUN.match(page.rawdata):
        page.close()
    page.line_ends()
    lines = page.reading_matter()
    if not lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, _ in lines])
    level = smoothed(np.log1p(ratios))
    content = level >= threshold(level)
    sizes = [0] * len(page.elements)
    for (text, _, n), chosen in zip(lines, content):
        if chosen and n >= 0:
            sizes[n] += len(text)
    weight = page.within(sizes)
    most = sum(len(text) for (text, _, _), chosen in zip(lines, content) if chosen)
    holders = [n for n, w in enumerate(weight) if w and w >= HELD * most and page.elements[n] in BLOCKS]
    article = max(holders, default=None)  # elements are numbered in page order: the last holder is the innermost
    named = [n for n in holders if page.elements[n] in ("article", "main")]
    if named:
        article = max(named)
    elif article is not None and page.elements[article] in ("p", "li", "td", "h1", "h2", "h3", "blockquote"):
        above = [n for n in holders if n < article]
        article = max(above, default=article)
    if article is None:
        return "\n\n".join(text for text, _, _ in lines)
    places = np.flatnonzero(content)
    common = max((n for n, w in enumerate(weight) if w == most and page.elements[n] in BLOCKS), default=None)
    articles: list[int] = []  # the innermost article element of each
    for n, around in enumerate(page.around):
        articles.append(n if page.elements[n] == "article" else articles[around] if around >= 0 else -1)
    whole = page.inside({article} | {articles[n] for i in places if (n := lines[i][2]) >= 0 and articles[n] >= 0})
    shared = page.inside({common})
    kept = (
        chosen or n >= 0 and whole[n] or places[0] < i < places[-1] and (common is None or n >= 0 and shared[n])
        for i, ((_, _, n), chosen) in enumerate(zip(lines, content))
    )
    return "\n\n".join(text for (text, _, _), k in zip(lines, kept) if k)


def main_texts(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of each page, its main text and n_chars (code points).

    Null or empty pages, and pages without reading matter, have an empty text. Markup may be broken anywhere. Repeated
    rows are extracted each for itself; an empty table gives no rows.
    """
    kept = F.struct(*(F.col(f"`{k}`") for k in keep))
    rows = pick(pages, keep=kept, html=F.col(f"`{html}`").cast("string"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["keep", "text", "n_chars"])

    schema = rows.select("keep").schema.add("text", "string").add("n_chars", "long")
    return map_batches(rows, extract, schema).select("keep.*", "text", "n_chars")
