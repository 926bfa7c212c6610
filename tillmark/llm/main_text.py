"""Main text of web pages by text-to-tag ratios.

A page goes through the standard library's streaming parser once. Its events are cut into
lines at block borders; a line keeps its text, the tags met in it and the elements around it.
The text-to-tag ratios of the lines are smoothed with a Gaussian and split by a threshold, one
standard deviation, into content and the rest (Weninger, Hsu and Han, "CETR: Content Extraction
via Tag Ratios", 2010). The element that holds the content lines is the content region: an
article, a main part, or else the innermost container with most of their text. All its lines
are kept, short ones too, for a ratio alone would lose one-word paragraphs. Elements that by
tag, role or class name are menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or comments never count.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.llm.common import text_pass

# Lines to both sides that the Gaussian reaches, and its width.
REACH, WIDTH = 2, 1.0
# A line above this many standard deviations of the smoothed ratios is content.
DEVIATIONS = 1.0
# A container is narrowed to a part of it that holds this share of its content text.
INNER_SHARE = 0.7
# Outside articles, a line with more than this share of its text in links is no content.
LINK_SHARE = 0.5

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
BOILERPLATE = frozenset("nav footer aside form button select textarea dialog menu fieldset".split())
CONTAINERS = frozenset(
    "html body div section article main header table tbody thead tfoot tr td th ul ol dl blockquote figure center "
    "details".split()
)
BLOCKS = (CONTAINERS - {"td", "th"}) | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption summary".split())
# Closing tags of these reach through other containers.
FAR_CLOSED = CONTAINERS | BOILERPLATE
# An opening tag that closes an open element of the same group.
CLOSED_BY_SELF = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
# Words in class names, ids and roles that mark parts which are no article.
MARKED_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar sidebars aside ad ads advert adverts "
    "advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended comment comments commentlist disqus replies discussion pagination pager toolbar widget "
    "search skip complementary contentinfo dialog".split()
)
# These mark a page's head, but inside an article its own headline.
HEAD_WORDS = frozenset("header masthead topbar".split())
MAIN_WORDS = frozenset("articlebody maincontent".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Line:
    """Text between two block borders."""

    __slots__ = ("pieces", "tags", "linked", "around", "text")

    def __init__(self, around: int):
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.around, self.text = around, ""  # the innermost container's number, -1 for none


class Events(HTMLParser):
    """Cuts a page into lines; text of marked elements is left out at once."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # By container number, in the order of opening: kind, number around it, last number inside.
        self.kinds: list[str] = []
        self.parents: list[int] = []
        self.lasts: list[int] = []
        self.open: list[tuple[str, int, bool]] = []  # tag, container number (-1: none), marked
        self.inside = [-1]  # numbers of the open containers
        self.names: list[Counter] = [Counter()]  # open tags inside each of them
        self.blocks: Counter = Counter()  # open containers and marked blocks by tag
        self.hidden = self.links = self.articles = 0
        self.line = Line(-1)

    def _border(self) -> None:
        line = self.line
        line.text = " ".join("".join(line.pieces).split())
        if line.text:
            self.lines.append(line)
        self.line = Line(self.inside[-1])

    def _push(self, tag: str, kind: str | None, marked: bool) -> None:
        number = -1
        if tag in FAR_CLOSED:
            self.blocks[tag] += 1
        else:
            self.names[-1][tag] += 1
        if kind:
            number = len(self.kinds)
            self.kinds.append(kind)
            self.parents.append(self.inside[-1])
            self.lasts.append(number)
            self.inside.append(number)
            self.names.append(Counter())
            self.line.around = number
        self.open.append((tag, number, marked))
        self.hidden += marked
        self.articles += number >= 0 and self.kinds[number] == "article"
        self.links += tag == "a"

    def _pop(self) -> None:
        tag, number, marked = self.open.pop()
        if number >= 0:
            self.lasts[number] = len(self.kinds) - 1
            self.inside.pop()
            self.names.pop()
        if tag in FAR_CLOSED:
            self.blocks[tag] -= 1
        else:
            self.names[-1][tag] -= 1
        self.hidden -= marked
        self.articles -= number >= 0 and self.kinds[number] == "article"
        self.links -= tag == "a"

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.line.tags += 1
        if tag in BLOCKS:
            self._close_paragraphs(tag)
            self._border()
            self.line.tags += 1
        elif tag in ("br", "td", "th"):
            self.line.pieces.append(" ")
        if tag in VOID:
            return
        if tag == "a" and self.links:
            self._close("a")
        named = dict(attrs)
        marked = tag in RAW or tag in BOILERPLATE or self._marked(tag, named)
        if marked and tag not in BLOCKS and tag not in RAW:
            self._border()
        kind = None
        if tag in CONTAINERS:
            kind = "part" if marked else self._kind(tag, named)
        self._push(tag, kind, marked)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # browsers ignore the slash

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if tag in VOID:
            return
        self._close(tag)
        if tag in BLOCKS or tag in BOILERPLATE:
            self._border()

    def _close(self, tag: str) -> None:
        """Close the innermost element of this name and what stands open inside it. Inline
        names do not reach out of a container, a name that is not open closes nothing."""
        if (self.blocks if tag in FAR_CLOSED else self.names[-1])[tag] > 0:
            found = False
            while not found:
                found = self.open[-1][0] == tag
                self._pop()

    def _close_paragraphs(self, tag: str) -> None:
        for name in CLOSED_BY_SELF.get(tag, ("p",)):
            self._close(name)

    def _marked(self, tag: str, named: dict[str, str | None]) -> bool:
        if tag in ("html", "body"):
            return False
        if "hidden" in named or (named.get("aria-hidden") or "").lower() == "true":
            return True
        if re.search(r"display\s*:\s*none", named.get("style") or "", re.I):
            return True
        words = _words(named)
        return bool(words & MARKED_WORDS) or (not self.articles and (tag == "header" or bool(words & HEAD_WORDS)))

    def _kind(self, tag: str, named: dict[str, str | None]) -> str:
        if tag == "article" or (named.get("itemprop") or "").lower() in MAIN_WORDS:
            return "article"
        return "main" if tag == "main" or (named.get("role") or "").lower() == "main" else "part"

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.line.pieces.append(data)
            if self.links:
                self.line.linked += len(data)

    def finished(self) -> list[Line]:
        self.close()
        self._border()
        while self.open:
            self._pop()
        return self.lines


def _words(named: dict[str, str | None]) -> set[str]:
    return {
        word.lower() for name in ("class", "id", "role") for word in NAME_PARTS.findall(named.get(name) or "")
    }


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian means; lines beyond either end do not count."""
    steps = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(steps**2) / (2 * WIDTH**2))
    return _same(ratios, kernel) / _same(np.ones(len(ratios)), kernel)


def _same(values: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    return np.convolve(values, kernel, mode="full")[REACH : REACH + len(values)]


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines lie in a region of high text-to-tag ratio."""
    values = smoothed(np.array([len(line.text) / max(line.tags, 1) for line in lines], float))
    spread = values.std()
    found = values >= min(DEVIATIONS * spread, values.max())
    return found & np.array([line.linked <= LINK_SHARE * len(line.text) for line in lines])


def region(events: Events, lines: list[Line], content: np.ndarray) -> int | None:
    """The element whose lines are the main text; None for the whole page."""
    mass = [0] * len(events.kinds)
    for line, counts in zip(lines, content, strict=True):
        if counts and line.around >= 0:
            mass[line.around] += len(line.text)
    for number in range(len(mass) - 1, -1, -1):  # a container opens after those around it
        if events.parents[number] >= 0:
            mass[events.parents[number]] += mass[number]
    for kind in ("article", "main"):
        named = [number for number, held in enumerate(mass) if held and events.kinds[number] == kind]
        if named:  # the one with most content; of nested ones with the same, the outer
            return max(named, key=lambda number: (mass[number], -number))
    chosen, held = None, sum(len(line.text) for line, counts in zip(lines, content, strict=True) if counts)
    for number, inner in enumerate(mass):
        if inner and inner >= INNER_SHARE * held:
            chosen, held = number, inner
    return chosen


def main_text(html: str | None) -> str:
    """The main text of one page: its blocks in page order, joined by line breaks."""
    if not html:
        return ""
    events = Events()
    events.feed(html)
    lines = events.finished()
    if not lines:
        return ""
    content = content_lines(lines)
    chosen = region(events, lines, content)
    named = chosen is not None and events.kinds[chosen] != "part"
    first, last = (-1, len(events.kinds)) if chosen is None else (chosen, events.lasts[chosen])
    kept = [
        line.text
        for line in lines
        if first <= line.around <= last and (named or line.linked <= LINK_SHARE * len(line.text))
    ]
    return "\n".join(kept)


def extracted(df: DataFrame, column: str = "html") -> DataFrame:
    """Add ``main_text`` (string, empty if a page has none) to every row.

    Whole pages are read, nothing is cut. Null and empty pages give an empty text, broken or
    unfinished markup is read as far as it goes. Rows keep their number; repeated rows give
    repeated results, an empty table an empty one. A column named ``main_text`` is replaced, all
    others are passed on. One narrow pass without a shuffle.
    """
    return text_pass(
        df, column, T.StructType([T.StructField("main_text", T.StringType())]), lambda: lambda pages: [list(map(main_text, pages))]
    )


def page_texts(pages: DataFrame) -> DataFrame:
    """Main text and its length in code points, one row per page."""
    return extracted(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
