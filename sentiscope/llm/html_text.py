"""Operator 10: main text of web pages.

The standard library's streaming HTML parser turns a page into lines: the text between
two block-level tags, with the number of tags that occur in it and the container it
lies in.  The logarithms of the lines' text-to-tag ratios are smoothed by a Gaussian
kernel and parted into two clusters, one of which is fixed at zero (least spread within
both); lines of the other one are content.  This holds on every page; markup names only
leave lines out and bound regions.

A content line whose own ratio is that high selects a region: the article or main element around it, or else the
nearest container that is not a mere part of a text (list, table, quotation, section).
Containers that hold several selected regions and mostly content are one region too, so
a short paragraph or section between long ones stays.  All lines of a region count.  Blocks
of links stay out of a page's body and of such joined regions.

Left out wherever they stand: menus, page headers and footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments, known by their element, role, or a
word of their class or id; and markup.  Character references are decoded, white space
within a line becomes one space, lines are joined by an empty line.

Pages are independent rows: no shuffle, and a task holds one Arrow batch.

Defined results: a null or empty page has an empty text; a page that breaks off is read
as far as it goes, a head ends at the body or the first element or text that cannot be
in it, and another hidden element that is not closed ends with its parent (a script or
style hides the rest, as in browsers); repeated pages give repeated rows; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import ship

ship(__name__)

SIGMA = 1.0
RADIUS = 2

# Elements by their part in a page.
HIDDEN = frozenset("head title script style noscript template svg math iframe object canvas audio video".split())
FURNITURE = frozenset("nav footer aside form button select textarea fieldset dialog menu".split())
CONTAINERS = frozenset("html body div section article main header center table ul ol dl figure blockquote details".split()) | FURNITURE
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr caption pre address hr figcaption summary legend option".split())
HEAD_PARTS = frozenset("html head title meta link base basefont script style noscript template".split())
# parts of a text, which a region outgrows, and the page's own containers, which may hold more than the text
PARTS = frozenset("section header center table ul ol dl figure blockquote details".split())
PAGE = frozenset(("", "html", "body"))
# elements that a new one of the kind ends
REPEATED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "option": "option", "a": "a"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "comment comments disqus replies reply respond share sharing social related recommended "
    "newsletter subscribe subscription signup login search form widget toolbar pagination pager".split())
_BROKEN_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
_WORDS = re.compile(r"[A-Za-z]+")


def _is_furniture(tag: str, attrs: list) -> bool:
    if tag in FURNITURE:
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value and value.lower() in ROLES:
            return True
        if name in ("class", "id") and value and tag not in ("html", "body", "article", "main"):
            if any(word in NAMES for part in value.lower().split() for word in (part, *_WORDS.findall(part)[:1])):
                return True
        if name in ("class", "id") and value and tag == "article" and "comment" in value.lower():
            return True
    return False


class Line(NamedTuple):
    text: str
    tags: int
    container: int
    out: bool
    links: int  # characters inside links


class Element(NamedTuple):
    tag: str
    container: int
    article: bool  # inside an article or main element
    out: bool
    hidden: bool
    holds: bool  # is a container itself


class PageLines(HTMLParser):
    """Collects the lines of a page and its containers, a ``(tag, parent)`` each; number 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.containers: list[tuple[str, int]] = [("", 0)]
        self._open = [Element("", 0, False, False, False, True)]
        self._count: Counter[str] = Counter()
        self._pieces: list[str] = []
        self._tags = 0
        self._links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._pieces).split())
        at = self._open[-1]
        if text:
            self.lines.append(Line(text, self._tags, at.container, at.out, self._links))
            self._tags = 0
        self._pieces, self._links = [], 0

    def _close(self, *tags: str, through: bool = False) -> None:
        """End the innermost open element of the tags; only ``through`` looks past a container."""
        if not any(self._count[tag] for tag in tags):
            return
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag in tags:
                self._count.subtract(e.tag for e in self._open[i:])
                del self._open[i:]
                return
            if self._open[i].holds and not through:
                return

    def _end_head(self, tag: str) -> None:
        """A head ends at the body, or at the first element that is no part of it."""
        if self._count["head"] and (tag == "body" or (self._open[-1].tag in ("head", "title") and tag not in HEAD_PARTS)):
            self._close("head", through=True)

    def handle_starttag(self, tag, attrs):
        self._tags += 1
        self._end_head(tag)
        if tag in BLOCKS:
            self._end_line()
        if tag in VOID:
            if tag in ("br", "img"):
                self._pieces.append(" ")
            return
        if not self._open[-1].hidden:
            if tag in ("td", "th"):
                self._pieces.append(" ")
            if tag in BLOCKS:
                self._close("p")
            self._close(*REPEATED.get(tag, "").split())
        furniture = _is_furniture(tag, attrs)
        if tag in ("article", "main") and not furniture and not self._open[-1].hidden:
            # a menu or header that was never closed ends here
            while next((e.tag for e in reversed(self._open) if e.holds and e.tag not in ("ul", "ol")), "") in ("nav", "header"):
                self._close("nav", "header", through=True)
        _, container, article, out, hidden, _ = self._open[-1]
        hidden = hidden or tag in HIDDEN
        holds = not hidden and (tag in CONTAINERS or (furniture and tag in BLOCKS))
        if holds:
            self.containers.append((tag, container))
            container = len(self.containers) - 1
            out = out or furniture or (tag == "header" and not article)
            article = article or tag in ("article", "main")
        self._open.append(Element(tag, container, article, out, hidden, holds))
        self._count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._tags += 1
        if tag in BLOCKS:
            self._end_line()
        self._close(tag, through=tag in CONTAINERS or tag in HIDDEN)

    def handle_data(self, data):
        if self._open[-1].tag == "head" and data.strip():
            self._close("head", through=True)
        if not self._open[-1].hidden:
            self._pieces.append(data)
            if self._count["a"]:
                self._links += len(data.strip())

    def close(self):
        super().close()
        self._end_line()


def smoothed(values: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel keeps what lies inside."""
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma * sigma))
    inside = np.convolve(np.ones(len(values)), kernel)[radius:radius + len(values)]
    return np.convolve(values, kernel)[radius:radius + len(values)] / inside


def threshold(values: np.ndarray) -> float:
    """The least value of the upper of two clusters, the lower around zero, with the least spread within."""
    above = np.sort(values)[::-1]
    held = np.arange(1, len(above) + 1)
    # spread around zero of all values, less what the mean of the upper ones takes away
    return float(above[int((np.cumsum(above) ** 2 / held).argmax())])


def regions(lines: list[Line], content: list[bool], containers: list[tuple[str, int]]) -> list[bool]:
    """Which containers' lines are main text: the regions that content lines select, and what joins them."""
    n = len(containers)
    parent = [p for _, p in containers]
    top = list(range(n))  # the region that a line of the container selects
    bound = [False] * n
    for c in range(1, n):  # a container comes after its parent
        tag, p = containers[c]
        if bound[p] or (tag in PARTS and containers[p][0] not in PAGE):
            top[c] = top[p]
        bound[c] = bound[p] or tag in ("article", "main")
    whole, dense, links = [0] * n, [0] * n, [0] * n
    chosen = [False] * n
    for line, c in zip(lines, content, strict=True):
        whole[line.container] += len(line.text)
        dense[line.container] += c * len(line.text)
        links[line.container] += line.links
        if c:
            chosen[top[line.container]] = True
    branches, loose = [0] * n, [tag in PAGE for tag, _ in containers]
    for c in range(n - 1, -1, -1):
        if not chosen[c] and branches[c] > 1 and 2 * dense[c] >= whole[c]:
            chosen[c] = loose[c] = True
        if c:
            p = parent[c]
            branches[p] += chosen[c] or branches[c] > 0
            for sums in (whole, dense, links):
                sums[p] += sums[c]
    kept = chosen[:1]
    for c in range(1, n):
        p = parent[c]
        of_links = loose[p] and 2 * links[c] >= whole[c] and not branches[c]
        kept.append(chosen[c] or (kept[p] and not of_links))
    return kept


def main_text(page) -> str:
    if not isinstance(page, str) or not page:
        return ""
    parser = PageLines()
    parser.feed(_BROKEN_TAG.sub("", page))
    parser.close()
    if not parser.lines:
        return ""
    own = np.log1p([len(line.text) / max(1, line.tags) for line in parser.lines])
    ratio = smoothed(own)
    least = threshold(ratio)
    stays = np.array([not line.out for line in parser.lines])
    lines = [line for line in parser.lines if not line.out]
    # a line that only its neighbours lift selects no region, unless there is no other
    content = ((ratio >= least) & (own >= least))[stays].tolist()
    if not any(content):
        content = (ratio >= least)[stays].tolist()
    if any(content):
        kept = regions(lines, content, parser.containers)
        lines = [line for line in lines if kept[line.container]]
    return "\n\n".join(line.text for line in lines)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": [main_text(h) for h in batch["html"]]})


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.mapInPandas(_extract, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
