"""Main text of HTML pages from the events of the standard-library parser.

Events become lines of text, one for each block of the page as it is shown, in page order. A line's ratio of text to
tags is smoothed with a Gaussian along the page, and a threshold (a share of the standard deviation of the smoothed
ratios, as those of menus lie near zero) clusters the lines:

1. A line that has the threshold by itself and smoothed is content, unless most of it is links.
2. From there content grows over the neighbouring lines of the same container (article or main, else the nearest div,
   section or cell), but not over lines of links: so short paragraphs and headings of an article stay.
3. Lines between two of content that have the threshold smoothed only are content, as is a single line of links there,
   and headings right before it.

If an article or main element holds most of the content, nothing outside of it counts. Lines in menus, headers,
footers, sidebars, forms, adverts, notices, comments, scripts and the like are excluded by their element, role or
class; they count as zero in the smoothing, and such lists only ever exclude.

Defined results: a null or empty page, or one without content, gives the empty string; tags that never close and
pages that break off are read as far as they go (a tag that breaks off is no text); repeated rows get equal
results; extra columns are ignored, whatever their names. Whole pages are read, in time linear in their length.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body dd details dialog dl dt div fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody thead tfoot tr ul".split())
SPACING = frozenset(("br", "td", "th", "wbr"))
NEVER = frozenset("script style noscript template head title nav footer aside form button select textarea iframe object svg canvas video audio menu dialog search fieldset".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements whose lines belong together, where no article or main does it.
CONTAINERS = frozenset(("body", "html", "div", "section", "td", "th", "center", "details"))
SCOPE = frozenset("html body article main section div nav header footer aside form table td th ul ol dl blockquote figure details".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Words of a class or id that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notification paywall popup promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: What opening one of these closes, within the same element of SCOPE.
CLOSES = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
SIGMA, REACH, SHARE = 1.0, 3, 0.5
KERNEL = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
KERNEL /= KERNEL.sum()
SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    """An open element, and what its lines get from it and those around it."""

    __slots__ = ("tag", "parent", "barred", "heading_only", "goal", "article", "container", "link")

    def __init__(self, tag: str, parent: Element | None, barred: bool = False, heading_only: bool = False, goal: bool = False):
        self.tag, self.parent, self.barred, self.heading_only = tag, parent, barred, heading_only
        #: The outermost article or main, the outermost article, and the element whose lines belong together.
        self.goal = parent.goal if parent is not None and parent.goal is not None else self if goal else None
        self.article = parent.article if parent is not None and parent.article is not None else self if tag == "article" else None
        self.container = self.goal or (self if parent is None or tag in CONTAINERS else parent.container)
        self.link = tag == "a" or parent is not None and parent.link and tag not in BLOCK


class Line:
    __slots__ = ("text", "tags", "links", "at", "barred")

    def __init__(self, text: str, tags: int, links: int, at: Element, barred: bool):
        self.text, self.tags, self.links, self.at, self.barred = text, tags, links, at, barred


class Lines(HTMLParser):
    """Collects the lines of a page; of text in barred elements, only that there was some."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = Element("", None)
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.skipped = False
        self.tags = self.links = 0
        self.found: list[Line] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text or self.skipped:
            at = self.at
            self.found.append(Line(text, self.tags, self.links, at, not text or at.heading_only and at.tag not in HEADINGS))
            self.tags = 0
            self.skipped = False
        self.links = 0
        self.parts = []

    def close(self) -> None:
        super().close()
        self.end_line()

    def leave(self, element: Element) -> None:
        """Closes element and all that is open inside it."""
        while self.at is not element:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[element.tag] -= 1
        self.at = element.parent

    def close_tag(self, tags: tuple[str, ...]) -> None:
        at: Element | None = self.at if any(self.open[t] for t in tags) else None
        while at is not None and at.parent is not None:
            if at.tag in tags:
                self.leave(at)
                return
            if at.tag in SCOPE and at.tag not in ("td", "th") or at.tag in ("td", "th") and "td" not in tags:
                return
            at = at.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            self.close_tag(("p",))
        elif tag in SPACING:
            self.parts.append(" ")
        if tag in CLOSES:
            self.close_tag(CLOSES[tag])
        if tag in VOID:
            return
        up = self.at
        barred, heading_only, goal = up.barred or tag in NEVER, up.heading_only, tag in ("article", "main")
        if tag == "header":
            if up.goal is not None:
                heading_only = True
            else:
                barred = True
        for name, value in attrs:
            if name in ("class", "id") and value and not goal and tag not in ("html", "body"):
                barred = barred or not MARKS.isdisjoint(SPLIT.split(value.lower()))
            elif name == "role" and value:
                role = value.strip().lower()
                barred, goal = barred or role in ROLES, goal or role == "main"
            elif name == "hidden" and tag not in ("html", "body"):
                barred = True
        self.at = Element(tag, up, barred, heading_only, goal)
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
        elif tag in SPACING:
            self.parts.append(" ")
        at: Element | None = self.at if self.open[tag] else None
        while at is not None and at.parent is not None:
            if at.tag == tag:
                self.leave(at)
                return
            if at.tag in SCOPE and tag not in SCOPE:
                return
            at = at.parent

    def handle_data(self, data: str) -> None:
        if self.at.barred:
            self.skipped = self.skipped or not data.isspace()
        else:
            self.parts.append(data)
            if self.at.link:
                self.links += len(data)


def ratios(lines: list[Line]) -> np.ndarray:
    """The ratio of text to tags of each line; a barred one has zero."""
    return np.array([0.0 if x.barred else len(x.text) / max(1, x.tags) for x in lines])


def smooth(ratio: np.ndarray) -> np.ndarray:
    return np.convolve(np.pad(ratio, REACH, mode="edge"), KERNEL, mode="valid")


def content(lines: list[Line], ratio: np.ndarray) -> np.ndarray:
    """Which lines are content, by their ratios."""
    n = len(lines)
    if not n:
        return np.zeros(0, bool)
    even = smooth(ratio)
    threshold = SHARE * even.std()
    free = np.array([not x.barred for x in lines])
    links = np.array([2 * x.links > len(x.text) for x in lines])
    high = free & (even >= threshold) & (even > 0)
    chosen = high & (ratio >= threshold) & ~links
    inside = within(lines, chosen)
    chosen &= inside
    free &= inside
    group = [id(x.at.container) for x in lines]
    for order in (range(1, n), range(n - 2, -1, -1)):
        step = 1 if order.step > 0 else -1
        for i in order:
            if chosen[i - step] and free[i] and not links[i] and group[i] == group[i - step]:
                chosen[i] = True
    at = np.flatnonzero(chosen)
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        if b - a > 1 and (high[a + 1 : b] & free[a + 1 : b] & ~links[a + 1 : b]).all() or b - a == 2 and free[a + 1] and group[a] == group[b]:
            chosen[a + 1 : b] = True
    for i in range(n - 2, -1, -1):
        if chosen[i + 1] and free[i] and lines[i].at.tag in HEADINGS:
            chosen[i] = True
    return chosen


def within(lines: list[Line], chosen: np.ndarray) -> np.ndarray:
    """Which lines are inside the article or main that holds most of the chosen text; all, if none does."""
    total = 0
    goals: Counter = Counter()
    articles: Counter = Counter()
    for i in np.flatnonzero(chosen).tolist():
        at, size = lines[i].at, len(lines[i].text)
        total += size
        goals[at.goal] += size
        articles[at.article] += size
    for held, part in ((articles, 0.9), (goals, 0.5)):  # an article within main, if it has nearly all
        for element, size in held.most_common(1):
            if element is not None and size > part * total:
                return np.array([(x.at.article if held is articles else x.at.goal) is element for x in lines])
    return np.ones(len(lines), bool)


def page_lines(html: str) -> list[Line]:
    parser = Lines()
    broken = html.rfind("<")
    if broken > html.rfind(">") and html[broken + 1 : broken + 2] not in (" ", ""):
        html = html[:broken] if html[broken + 1 : broken + 2].isalpha() or html[broken + 1 : broken + 2] in "/!?" else html
    elif broken >= 0 and broken == len(html) - 1:
        html = html[:-1]
    parser.feed(html)
    parser.close()
    return parser.found


def main_text(html: str) -> str:
    lines = page_lines(html)
    return "\n".join(x.text for x, y in zip(lines, content(lines, ratios(lines)), strict=True) if y)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page; one pass, no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x or "") for x in batch.column(2).to_pylist()]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    id_type = pages.schema[id_col].dataType.simpleString()
    out = map_batches(pages.select(column(id_col).alias("id"), column(url_col).cast("string").alias("url"), column(html_col).cast("string").alias("html")), run, f"id {id_type}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
