"""Main text of web pages by text-to-tag ratios."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0
APART = 3.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre "
    "section summary table tbody tfoot thead title tr ul".split()
)
NEVER = frozenset(
    "aside audio button canvas dialog footer form head iframe menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
REGIONS = frozenset("body div main article section td".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form navigation search".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer discussion disqus footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promotion recommended related replies reply respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split()
)
TALK = frozenset("comment comments disqus replies reply respond".split())
BOXES = frozenset("article div dl ol section table ul".split())
STOPS = REGIONS | frozenset("aside blockquote dl nav ol table ul".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")

# How an element counts: with what is around it, as a region that its ratios judge, not at all.
PLAIN, SUSPECT, OUT = 0, 1, 2


@dataclass(frozen=True)
class Line:
    """What stands between two tags of block elements: its text, number of tags and region.

    The region is the innermost suspect element around it, else the outermost
    article or main element, else the innermost other container.
    """

    text: str
    tags: int
    region: int
    article: bool
    suspect: bool


class _Page(HTMLParser):
    """Collects the lines of a page; text inside elements that are left out makes no line.

    For every name the places of its open elements are kept, and apart the
    places of containers, so that no tag looks through the open elements.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.containers: list[int] = []
        self.stops: list[int] = []
        self.regions: list[tuple[int, int, bool, bool]] = [(-1, 0, False, False)]
        self.parts: list[str] = []
        self.tags = self.number = self.out = 0
        self.in_head = False

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, max(1, self.tags), *self.regions[-1][1:]))
        if self.parts:
            self.tags = 0
        self.parts.clear()

    def _inside(self) -> bool:
        return bool(self.places["article"] or self.places["main"])

    def _role(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """Whether an element is left out, or suspect: inside an article a name alone deletes nothing."""
        if tag in NEVER:
            return OUT
        inside = self._inside()
        if tag == "header" and not inside:
            return OUT
        if not attrs or tag in ("html", "body", "main"):
            return PLAIN
        given = {name: value or "" for name, value in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "") in ROLES:
            return OUT
        for value in (given.get("class", ""), given.get("id", "")):
            for name in value.split():
                words = {word.lower() for word in _TOKEN.findall(name)}
                if words & {"has", "no", "with", "without"}:
                    continue
                if words & (TALK if tag == "article" else NAMES):
                    if not inside or (tag in BOXES and words & TALK):
                        return OUT
                    return SUSPECT if tag in BOXES else PLAIN
                if "header" in words and not inside:
                    return OUT
        return PLAIN

    def _push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        role, inside, place = self._role(tag, attrs), self._inside(), len(self.open)
        self.number += 1
        self.out += role == OUT
        if role == SUSPECT:
            self.regions.append((place, self.number, True, True))
        elif tag in REGIONS and not inside:
            self.regions.append((place, self.number, tag in ("article", "main"), False))
        self.open.append((tag, role == OUT))
        self.places[tag].append(place)
        if tag in REGIONS:
            self.containers.append(place)
        if tag in STOPS:
            self.stops.append(place)

    def _cut(self, place: int) -> None:
        """End the open element at this place and all inside it."""
        while len(self.open) > place:
            tag, out = self.open.pop()
            self.out -= out
            self.places[tag].pop()
            if tag in REGIONS:
                self.containers.pop()
            if tag in STOPS:
                self.stops.pop()
        while self.regions[-1][0] >= place:
            self.regions.pop()

    def _close(self, tag: str) -> None:
        """End the innermost element of this name; no container, if the name is not of a block."""
        if not self.places[tag]:
            return
        place = self.places[tag][-1]
        if tag in BLOCKS or not self.containers or self.containers[-1] <= place:
            self._cut(place)

    def _close_above(self, tag: str) -> None:
        """End an open element of this name unless a container lies in between."""
        if self.places[tag] and (not self.stops or self.stops[-1] < self.places[tag][-1]):
            self._cut(self.places[tag][-1])

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_line()
            self._close_above("p")
            if tag in ("li", "tr", "dt", "dd"):
                self._close_above(tag)
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if self.in_head and tag in BLOCKS and tag != "title":
            self._close("head")
            self.in_head = False
        elif tag == "head":
            self.in_head = True
        if tag not in VOID:
            self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag not in VOID:
            self._close(tag)

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def handle_data(self, data):
        if not self.out:
            self.parts.append(data)

    def finish(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; at the ends the kernel is cut and rescaled."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    total = np.convolve(values, kernel)[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """Between the two clusters of line ratios; none, if they are not ``APART`` times apart."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(above) or not len(below):
            break
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high > APART * low else -1.0


def main_text(html: str) -> str:
    """The content regions of a page, blocks joined by an empty line.

    Each line's ratio of text to tags is smoothed over its neighbours in the
    same region, and a threshold between two clusters tells content lines. A
    region is content when content lines hold at least half of its text, and
    is then taken whole, short lines included. Elements for menus, page
    headers, footers, side bars, forms and scripts belong to no region, nor do
    containers whose class or id names them as such, as adverts, notices or
    reader comments. Inside an article or main element such a name only makes
    a container a region of its own, to be judged by its ratios (but reader
    comments go); paragraphs, headings and inline elements are not judged by
    name there. If an article or main element is content, regions outside such
    elements are not; if no region is content, the one with most text is.
    """
    page = _Page()
    page.feed(_CUT_TAG.sub("", html))
    lines = page.finish()
    if not lines:
        return ""
    regions: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        regions.setdefault(line.region, []).append(i)
    ratios = np.array([len(line.text) / line.tags for line in lines])
    for own in regions.values():
        ratios[own] = smoothed(ratios[own])
    content = ratios > threshold(ratios)
    total = {region: sum(len(lines[i].text) for i in own) for region, own in regions.items()}
    dense = {region: sum(len(lines[i].text) for i in own if content[i]) for region, own in regions.items()}
    chosen = {region for region in regions if 2 * dense[region] >= total[region]}
    articles = {line.region for line in lines if line.article and not line.suspect}
    if chosen & articles:
        chosen &= articles | {line.region for line in lines if line.suspect}
    if not chosen:
        chosen = {max(articles or total, key=total.__getitem__)}
    return "\n\n".join(line.text for line in lines if line.region in chosen)


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            texts = [main_text(html or "") for html in part.column("html").to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, schema=_TEXT)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``; other columns are ignored.

    A null or empty html gives an empty text. Each page is parsed by itself,
    so repeated rows give repeated results and nothing is shuffled.
    """
    slim = pages.select("page_id", "url", "html")
    return slim.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
