"""Main text of web pages: text-to-tag ratio by line, smoothed, thresholded, as regions.

The standard library's parser sends its events as the page is fed to it. Block elements
cut the page into lines; a line's ratio is its characters outside links by the tags that it
holds, 0 in forms, menus and what else the elements and roles of HTML put aside or do not show. The
ratios are smoothed by a Gaussian over neighbouring lines, and lines above the
deviation of all lines are content; the core is those whose own ratio is above it too.

The region is a main element that holds more than
`most` of the content, or else all article elements if they do; all of its shown lines are
returned. Without such elements it is the innermost container of the core with the headings right
before it, and its parts are judged as runs: a box (div, section, ...) before the first or behind
the last core line that has no core line of its own goes, and so does a list, table or box without one,
wherever it is, that is mostly links. All other lines stay, short ones too.

Words of class and id support this. Those in `ALWAYS` (adverts, comments, sidebars, notices) put a
box aside unless the core lines outside have less than `LEAST_REST` of its text. Those in `NAMES` do so if they are the whole name
(`footer`, `site-footer`); in a name with other words (`menu-planning`, `related-work`) or for `UNSURE` ones
only if the box's mean ratio is not above the deviation. They never put aside a heading, what a box
has (`has-sidebar`) or a box with most of the page's text, but for boxes beside an article or main element.

Null and empty pages give an empty text. Unclosed and stray tags are closed by the
elements around them, a head by the page's content; what the parser can't read as a
tag is text or a comment. Repeated pages are each extracted; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements of HTML and the words by which pages name their parts.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside body center dd details div fieldset footer form header main nav section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
SILENT = frozenset("script style noscript template head title iframe object svg canvas select button textarea datalist audio video option".split())
ASIDE = frozenset("nav header footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promoted cookie cookies consent gdpr "
    "popup modal newsletter subscribe subscription signup paywall sidebar sidebars breadcrumb breadcrumbs pagination pager "
    "comment comments commentlist replies respond disqus".split()
)
NAMES = frozenset(
    "promo promos promotion banner notice notices alert alerts overlay aside asides menu menus nav navbar navigation topnav header "
    "masthead topbar footer bottombar copyright reply share sharing social related recommended recommendations widget widgets "
    "toolbar login search form hidden discussion".split()
)
#: Names of content as well, and words that add nothing to a name.
UNSURE = frozenset(("discussion",))
PLAIN_WORDS = frozenset("site page main top bottom left right primary secondary global box bar list links posts articles wrapper container inner outer area".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = frozenset("ul ol dl table".split())
#: A name after one of these tells what a box has, not what it is.
HAVING = frozenset("has have with without no not".split())
WHOLE = frozenset(("article", "main"))
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: A block may not be closed from inside these by the start of another.
SCOPE = CONTAINERS | {"ul", "ol", "dl", "table", "blockquote", "html"}
ENDS_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
PIECE = 1 << 16
LEAST_REST = 0.05


class Lines(HTMLParser):
    """Collects (text, tags, containers, shown) of each line, its characters in links and whether it is a heading."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], bool]] = []
        self.linked: list[int] = []
        self.heading: list[bool] = []
        self.whole: dict[int, str] = {}
        self.groups: set[int] = set()  # lists and tables
        self._always: set[int] = set()  # of the named boxes
        self._unsure: set[int] = set()
        self._links = 0
        # Element, shown, containers, boxes around that may be put aside by their names.
        self._stack: list[tuple[str, bool, tuple[int, ...], tuple[int, ...]]] = []
        self._named: list[tuple[int, ...]] = []  # of each line
        self._names = 0
        self._text: list[str] = []
        self._tags = 0
        self._made = 0

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _state(self) -> tuple[bool, tuple[int, ...], tuple[int, ...]]:
        return self._stack[-1][1:] if self._stack else (True, (), ())

    def _cut(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            shown, where, named = self._state()
            self.lines.append((text, max(1, self._tags), where, shown))
            self._named.append(named)
            self.linked.append(min(self._links, len(text)))
            self.heading.append(any(x[0] in HEADINGS for x in self._stack))
        self._text, self._tags, self._links = [], 0, 0

    def _close(self, names: tuple[str, ...]) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] in names:
                del self._stack[i:]
                return
            if self._stack[i][0] in SCOPE:
                return

    def _hides(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in SILENT:
            return True
        inside = any(x[0] in WHOLE for x in self._stack)
        if tag in ASIDE and not (tag == "header" and inside):
            return True
        if tag in ("html", "body") or tag in WHOLE:
            return False
        for key, value in attrs:
            value = (value or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key == "role" and value in ROLES or key == "style" and re.search(r"display\s*:\s*none", value):
                return True
        return False

    def _named_by(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """How words of class or id put the element aside: always, by name, unsure or (empty) not."""
        if tag in ("html", "body") or tag in WHOLE or tag in HEADINGS or tag not in BLOCKS and tag not in ("span", "ins"):
            return ""
        if tag == "header" and any(x[0] in WHOLE for x in self._stack):
            return ""
        found = set()
        for key, value in attrs:
            for name in (value or "").lower().split() if key in ("class", "id") else ():
                parts = {x for x in re.split(r"[^a-z]+", name) if x}
                if not HAVING.isdisjoint(parts):
                    continue
                if not ALWAYS.isdisjoint(parts):
                    found.add("always")
                elif not NAMES.isdisjoint(parts):
                    found.add("name" if parts <= NAMES | PLAIN_WORDS and UNSURE.isdisjoint(parts) else "unsure")
        return next((x for x in ("always", "name", "unsure") if x in found), "")

    def _end_head(self) -> None:
        """A head without an end tag ends where the page's content begins."""
        names = [x[0] for x in self._stack]
        if "head" in names and set(names[names.index("head") + 1 :]) <= {"title"}:
            del self._stack[names.index("head") :]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCKS:
            self._cut()
            if tag in ENDS_P:
                self._close(("p",))
        if tag in CLOSES:
            self._close(CLOSES[tag])
        self._tags += 1
        if tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        shown, where, named = self._state()
        hides = shown and self._hides(tag, attrs)
        puts = self._named_by(tag, attrs) if shown and not hides else ""
        if (hides or puts) and tag not in BLOCKS and tag not in SILENT:
            self._cut()
        shown = shown and not hides
        if puts:
            self._names += 1
            named = (*named, self._names)
            if puts == "always":
                self._always.add(self._names)
            elif puts == "unsure":
                self._unsure.add(self._names)
        if tag in CONTAINERS or tag in GROUPS:
            self._made += 1
            where = (*where, self._made)
            if tag in GROUPS:
                self.groups.add(self._made)
            if tag in WHOLE:
                self.whole[self._made] = tag
        self._stack.append((tag, shown, where, named))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: a slash closes nothing

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self._stack) - 1, -1, -1) if self._stack[i][0] == tag), None)
        if tag in BLOCKS:
            self._cut()
        if at is None or tag in ("html", "body"):
            return
        if tag not in BLOCKS and any(x[0] in SCOPE for x in self._stack[at + 1 :]):
            return  # a stray inline end tag does not close a block
        if tag not in BLOCKS and tag not in SILENT and self._stack[at][1::2] != (self._stack[at - 1][1::2] if at else (True, ())):
            self._cut()
        del self._stack[at:]

    def handle_data(self, data: str) -> None:
        if self._stack and self._stack[-1][0] == "head" and data.strip():
            self._end_head()
        if not any(x[0] in SILENT for x in self._stack):
            self._text.append(data)
            if any(x[0] == "a" for x in self._stack):
                self._links += len(" ".join(data.split()))

    def done(self) -> list[tuple[str, int, tuple[int, ...], bool]]:
        self.close()
        self._cut()
        n = np.array([len(text) * shown for text, _, _, shown in self.lines], float)
        ratios = self.ratios()
        high = _threshold(ratios)
        boxes: dict[int, list[int]] = {}
        for i, named in enumerate(self._named):
            for box in named:
                boxes.setdefault(box, []).append(i)
        whole = {i for i, line in enumerate(self.lines) if n[i] and not self.whole.keys().isdisjoint(line[2])}
        always = {i for box in self._always for i in boxes.get(box, ())}
        # What would be left without those boxes: core lines with `LEAST_REST` of the text inside.
        rest = [i for i in range(len(n)) if n[i] and i not in always]
        above = _threshold(ratios[rest])
        core = [i for i in rest if ratios[i] > above]
        hidden, kept, lifted = n[sorted(always)].sum(), n[core].sum(), set()
        for box, held in boxes.items():
            beside = len(whole) > sum(i in whole for i in held)  # an article or main element outside
            if box in self._always:
                lifts = kept < LEAST_REST * n[held].sum() and not beside
            elif box in self._unsure:
                lifts = ratios[held].mean() > high
            else:
                # Most of the text that is not put aside anyway.
                free = n.sum() - hidden + sum(n[i] for i in held if i in always)
                lifts = 2 * n[held].sum() > free and not beside
            if lifts:
                lifted.add(box)
        self.lines = [(*line[:3], line[3] and lifted.issuperset(named)) for line, named in zip(self.lines, self._named)]
        return self.lines

    def ratios(self) -> np.ndarray:
        """Characters outside links by tags of each line, 0 where it is not shown."""
        return np.array([(len(text) - links) / tags * shown for (text, tags, _, shown), links in zip(self.lines, self.linked)], float)


def _threshold(values: np.ndarray) -> float:
    """The deviation of all lines; 0 where they do not differ."""
    return float(np.std(values)) if len(values) and np.ptp(values) else 0.0


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian over neighbouring lines; beyond the page's ends there are no lines."""
    radius = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weight


def extract(html: str, sigma: float = 1.0, most: float = 0.6) -> str:
    """The shown lines of the region that holds the content: of main or article elements with more than `most` of it, else of all."""
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    lines = parser.done()
    if not lines:
        return ""
    shown = np.array([line[3] for line in lines])
    ratios = parser.ratios()
    smoothed = smooth(ratios, sigma)
    high = _threshold(smoothed)
    content = shown & (smoothed > high)
    if not content.any():
        content = shown
    # A main element with most of the content, else all articles if they hold most of it, else all.
    found = np.flatnonzero(content)
    total = sum(len(lines[i][0]) for i in found)
    mass: dict[int, int] = {}
    for i in found:
        for box in lines[i][2]:
            mass[box] = mass.get(box, 0) + len(lines[i][0])
    boxes = {box for box, tag in parser.whole.items() if tag == "main" and mass.get(box, 0) > most * total}
    if not boxes:
        boxes = set(parser.whole)
        if sum(len(lines[i][0]) for i in found if not boxes.isdisjoint(lines[i][2])) <= most * total:
            boxes = set()
    if boxes:
        return "\n".join(text for text, _, where, seen in lines if seen and not boxes.isdisjoint(where))
    core = np.flatnonzero(content & (ratios > high))
    if not len(core):
        core = found
    # The innermost container of the core.
    region = lines[core[0]][2] if len(core) else ()
    for i in core:
        while lines[i][2][: len(region)] != region:
            region = region[:-1]
    # Headings right before it belong to it.
    first = next((i for i, line in enumerate(lines) if line[2][: len(region)] == region), 0)
    while first and parser.heading[first - 1] and content[first - 1]:
        first -= 1
        while lines[first][2][: len(region)] != region:
            region = region[:-1]
    depth, kept = len(region), []
    parts: dict[int, list[int]] = {}  # the lines of each box in the region, those outside a box are one part
    for i, (_, _, where, seen) in enumerate(lines):
        if seen and where[:depth] == region:
            parts.setdefault(where[depth] if len(where) > depth else 0, []).append(i)
    held = set(core.tolist())
    for box, each in parts.items():
        if held.isdisjoint(each) and box:
            links = sum(parser.linked[i] for i in each)
            outside = len(core) and (each[-1] < core[0] or each[0] > core[-1])
            title = all(parser.heading[i] for i in each) and each[-1] < core[-1]
            if 2 * links > sum(len(lines[i][0]) for i in each) or outside and box not in parser.groups and not title:
                continue
        kept += each
    return "\n".join(lines[i][0] for i in sorted(kept))


def _extracted(sigma: float, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(page or "", sigma, most) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def main_texts(pages: DataFrame, sigma: float = 1.0, most: float = 0.6) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    page_id = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extracted(sigma, most), f"page_id {page_id}, url string, text string, n_chars long")
