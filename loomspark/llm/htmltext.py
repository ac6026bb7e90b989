"""Main text of web pages from text-to-tag ratios.

The standard-library parser's events become lines, one for each block of the page. Each line's ratio of text to tags is smoothed with a Gaussian; lines over a
threshold form the content clusters, and the element that holds them is the content region. All of the region's lines are kept but those that its
markup names as something else than the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OUT = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
CONTAINERS = frozenset("article aside blockquote body center details dialog dir div dl fieldset figure footer form header li main menu nav ol search section table td tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template svg head title iframe object canvas audio video select textarea button map applet".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id names that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored promo promos promotion nav navbar navigation menu menus submenu breadcrumb "
    "breadcrumbs pagination pager header masthead topbar footer foot bottombar sidebar sidebars aside rail notice notices cookie cookies consent gdpr alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments commentlist respond responses reply replies reactions discussion disqus form search share sharing social related recommended widget widgets toolbar announcement "
    "paywall disclaimer copyright".split()
)
#: Beside one of these, a header is the article's own.
CONTENT_NAMES = frozenset("article content post story entry".split())
#: Lists, quotes, tables and the like are parts of an article, never all of it.
PARTS = frozenset("blockquote details dl figure li ol table td tr ul".split())
OWN_HEADER = frozenset("header head banner".split())
#: A class such as with-sidebar or has-comments tells of a layout, not what the element is.
LAYOUT_NAMES = frozenset("with without has have no enabled disabled layout".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_HEADING = re.compile(r"h[1-6]$")
_OPENING = re.compile(r"<[/!A-Za-z]")


#: What the markup says of an element.
PLAIN, MARKED = 1, 2


@dataclass
class Line:
    """A block of the page: its text, the tags since the line before, and the elements around it, outermost first. ``marks`` are those that a name or a form element
    makes boilerplate; a page's wrapper among them is excused when the whole page is known."""

    text: str
    tags: int
    linked: int
    kind: str
    path: tuple[int, ...]
    boilerplate: bool
    marks: tuple[int, ...] = ()
    dense: bool = False
    weight: float = 0.0


@dataclass
class _Element:
    tag: str
    number: int
    boilerplate: bool
    unseen: bool
    marked: bool = False


def _names(attrs: dict[str, str | None]) -> set[str]:
    """The words of an element's class and id."""
    return set(_NAME.findall(_CAMEL.sub(" ", f"{attrs.get('class') or ''} {attrs.get('id') or ''}").lower()))


class _Page(HTMLParser):
    """Turns the parser's events into lines, with a stack of the open block elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[_Element] = []
        self.articles: set[int] = set()
        #: For each marked element and each article the marked elements around it; the articles that aren't in plain boilerplate, main elements first.
        self.around: dict[int, tuple[int, ...]] = {}
        self.bodies: list[tuple[bool, int]] = []
        self.named: set[int] = set()
        self.parts: set[int] = set()
        self.count = self.tags = self.linked = self.anchors = 0
        self.text: list[str] = []
        self.kind = ""

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append(Line(text, self.tags, self.linked, self.kind, tuple(e.number for e in self.open if e.tag in CONTAINERS), any(e.boilerplate for e in self.open), self._marks()))
            self.tags = 0
        self.text, self.linked = [], 0

    def _marks(self) -> tuple[int, ...]:
        return tuple(e.number for e in self.open if e.marked)

    def _close(self, at: int) -> None:
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag == "hr":
                self._end_line()
            return
        if tag == "body":  # whatever the head left open
            self._close(next((i for i, e in enumerate(self.open) if e.unseen and e.tag == "head"), len(self.open)))
        if tag in BLOCKS:
            self._end_line()
            inner = self.open[-1].tag if self.open else ""
            if inner == "p" or inner == tag and tag in ("li", "dt", "dd", "td", "tr") or inner in ("dt", "dd") and tag in ("dt", "dd"):
                self._close(len(self.open) - 1)
            self.kind = tag
        if tag == "a":
            self.anchors += 1
        if tag in BLOCKS or tag in UNSEEN:
            self.count += 1
            inside = any(e.tag in ("article", "main") for e in self.open)
            kind = self._boilerplate(tag, dict(attrs), inside)
            if kind == MARKED or tag in ("article", "main"):
                self.around[self.count] = self._marks()
            self.open.append(_Element(tag, self.count, kind == PLAIN, tag in UNSEEN, kind == MARKED))
            if tag in ("article", "main"):
                self.articles.add(self.count)
                if not any(e.boilerplate for e in self.open):
                    self.bodies.append((tag != "main", self.count))
            elif tag in PARTS:
                self.parts.add(self.count)
            elif tag in CONTAINERS and tag != "body" and _names(dict(attrs)) & CONTENT_NAMES:
                self.named.add(self.count)

    def _boilerplate(self, tag: str, attrs: dict[str, str | None], inside: bool) -> int:
        """PLAIN if the element's name or role says that it isn't the article, MARKED if its class says so or it is a form, else 0. ``inside``: it stands in an
        article or main element."""
        get = lambda name: (attrs.get(name) or "").lower()
        if "hidden" in attrs or get("aria-hidden") == "true" or _HIDDEN.search(get("style")):
            return PLAIN
        if tag in ("html", "body"):
            return 0
        if tag != "form" and tag in BOILERPLATE_TAGS or tag == "header" and not inside or get("role") in BOILERPLATE_ROLES:
            return PLAIN
        names = _names(attrs)
        tokens = [_names({"id": x}) for x in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()] if names & BOILERPLATE_NAMES else []
        found = {n for t in tokens if not t & LAYOUT_NAMES for n in t & BOILERPLATE_NAMES}
        if tag in ("header", "hgroup") or _HEADING.match(tag) or names & CONTENT_NAMES:
            found -= OWN_HEADER
        return MARKED if found or tag == "form" else 0

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.anchors = max(0, self.anchors - 1)
        if tag in BLOCKS or tag in UNSEEN:
            if tag in BLOCKS:
                self._end_line()
            at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag), None)
            # The end of a paragraph doesn't end the containers that were opened in it.
            if at is not None and (tag in CONTAINERS or tag in UNSEEN or not any(e.tag in CONTAINERS for e in self.open[at + 1 :])):
                self._close(at)
            self.kind = next((e.tag for e in reversed(self.open) if e.tag in BLOCKS), "")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_data(self, data: str) -> None:
        if not any(e.unseen for e in self.open):
            self.text.append(data)
            if self.anchors:
                self.linked += len(data.strip())


def _excused(page: _Page) -> set[int]:
    """Marked elements that are wrappers of the article.

    If all article and main elements are in marked elements, those around the main one (a main element, or else the longest article that isn't marked itself, or the page's only one with a heading) are
    wrappers, unless more text than it has stands outside. If no line of a tenth of the mean ratio and no unmarked article stands outside of marked elements, the one with most text is a wrapper, and then within it alike; it has two dense lines at least.
    """
    excused: set[int] = set()
    if not any(x.marks for x in page.lines):
        return excused
    prose: dict[int, int] = {}
    size: dict[int, int] = {}
    for x in page.lines:
        if not x.boilerplate:
            for n in {*x.marks, *x.path}:
                size[n] = size.get(n, 0) + len(x.text)
                prose[n] = prose.get(n, 0) + x.dense
    plain = lambda: [x for x in page.lines if not x.boilerplate and excused.issuperset(x.marks)]
    marked = {m for x in page.lines for m in x.marks}
    own = [(k, n) for k, n in page.bodies if n not in marked] or [(k, n) for k, n in page.bodies if len(page.bodies) == 1 and not page.around[n] and any(x.kind in ("h1", "h2") and n in x.path for x in page.lines)]
    if own and all(page.around[n] for _, n in own if n not in marked):
        _, body = min(own, key=lambda b: (b[0], -size.get(b[1], 0)))
        if size.get(body, 0) >= max(1, sum(len(x.text) for x in plain())):
            excused |= {*page.around[body], body}
    free = {n for _, n in page.bodies if n not in marked and not page.around[n]}
    while not any(x.weight > 0.1 or free.intersection(x.path) and x.linked <= len(x.text) / 2 for x in plain()):
        left = [n for n in marked - excused if prose.get(n, 0) > 1 and excused.issuperset(page.around[n])]
        if not left:
            break
        excused.add(min(left, key=lambda n: (-size[n], n)))
    return excused


def page_lines(html: str | None) -> tuple[list[Line], set[int], set[int], set[int]]:
    """The lines of a page and the numbers of its article and main elements, of the elements with an article's name, and of lists, quotes and the like."""
    page = _Page()
    html = html or ""
    # A tag that the page's end cuts off is no text.
    last = html.rfind("<", html.rfind(">") + 1)
    page.feed(html[:last] if last >= 0 and _OPENING.match(html, last) else html)
    page.close()
    page._end_line()
    for x, dense in zip(page.lines, clusters([x for x in page.lines if not x.boilerplate], page.lines), strict=True):
        x.dense = dense
    mean = np.mean([ratio(x) for x in page.lines if not x.boilerplate] or [0])
    for x in page.lines:
        x.weight = ratio(x) / mean if mean else 0.0
    excused = _excused(page)
    for x in page.lines:
        x.boilerplate = x.boilerplate or any(m not in excused for m in x.marks)
    return page.lines, page.articles, page.named, page.parts


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Convolution with a Gaussian of ``sigma`` lines, whose weights are renewed at the page's ends."""
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def ratio(line: Line) -> float:
    return max(0, len(line.text) - line.linked) / max(1, line.tags)


def clusters(read: list[Line], lines: list[Line], sigma: float = 1.0, strength: float = 1.0) -> list[bool]:
    """For each of ``lines`` whether it lies in a content cluster of the page that ``read`` makes up.

    A line's ratio is that of its unlinked characters to the tags since the line before. The ratios are smoothed; neighbours of at least ``strength`` standard deviations, or half
    the mean if that is lower, form a cluster. It neither begins nor ends with lines that reach half of that by their neighbours' ratios only.
    """
    if not read:
        return [False] * len(lines)
    ratios = np.array([ratio(x) for x in read])
    smoothed = smooth(ratios, sigma)
    threshold = min(strength * float(smoothed.std()), float(ratios.mean()) / 2)
    over = (smoothed >= threshold) & (smoothed > 0)
    own = ratios >= threshold / 2
    run = np.cumsum(~over)
    found: set[int] = set()
    for k in np.unique(run[over]):
        inside = np.flatnonzero(over & (run == k))
        ends = inside[own[inside]]
        if len(ends):
            found.update(id(read[i]) for i in range(ends[0], ends[-1] + 1) if read[i].linked <= len(read[i].text) / 2)
    return [id(x) in found for x in lines]


def content_lines(lines: list[Line], articles: set[int], named: set[int] = frozenset(), parts: set[int] = frozenset(), sigma: float = 1.0, strength: float = 1.0) -> list[Line]:
    """The lines of the content region.

    All content clusters of the lines that the markup doesn't call boilerplate count, and all of their lines are kept. The article or main element with most of their text is the region, if it has
    more than 60 % of it; what its markup doesn't call boilerplate is kept whole. Without such an element the region is the innermost one that holds all clusters, and no list or quote,
    or the outermost one around it with an article's name. There, what lies between the clusters is kept, and beside them what stands directly in a container, or in a table or list, that holds some of their lines; a menu, a
    line of small print or the like outside of them goes by its ratio alone. Headings before the first cluster are kept.
    """
    plain = [x for x in lines if not x.boilerplate]
    seeds = [x for x, inside in zip(lines, clusters(plain, lines, sigma, strength), strict=True) if inside] or plain
    if not seeds:
        return []
    mass: dict[int, int] = {}
    depth: dict[int, int] = {0: 0}
    for x in seeds:
        for d, number in enumerate((0, *x.path)):
            mass[number] = mass.get(number, 0) + len(x.text)
            depth[number] = d
    most = max((n for n in mass if mass[n] > 0.6 * mass[0]), key=depth.__getitem__)
    around = next((x.path for x in seeds if most in x.path), ())
    region = next((n for n in around[: depth[most]] if n in articles), None)
    whole_region = region is not None
    if region is None:
        whole = max((n for n in mass if mass[n] == mass[0]), key=depth.__getitem__)
        outer = around[: depth[whole]]
        while outer and outer[-1] in parts:
            outer = outer[:-1]
        region = next((n for n in outer if n in named), outer[-1] if outer else 0)
        whole_region = region in named
    chosen = {id(x) for x in seeds}
    homes = {0, *(n for x in seeds for n in x.path)}

    def at_home(path: tuple[int, ...]) -> bool:
        """It stands directly in a container of a cluster's line, or in the same table or list."""
        inner = [n for n in path if n in parts]
        return (path[-1] if path else 0) in homes or bool(homes.intersection(inner)) and path[-1] in parts

    places = [i for i, x in enumerate(lines) if id(x) in chosen]
    first, last = places[0], places[-1]
    held = [(region == 0 or region in x.path) and not x.boilerplate and (whole_region or id(x) in chosen or first <= i <= last or at_home(x.path)) for i, x in enumerate(lines)]
    begin = held.index(True)
    # A heading before the region: the page's title, or one right before it.
    for i in range(begin - 1, -1, -1):
        if lines[i].kind == "h1" or lines[i].kind in ("h2", "h3", "hgroup") and all(held[i + 1 : begin + 1]):
            held[i] = not lines[i].boilerplate
    return [x for i, x in enumerate(lines) if held[i]]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by an empty line; empty if there is none."""
    return "\n\n".join(x.text for x in content_lines(*page_lines(html)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            pages = part.column(2)
            texts = [main_text(pages[i].as_py()) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=_OUT.names)


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    ``text`` is the page's main text: character references decoded, white space within a block made one space, blocks in page order joined by two line
    breaks, nothing cut. ``n_chars`` counts its code points. A null, empty or text-free page has an empty text. Markup that is never closed ends with its
    container or the page. Repeated rows give repeated rows, null identifiers and urls pass through, an empty table gives an empty result, other columns
    are not read. No shuffle; memory is one page.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(_extract, _OUT)
