"""Main text of web pages by text density.

The standard library's parser streams over a page.  Its events make lines, one per block element, each with
its text, its number of tags and links and the element it lies in.  The text-to-tag ratios of the lines are
smoothed with a Gaussian, and splitting them into two clusters gives a threshold; lines above it by
themselves mark the content regions, on pages with articles as on others.  A region is taken whole: the
outermost article around such a line, or outside articles the nearest container (division, section, cell,
body) around it that has further lines, with all headings, lists, quotes and tables in it; without a region
in an article, so is each line that smoothing lifts above the threshold.  Further articles on the page are
regions too, however short, unless most of their text lies in links.  Text in links counts with ratio 0, and
a block in a region with two links or more, most of its text in them and no dense line is left out, also a list
of links alone; inside an article lists and tables of links stay.

Lines of menus, page heads and feet, sidebars, notices, adverts, forms, scripts, styles and reader comments
count with ratio 0 and are never taken.  Class names and ids count as whole names.  What tells of something to
skip is not believed where it cannot be: no name, tag or attribute but those of scripts, styles and controls skips
what is or holds the page's main article, which is the one with most text outside links, first of those that
nothing hides, then of those not written by readers; nor, on pages without one (or with hidden ones alone, which
hold less than half of the text), does a name, a form,
a hidden element or ``noscript`` skip most of the text.  A heading element in an article is part of it.

Character references are decoded, runs of ASCII white space become one space and the lines are joined by one
space.  Null and empty pages give an empty text, as do pages without any text.  Repeated rows and null ids are
kept; an unclosed element lasts to the end of its parent.  The time is in proportion to the page's length,
however deep its elements are nested.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
# Never text of the page.
_CONTROLS = frozenset("head script style template button select textarea iframe object svg canvas".split())
# Beside the main text by their meaning.
_BESIDE = frozenset("nav header footer aside menu".split())
_BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search menu".split())
# Not shown at first, or shown for input; whole pages lie in such elements.
_COVERED = frozenset("noscript form dialog".split())
_COVERED_ROLES = frozenset("dialog alertdialog form".split())
_SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "header masthead footer sidebar aside cookie cookies consent gdpr notice notices banner popup modal comment comments "
    "disqus replies share sharing social related newsletter subscribe breadcrumb breadcrumbs pagination "
    "ad-banner ad-block ad-box ad-container ad-slot ad-unit adsbygoogle main-nav main-navigation site-nav site-navigation "
    "nav-bar nav-menu main-menu site-header site-footer page-footer left-sidebar right-sidebar sidebar-left sidebar-right "
    "cookie-banner cookie-bar cookie-consent cookie-notice comment-list comment-section comments-area comments-section "
    "related-articles related-posts share-buttons social-icons social-links social-share".split()
)
# Readers may write more than the author.
_READERS = frozenset("comment comments disqus replies comment-list comment-section comments-area comments-section".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ARTICLES = frozenset(("article", "main"))
_HEADS = frozenset(("header", "masthead"))
_LISTS = frozenset("ul ol dl table".split())
_PAGE = frozenset(("", "html", "body"))
_CONTAINERS = _PAGE | _ARTICLES | frozenset("div section td th center fieldset details".split())


class _Line:
    __slots__ = ("parts", "tags", "links", "linked", "depth", "element")

    def __init__(self, depth: int, element: int):
        self.parts: list[str] = []
        self.tags = self.links = self.linked = 0
        self.depth, self.element = depth, element


class _Element:
    __slots__ = ("tag", "above", "control", "beside", "covered", "names")

    def __init__(self, tag: str, above: int, control: bool, beside: bool, covered: bool, names: frozenset[str]):
        self.tag, self.above, self.names = tag, above, names
        self.control, self.beside, self.covered = control, beside, covered


class _Lines(HTMLParser):
    """Collects the lines and the elements of a page; an element comes after the one it lies in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.elements = [_Element("", 0, False, False, False, frozenset())]
        # Open elements: tag, number, doubtful elements around it, in a link, place of the nearest block.
        self.open: list[tuple[str, int, int, bool, int]] = [("", 0, 0, False, 0)]
        self.count: Counter[str] = Counter()
        self._fresh()

    def _fresh(self) -> None:
        _, number, depth, _, _ = self.open[-1]
        self.lines.append(_Line(depth, number))

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            self.count[self.open.pop()[0]] -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            self.lines[-1].tags += 1
            if tag == "br":
                self.lines[-1].parts.append(" ")
            elif tag == "hr":
                self._fresh()
            return
        inline = tag in _INLINE
        block = self.open[-1][4]
        if not inline and self.open[block][0] == "p":
            # A block ends an open paragraph, also behind unclosed inline elements.
            self._close(block)
        _, above, depth, linked, block = self.open[-1]
        element = _Element(tag, above, tag in _CONTROLS, *_doubts(tag, attrs))
        link = tag == "a" and any(name == "href" for name, _ in attrs)
        depth += element.control or element.beside or element.covered or bool(element.names)
        self.open.append((tag, len(self.elements), depth, linked or link, block if inline else len(self.open)))
        self.count[tag] += 1
        self.elements.append(element)
        if not inline or depth != self.lines[-1].depth:
            self._fresh()
        self.lines[-1].tags += 1
        self.lines[-1].links += link

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.count[tag]:
            return
        at = len(self.open) - 1
        while self.open[at][0] != tag:
            at -= 1
        self._close(at)
        self.lines[-1].tags += 1
        if tag not in _INLINE or self.open[-1][2] != self.lines[-1].depth:
            self._fresh()

    def handle_data(self, data: str) -> None:
        self.lines[-1].parts.append(data)
        if self.open[-1][3]:
            self.lines[-1].linked += len(data.strip())


def _doubts(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool, frozenset[str]]:
    """Whether a tag stands beside the text, is covered, and its whole class names and ids that tell of something to skip."""
    if tag in ("html", "body"):
        return False, False, frozenset()
    beside, covered, names = tag in _BESIDE, tag in _COVERED, ""
    for name, value in attrs:
        value = (value or "").lower()
        if name in ("class", "id"):
            names += f" {value}"
        elif name == "role":
            beside |= value in _BESIDE_ROLES
            covered |= value in _COVERED_ROLES
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            covered = True
        elif name == "style":
            covered |= "display:none" in value.replace(" ", "")
    return beside, covered, _SKIPPED_NAMES.intersection(names.replace("_", "-").split()) if names else frozenset()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends the weights are shared out anew."""
    reach = np.arange(-int(3 * sigma), int(3 * sigma) + 1)
    kernel = np.exp(-(reach**2) / (2 * sigma**2))
    middle = len(reach) // 2
    sums = np.convolve(ratios, kernel)[middle : middle + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), kernel)[middle : middle + len(ratios)]


def split_point(values: np.ndarray) -> float:
    """Threshold between two clusters on a line, by two-means from the ends."""
    low, high = float(values.min()), float(values.max())
    for _ in range(100):
        middle = (low + high) / 2
        above = values > middle
        if above.all() or not above.any():
            return middle
        now = float(values[~above].mean()), float(values[above].mean())
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def _closed(html: str) -> str:
    """The page without openings that nothing closes, each of which the parser would follow to the end.

    Of comments behind the last end of one, and of ``<`` behind the last ``>``, only the last stays.
    """
    for opening, closing, instead in (("<!--", "-->", ""), ("<", ">", "&lt;")):
        end = html.rfind(closing) + 1
        last = html.rfind(opening, end)
        if last > end:
            html = html[:end] + html[end:last].replace(opening, instead) + html[last:]
    return html


def main_text(html: str | None) -> str:
    """The main text of a page.

    >>> main_text("<nav>Home</nav><article><h1>A</h1><p>b &amp;<br>c</article><footer>f</footer>")
    'A b & c'
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(_closed(html))
    parser.close()
    lines, texts = [], []
    for line in parser.lines:
        text = _SPACE.sub(" ", "".join(line.parts)).strip(" ")
        if text:
            lines.append(line)
            texts.append(text)
    if not lines:
        return ""
    sizes = np.array([len(text) for text in texts])
    linked = np.minimum([line.linked for line in lines], sizes)
    skipped = _skipped(parser.elements, lines, sizes, linked)
    usable = np.array([not skipped[line.element] for line in lines], dtype=bool)
    if not usable.any():
        return ""
    if (linked == sizes)[usable].all():
        # A page of links alone has them as its text.
        linked = np.zeros(len(sizes), dtype=int)
    ratios = np.where(usable, (sizes - linked) / (1 + np.array([line.tags for line in lines])), 0.0)
    dense = smoothed(ratios)
    threshold = split_point(dense)
    content = usable & (dense >= threshold)
    # Lines that are dense by themselves, not by their neighbours, choose the regions.
    seeds = content & (ratios >= threshold)
    if not seeds.any():
        seeds = usable & (ratios == ratios[usable].max())
    taken, in_article = _regions(parser.elements, lines, usable, seeds, sizes - 2 * linked)
    if not in_article:
        taken |= content
    listed = _link_lists(parser.elements, lines, sizes, linked, usable, seeds)
    return " ".join(text for text, keep in zip(texts, taken & usable & ~listed) if keep)


def _inherited(elements: list[_Element], own: list[bool]) -> list[bool]:
    """Whether an element or one around it is marked."""
    if not any(own):
        return own
    out: list[bool] = []
    for number, element in enumerate(elements):
        out.append(own[number] or bool(out and out[element.above]))
    return out


def _skipped(elements: list[_Element], lines: list[_Line], sizes: np.ndarray, linked: np.ndarray) -> list[bool]:
    """Whether an element or one around it is skipped."""
    controls = _inherited(elements, [e.control for e in elements])
    in_article = _inherited(elements, [e.tag in _ARTICLES for e in elements])

    def whole(own: np.ndarray) -> list[int]:
        size = [0] * len(elements)
        for line, n in zip(lines, own.tolist()):
            if not controls[line.element]:
                size[line.element] += n
        for number in range(len(elements) - 1, 0, -1):
            size[elements[number].above] += size[number]
        return size

    size = whole(sizes - linked)
    if not size[0]:
        # A page of links alone has them as its text.
        size = whole(sizes)
    # Heads of articles belong to them.
    beside = [e.beside and not (e.tag == "header" and in_article[e.above]) for e in elements]
    names = [e.names - _HEADS if in_article[e.above] else e.names for e in elements]
    covered = _inherited(elements, [a or e.covered for a, e in zip(beside, elements)])
    readers = _inherited(elements, [bool(n & _READERS) for n in names])
    named = _inherited(elements, [bool(n) for n in names])
    articles = [n for n, e in enumerate(elements) if e.tag in _ARTICLES and size[n] and not controls[n]]
    around: set[int] = set()
    if articles:
        at = min(articles, key=lambda n: (covered[n], readers[n], named[n] and 2 * size[n] < size[0], -size[n], n))
        if covered[at] and 2 * size[at] < size[0]:
            # All are teasers in menus and the like.
            at, articles = 0, []
        while at:
            around.add(at)
            at = elements[at].above
    out = [controls[0]]
    for number, element in enumerate(elements[1:], 1):
        own = element.control
        if not own and number not in around and (beside[number] or element.covered or names[number]):
            most = size[0] - 1 if names[number] & _READERS else size[0] / 2
            own = bool(articles) or beside[number] or size[number] <= most
        out.append(out[element.above] or own)
    return out


def _regions(elements: list[_Element], lines: list[_Line], usable: np.ndarray, seeds: np.ndarray, excess: np.ndarray) -> tuple[np.ndarray, bool]:
    """The lines of the regions the seeds lie in, and of all articles with an excess of text outside links over that
    inside; and whether a region is an article."""
    article, container = [0], [0]
    # Lines of usable text in an element.
    held = [0] * len(elements)
    for line, use in zip(lines, usable.tolist()):
        held[line.element] += use
    for number in range(len(elements) - 1, 0, -1):
        held[elements[number].above] += held[number]
    for number, element in enumerate(elements[1:], 1):
        around = article[element.above]
        article.append(around or (number if element.tag in _ARTICLES else 0))
        container.append(number if element.tag in _CONTAINERS else container[element.above])
    written: Counter[int] = Counter()
    for line, use, more in zip(lines, usable.tolist(), excess.tolist()):
        if use and article[line.element]:
            written[article[line.element]] += more
    chosen = {number for number, more in written.items() if more > 0}
    alone: dict[int, list[int]] = {}
    for element in {line.element for line, seed in zip(lines, seeds.tolist()) if seed}:
        if article[element]:
            chosen.add(article[element])
            continue
        region = container[element]
        # A wrapper of one line is not yet a region.
        while held[region] == 1 and region:
            around = container[elements[region].above]
            if elements[around].tag in _PAGE:
                alone.setdefault(around, []).append(region)
                break
            region = around
        else:
            chosen.add(region)
    for around, wrappers in alone.items():
        # Wrapped paragraphs of the page itself; a single one stands for itself.
        chosen.update([around] if len(wrappers) > 1 else wrappers)
    inside: list[bool] = []
    for number, element in enumerate(elements):
        inside.append(number in chosen or bool(inside and inside[element.above]))
    return np.array([inside[line.element] for line in lines]), any(elements[number].tag in _ARTICLES for number in chosen)


def _link_lists(elements: list[_Element], lines: list[_Line], sizes: np.ndarray, linked: np.ndarray, usable: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The lines in blocks that have several links, most of their text in them and no dense line.

    Inside an article, blocks with lists or tables are none of these.
    """
    articles = ("article",) if any(e.tag == "article" for e in elements) else ("main",)
    in_article = _inherited(elements, [e.tag in articles for e in elements])
    in_list = _inherited(elements, [e.tag in _LISTS for e in elements])
    count = [[0, 0, 0, 0] for _ in elements]
    for line, size, link, use, seed in zip(lines, sizes.tolist(), linked.tolist(), usable.tolist(), seeds.tolist()):
        if use:
            own = count[line.element]
            own[0] += size
            own[1] += link
            own[2] += line.links
            own[3] += seed or (in_article[line.element] and in_list[line.element])
    for number in range(len(elements) - 1, 0, -1):
        above = count[elements[number].above]
        for k, n in enumerate(count[number]):
            above[k] += n
    listed = [False]
    for number, element in enumerate(elements[1:], 1):
        size, link, links, dense = count[number]
        listed.append(listed[element.above] or (links > 1 and 2 * link > size and not dense))
    return np.array([listed[line.element] for line in lines])


def _extract(kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(kept)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(kept)], pa.array(texts, pa.string())],
                names=[*batch.schema.names[:kept], "text"],
            )

    return run


def extract(pages: DataFrame, carried: list[str], html_col: str = "html") -> DataFrame:
    """The ``carried`` columns, the main text and its length in code points."""
    rows = pages.select(*carried, F.col(html_col).alias("_html"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    found = rows.mapInArrow(_extract(len(carried)), f"{kinds}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
