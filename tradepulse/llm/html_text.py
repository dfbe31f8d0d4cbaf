"""Main text of HTML pages by text-to-tag ratio."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches

#: Elements that begin and end a block; all others run on within it.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead title tr ul""".split())
#: Elements whose text is no part of an article.
SKIPPED = frozenset("""head title nav header footer aside form button select option textarea input label fieldset script style
noscript template iframe object embed applet svg canvas math audio video map menu dialog datalist""".split())
#: Elements that never have content.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role names that mark what surrounds an article.
MARKS = frozenset("""ad ads advert adverts advertisement advertising adslot adsense banner promo promoted promotion sponsor sponsored
nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside rail widget widgets cookie cookies
consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login form search comment
comments commentlist disqus reply replies respond discussion feedback share sharing social related recommended recommendations
teaser teasers pagination pager toolbar toc complementary contentinfo copyright legal disclaimer skip hidden""".split())
#: An element that closes these of its own kind, as the standard has it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words that make a name tell of a layout or state ("has-sidebar", "comments-open"), and words of labels besides marks.
STATES = frozenset("has have with without no not open opened closed enabled disabled".split())
PLAIN = frozenset("main site page primary secondary top bottom articles posts links bar box the this our and of policy".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SIGMA = 1.0


#: Marks of what readers write: such a block is never part of an article, whatever stands in it.
READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
ARTICLES = ("article", "main")
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "body"))
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))


@dataclass
class Line:
    """A block's text, with the tags before it, its letters in links, and where it stands."""

    text: str
    tags: int
    linked: int
    box: int
    mark: int
    heading: bool

    @property
    def size(self) -> int:
        return max(0, len(self.text) - self.linked)


class Page(HTMLParser):
    """Parser events to lines, one a block.

    Containers and marked blocks are numbered as they open and know their parent, so a line keeps
    one number of each, however deep it stands. Number 0 stands for none.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: open elements: tag, whether its text is left out, whether it is a container, and the tags before a mark
        self.stack: list[tuple[str, bool, bool, int | None]] = []
        self.open: Counter[str] = Counter()
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.box = self.mark = self.tags = self.linked = self.off = 0
        self.boxes, self.articles = [0], set()
        #: of marked blocks: the parent, whether readers wrote it, and whether an article stands in it
        self.marks, self.readers, self.holds = [0], [False], [False]

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            heading = any(tag in HEADINGS for tag, *_ in self.stack[-3:])
            self.lines.append(Line(text, self.tags, self.linked, self.box, self.mark, heading))
            self.tags = 0
        self.text, self.linked = [], 0

    def pop(self) -> None:
        tag, off, box, before = self.stack.pop()
        self.open[tag] -= 1
        self.off -= off
        if box:
            self.box = self.boxes[self.box]
        if before is not None:
            self.tags, self.mark = before, self.marks[self.mark]

    def skipped(self, tag: str) -> bool:
        """Whether an element's text is none of an article's: a header in an article is, and a label outside of forms."""
        if tag == "header":
            return not any(self.open[t] for t in ARTICLES)
        return tag in SKIPPED and tag != "form" and (tag != "label" or self.open["form"] > 0)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
            self.close_p()
            if closes := CLOSES.get(tag):
                while self.stack and self.stack[-1][0] in closes:
                    self.pop()
        elif tag == "br":
            self.text.append(" ")
        self.tags += not self.off
        if tag in EMPTY:
            return
        off, before = self.skipped(tag) or self.hidden(tag, attrs), None
        kind = None if off else "form" if tag == "form" else self.marked(tag, attrs)
        if kind and tag not in BLOCKS:
            off = True
        elif kind:
            # whether a block is left out is known when the page is read; its tags count for its own lines
            before, self.tags = self.tags - (not self.off), 0
            self.marks.append(self.mark)
            self.readers.append(self.readers[self.mark] or kind == "readers")
            self.holds.append(False)
            self.mark = len(self.marks) - 1
        box = tag in CONTAINERS
        if box:
            self.boxes.append(self.box)
            self.box = len(self.boxes) - 1
        if tag in ARTICLES and not self.readers[self.mark] and not self.off:
            self.articles.add(self.box)
            around = self.mark
            while around and not self.holds[around]:
                self.holds[around] = True
                around = self.marks[around]
        self.stack.append((tag, off, box, before))
        self.open[tag] += 1
        self.off += off

    def close_p(self) -> None:
        """A block ends an open paragraph, whose open inline elements go with it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == "p":
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in BLOCKS:
                return

    @staticmethod
    def hidden(tag: str, attrs) -> bool:
        if tag in ("html", "body", *ARTICLES):
            return False
        return any(name == "hidden" or name == "aria-hidden" and value == "true"
                   or name == "style" and value and re.search(r"display\s*:\s*none", value) for name, value in attrs)

    @staticmethod
    def marked(tag: str, attrs) -> str | None:
        """``readers`` for a block of comments, ``around`` for one that names what surrounds articles."""
        if tag in ("html", "body", "main"):
            return None
        found = None
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for token in value.split():
                    words = {w.lower() for w in WORD.findall(token)}
                    if not STATES.isdisjoint(words):
                        continue
                    if not READERS.isdisjoint(words):
                        return "readers"
                    if tag != "article" and not MARKS.isdisjoint(words):
                        found = "around"
            elif tag != "article" and name == "aria-label" and value:
                words = {w.lower() for w in WORD.findall(value)}
                if not MARKS.isdisjoint(words) and words <= MARKS | PLAIN:
                    found = "readers" if not READERS.isdisjoint(words) else "around"
        return found

    def kept(self) -> list[Line]:
        """Lines without those of marked blocks and forms.

        A marked block is a wrapper of the page, and stays, if an article stands in it. Where all text of a page
        stands in marked blocks, the one with most unlinked text of its own is taken for a wrapper. How
        much a block holds beside an unmarked text plays no part, and what readers wrote never stays.
        """
        opened = [n == 0 or held and not readers for n, (held, readers) in enumerate(zip(self.holds, self.readers))]

        def survivors() -> list[Line]:
            whole = [True] * len(opened)
            for n in range(1, len(opened)):
                whole[n] = opened[n] and whole[self.marks[n]]
            return [line for line in self.lines if whole[line.mark]]

        lines = survivors()
        if any(line.size for line in lines):
            return lines
        own = Counter()
        for line in self.lines:
            if not self.readers[line.mark]:
                own[line.mark] += line.size
        n = max(own, key=lambda m: (own[m], -m), default=0)
        while n and own:
            opened[n], n = True, self.marks[n]
        return survivors()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        elif tag == "br":
            self.text.append(" ")
        # an end tag without its start is left out; one that crosses others closes them
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self.pop()
                break
            if tag not in BLOCKS and self.stack[i][0] in BLOCKS:
                break

    def handle_data(self, data):
        if not self.off:
            self.text.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())

    def close(self):
        super().close()
        self.end_line()


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratio, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def region(page: Page, lines: list[Line], content: np.ndarray, strong: np.ndarray) -> list[int]:
    """Numbers of the lines of the content region.

    The innermost article or main element that holds all content lines is the region, with all its lines. Without
    one it is what stands in the innermost container of all of them, less the branches at both ends, such as menus
    and footers in containers of their own, that hold no strong line, and less linked lines there; headings right before it
    belong to it.
    """
    held = [0] * len(page.boxes)
    for line, keep in zip(lines, content):
        held[line.box] += bool(keep)
    total = int(content.sum())
    for n in range(len(held) - 1, 0, -1):
        held[page.boxes[n]] += held[n]
    around = [n for n in range(len(held)) if held[n] == total]
    best = max((n for n in around if n in page.articles), default=None)
    article = best is not None
    best = max(around) if best is None else best
    # the branch of the region's container that each box stands in, -1 outside
    branch = [-1] * len(held)
    branch[best] = best
    for n in range(best + 1, len(held)):
        up = page.boxes[n]
        branch[n] = n if up == best else branch[up]
    inside = [i for i, line in enumerate(lines) if branch[line.box] >= 0]
    if article:
        return inside
    solid = {branch[lines[i].box] for i in inside if strong[i]} - {best}
    own = [i for i in inside if (lines[i].size > 0 if branch[lines[i].box] == best else branch[lines[i].box] in solid)]
    first, last = own[0], own[-1]
    while first and lines[first - 1].heading:
        first -= 1
    return list(range(first, own[0])) + [i for i in inside if own[0] <= i <= last]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, one a line; empty if there is none.

    Each block outside menus, marked blocks and the like (``Page.kept``) is a line with a ratio of unlinked
    text to tags. Lines whose smoothed ratio is above the threshold are the content cluster; ``region`` tells
    which lines around them belong to the article, short ones and headings too.
    """
    page = Page()
    page.feed(html or "")
    if page.rawdata.startswith("<!--"):  # a comment without an end goes on to the page's end
        page.rawdata = ""
    page.close()
    lines = page.kept()
    if not lines:
        return ""
    size = np.array([line.size for line in lines], float)
    raw = size / np.maximum(1, [line.tags for line in lines])
    ratio = smoothed(raw)
    threshold = ratio.mean() * 0.5
    content = (ratio >= threshold) & (size > 0)
    # a strong line is above the threshold by itself, not by its neighbours
    strong = content & (raw >= threshold)
    if not strong.any():
        strong = size >= size.max()
    return "\n".join(lines[i].text for i in region(page, lines, strong, strong))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """``(id, carried columns, text)`` per row.

    Null html counts as empty, and an empty page has an empty text. Rows that repeat, or whose id is null, are rows
    like others; other columns are ignored; an empty table gives an empty result. Pages of any length are
    read whole, in memory that grows with the page and not with its depth.
    """
    columns = [id_col, *carry, html_col]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(len(columns) - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*columns[:-1], "text"])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns[:-1])
    return pages.select(*[F.col(c) for c in columns]).mapInArrow(run, f"{kinds}, text string")
