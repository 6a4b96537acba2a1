"""Main text of web pages by text-to-tag ratios.

The standard library's parser turns a page into events. Block elements cut the stream into lines (the blocks
of the page); each has a text-to-tag ratio. The ratios, smoothed with a Gaussian, are clustered by a threshold,
and the clusters above it select content regions: all articles with selected text if together they hold most of it,
else the element that holds nearly all of it, along with every cluster outside. All blocks of a region count, short
ones too, but for those inside elements that never hold article text (menus, forms, scripts, the page's own header, ...) or
whose class, id or role names nothing but boilerplate. Names that may mean something else as well (side, notice, search, ...)
leave out, inside an article, only what the ratios do not select.

Null or empty html, and pages without text, give an empty string; markup errors are read as browsers do, more or
less (unclosed elements end with their parents). Repeated rows are extracted each for itself, an empty table gives
no rows, columns other than those named are not read. Nothing is cut from long pages: events stream, only the
blocks and the tree of elements are held, and time follows the length of the page, however deep it nests.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

#: Element names by their role.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title nav header footer aside form button select textarea input dialog menu audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
RAW = frozenset("script style".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
#: Words by which class, id or role say what a part is. A name counts if all its words are among these, AROUND included.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promoted nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar "
    "comment comments commentlist disqus replies respond cookie cookies consent gdpr newsletter newsletters subscribe subscription signup share sharing related recommended recommendations pagination pager "
    "toolbar widget widgets complementary contentinfo".split()
)
#: Words that name boilerplate around an article, but maybe its matter inside one.
AMBIGUOUS = frozenset("side header banner notice notices notification popup modal social skip search login alert reply".split())
#: Words that only say where or how large a part is.
AROUND = frozenset(
    "site page post posts article articles entry blog main primary secondary global top bottom left right inner outer upper lower bar box block container wrapper wrap area section region zone slot unit row col column panel "
    "list item items link links button buttons icon icons body content form thread title text group holder desktop mobile sticky fixed js the of us for".split()
)
_PARTS = re.compile(r"[^\W\d_]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
PLAIN, MAYBE, SURE = 0, 1, 2


def said(name: str) -> int:
    """Whether one name says boilerplate for SURE, MAYBE or not."""
    words = [w.lower() for w in _PARTS.findall(_HUMP.sub(" ", name))]
    if not all(w in BOILERPLATE or w in AMBIGUOUS or w in AROUND or w == "x" for w in words):
        return PLAIN
    return SURE if not BOILERPLATE.isdisjoint(words) else MAYBE if not AMBIGUOUS.isdisjoint(words) else PLAIN


SIGMA = 1.5
_SPACE = re.compile(r"\s+")


class _Events(HTMLParser):
    """The elements of a page (parent, name, role) and its blocks in page order: (text, tags in it, element around, skipped?). Elements are numbered as they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, bool]] = []
        self.stack: list[int] = []
        self.parent: list[int] = []
        self.name: list[str] = []
        self.skip: list[bool] = []
        self.role: list[int] = []
        self.within: list[bool] = []  # in an article or main, or one itself
        self.places: dict[str, list[int]] = {}  # name -> places on the stack
        self.text: list[str] = []
        self.muted: list[int] = []  # hidden inline elements that are open
        self.tags = 0

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip() if self.text else ""
        self.text = []
        if text:
            e = self.stack[-1] if self.stack else -1
            self.blocks.append((text, self.tags, e, e >= 0 and self.skip[e]))
            self.tags = 0

    def pop_to(self, name: str, stop: frozenset[str] = frozenset()) -> None:
        """Close the innermost element of that name, and all inside it; not across the elements in stop."""
        at = self.places.get(name)
        if not at or any(w[-1] > at[-1] for w in map(self.places.get, stop) if w):
            return
        i = at[-1]
        if any(self.name[e] not in INLINE for e in self.stack[i:]):
            self.cut()
        for e in reversed(self.stack[i:]):
            self.places[self.name[e]].pop()
            if self.muted and self.muted[-1] == e:
                self.muted.pop()
        del self.stack[i:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            if tag in VOID:
                return
        else:
            if tag in CLOSES_P:
                self.pop_to("p", frozenset(("td", "th", "li", "div", "section", "article")))
            if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                self.pop_to(tag, frozenset(("ul", "ol", "table", "dl", "select")))
            if tag == "body":
                self.pop_to("head")
            self.cut()
            if tag in VOID:
                return
        up = self.stack[-1] if self.stack else -1
        within = up >= 0 and self.within[up]
        skip = up >= 0 and self.skip[up] or tag in SKIPPED and not (tag == "header" and within)
        role, hidden = PLAIN, False
        for k, v in attrs:
            if k == "hidden" or v and k == "style" and "display:none" in v.replace(" ", "").lower():
                hidden = True
            elif k == "aria-hidden" and v == "true" and tag not in INLINE:
                hidden = True
            elif v and k in ("class", "id", "role"):
                role = max(role, *map(said, v.split()), PLAIN)
            elif v and k == "aria-label":
                role = max(role, said(v))
        e = len(self.parent)
        if tag in INLINE:
            role = PLAIN  # inline parts of a block stay with it, unless they are not shown
            if hidden:
                self.muted.append(e)
        elif tag in ("html", "body"):
            role = PLAIN
        else:
            skip = skip or hidden
        main = tag in MAIN and role == PLAIN
        self.stack.append(e)
        self.parent.append(up)
        self.name.append(tag)
        self.skip.append(skip)
        self.role.append(role)
        self.within.append(within or main and not skip)
        self.places.setdefault(tag, []).append(len(self.stack) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        self.pop_to(tag, frozenset() if tag not in ("b", "i", "em", "strong", "a", "span") else frozenset(("p", "li", "td", "div", "article")))

    def handle_data(self, data: str) -> None:
        if not self.muted and not (self.stack and self.name[self.stack[-1]] in RAW):
            self.text.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no section the parser knows: a comment up to the next >, as in browsers
            return self.parse_bogus_comment(i)

    def finish(self) -> list[tuple[str, int, int, bool]]:
        self.close()
        self.cut()
        return self.blocks

    def upwards(self, own: list) -> list:
        """Sums (or ors) of the values of each element and all inside it."""
        out = list(own)
        for e in range(len(out) - 1, -1, -1):
            if self.parent[e] >= 0:
                out[self.parent[e]] += out[e]
        return out

    def downwards(self, own: list[bool]) -> list[bool]:
        """Whether it holds for the element or any around it."""
        out = list(own)
        for e, up in enumerate(self.parent):
            out[e] = out[e] or up >= 0 and out[up]
        return out


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with weights renormalised at the ends."""
    r = max(1, math.ceil(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(ratios, k)[r:-r] / np.convolve(np.ones_like(ratios), k)[r:-r]


def _selected(blocks: list[tuple[str, int, int, bool]], alone: list[bool] | None = None) -> list[int]:
    """Places of the blocks whose smoothed ratio is above the threshold, and their own as well where they stand alone; all that are not skipped if none is."""
    alone = alone or [False] * len(blocks)
    ratio = np.array([len(t) / max(1, tags) for t, tags, _, _ in blocks])
    ratio[[b[3] for b in blocks]] = 0.0
    even = smooth(ratio)
    threshold = float(np.std(even)) if len(blocks) > 2 else 0.0
    return [i for i, b in enumerate(blocks) if not b[3] and even[i] >= threshold and (not alone[i] or ratio[i] >= threshold)] or [i for i, b in enumerate(blocks) if not b[3]]


def _weights(p: _Events, blocks: list[tuple[str, int, int, bool]], chosen: list[int]) -> list[int]:
    """Length of the chosen text in each element."""
    own = [0] * len(p.parent)
    for i in chosen:
        if blocks[i][2] >= 0:
            own[blocks[i][2]] += len(blocks[i][0])
    return p.upwards(own)


def _left_out(p: _Events, blocks: list[tuple[str, int, int, bool]]) -> tuple[list[bool], list[bool]]:
    """(elements that names leave out, elements that names leave out where the ratios agree)."""
    n = len(p.parent)
    named = p.downwards([r != PLAIN for r in p.role])
    mains = [p.name[e] in MAIN and p.role[e] == PLAIN and not p.skip[e] for e in range(n)]
    # What lies around the only articles is no boilerplate, whatever it is called; comments may be articles beside the article.
    free = any(m and not named[e] for e, m in enumerate(mains))
    around = p.upwards([int(m and (not free or not named[e])) for e, m in enumerate(mains)])
    role = [PLAIN if around[e] else r for e, r in enumerate(p.role)]
    if not any(mains) and any(role):
        chosen = _selected(blocks)
        held, total = _weights(p, blocks, chosen), sum(len(blocks[i][0]) for i in chosen)
        role = [PLAIN if r and 2 * held[e] > total else r for e, r in enumerate(role)]
    sure = p.downwards([r == SURE or r == MAYBE and not p.within[e] for e, r in enumerate(role)])
    return sure, p.downwards([r == MAYBE for r in role])


def main_blocks(html: str) -> list[str]:
    """Blocks of the main text, in page order."""
    p = _Events()
    p.feed(html)
    blocks = p.finish()
    if not blocks:
        return []
    sure, maybe = _left_out(p, blocks)
    if any(not b[3] and not (b[2] >= 0 and sure[b[2]]) for b in blocks):
        blocks = [(*b[:3], b[3] or b[2] >= 0 and sure[b[2]]) for b in blocks]
    chosen = _selected(blocks, [b[2] >= 0 and maybe[b[2]] for b in blocks])
    if not chosen:
        return []
    # The region: the articles, if they hold most of the selected text; else the innermost element that holds nearly all of it, and all selected blocks outside.
    weight, total = _weights(p, blocks, chosen), sum(len(blocks[i][0]) for i in chosen)
    outermost = [-1] * len(p.parent)
    for e, up in enumerate(p.parent):
        outermost[e] = outermost[up] if up >= 0 and outermost[up] >= 0 else e if p.name[e] in MAIN else -1
    mains = {outermost[blocks[i][2]] for i in chosen if blocks[i][2] >= 0} - {-1}
    regions, selected = mains, set(chosen)
    loose = False
    if 2 * sum(weight[e] for e in mains) <= total:
        loose = True
        inside = [e for e, w in enumerate(weight) if w >= 0.8 * total]
        regions = set(inside[-1:])
        if regions and p.name[inside[-1]] in HEADINGS | {"p", "li", "td"} and len(inside) > 1:
            regions = {inside[-2]}
    within = p.downwards([e in regions for e in range(len(p.parent))])

    def stays(i: int, b: tuple[str, int, int, bool]) -> bool:
        if b[3] or b[2] >= 0 and maybe[b[2]] and i not in selected:
            return False
        return not regions or loose and i in selected or b[2] >= 0 and within[b[2]]

    return [b[0] for i, b in enumerate(blocks) if stays(i, b)]


def extract_text(html: str | None) -> str:
    return "\n".join(main_blocks(html)) if html else ""


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The kept columns, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, html_col):
            texts = [extract_text(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    return pages.select(*keep, html_col).mapInArrow(run, f"{schema}, text string, n_chars long")
