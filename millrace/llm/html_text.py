"""Operator 10: the main text of web pages by tag-path ratios.

A page is read once into text nodes, each with its path of open tags, in blocks.  What is no
article text by its kind (menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments, hidden elements) is left out first.  For the rest,

* each path has two ratios: characters, and punctuation marks, for each of its text nodes;
* both are smoothed along the page with a Gaussian weight and fused into one by their product;
* nodes above a threshold, one standard deviation of the page's values, are content, and so are the blocks of
  text that hold one.

What is short stands on paths of low ratios even where it is content, so other blocks are rescued by where they
are: between content blocks, beside them in the same element, as items of a list there too, or headings right before the first. Where
article-like elements hold most of the content, these are the article, whole if they are nested or side by
side, and the other blocks in them are rescued too.  Runs of blocks that are little but links are not
rescued: a list of links in the article stays out by its paths.

Cases: null and empty pages, and pages without text, give an empty string; a page that ends in
the middle of a tag, a comment or a script is read up to there; repeated rows are read each
for itself; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements that hold no article text.
OUTSIDE = RAW | frozenset(
    "aside audio button canvas datalist dialog embed footer form head input map menu nav object option select svg "
    "template video".split()
)
#: Words of a class, id or role that mark an element as no article text.
MARKS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion recommended related replies respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
#: Words that may stand beside a mark; any other word says that the element is about something else.
BESIDE = frozenset(
    "area articles bar block bottom box buttons container content count foot form global group holder home inner item "
    "items left links list main module outer page panel policy post posts reader readers right row section site slot top "
    "unit user users wrap wrapper".split()
)
#: Words that, beside "header", mark the head of the article itself.
OWN_HEAD = frozenset("article content entry post story".split())
#: Elements that a start tag of the same row ends, up to the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Lists and their items.
LISTED = frozenset("ul ol dl li dt dd".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: A value without quotes at the end of a tag, which a slash is part of.
UNQUOTED = re.compile(r"""=\s*[^\s"'=<>]*/$""")
PUNCTUATION = re.compile(r"[.,;:!?…·。，、；：！？¿¡]")

SMOOTH = (0.25, 1.0, 0.25)
#: Standard deviations from which on a node is content.
THRESHOLD = 1.0
#: Share of the content's characters from which on article-like elements are the article.
MOST = 0.5
#: Share of characters in links from which on a block is little but links, and how many in a row are a list.
LINKS = 0.8
RUN = 2


class _Page:
    """Open elements, and text nodes as (element, block, text).

    What an element has from those around it is noted with it, and how many of each tag are open, so that
    no tag looks through all that are.
    """

    def __init__(self):
        self.parent, self.tag, self.outside, self.path = [-1], ["#"], [False], [0]
        self.article, self.link = [False], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.stack = [0]
        self.opened: Counter = Counter()
        self.block = 0
        self.nodes: list[tuple[int, int, str]] = []

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._end_paragraph()
            self.block += 1
        if tag in CLOSES and any(self.opened[name] for name in CLOSES[tag][0]):
            names, within = CLOSES[tag]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.tag[self.stack[k]] in within:
                    break
                if self.tag[self.stack[k]] in names:
                    self._drop(k)
                    break
        above = self.stack[-1]
        key = (self.path[above], tag)
        self.parent.append(above)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault(key, len(self.paths) + 1))
        self.article.append(self.article[above] or tag in ARTICLE)
        self.link.append(self.link[above] or tag == "a")
        self.outside.append(self.outside[above] or self._outside(tag, attributes, self.article[-1]))
        self.stack.append(len(self.tag) - 1)
        self.opened[tag] += 1

    def _drop(self, k: int) -> None:
        """End the open elements from the ``k``-th on."""
        for element in self.stack[k:]:
            self.opened[self.tag[element]] -= 1
        del self.stack[k:]

    def _end_paragraph(self) -> None:
        if not self.opened["p"]:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[k]]
            if name == "p":
                self._drop(k)
                return
            if name in BLOCK:
                return

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        if not self.opened[tag]:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[k]] == tag:
                self._drop(k)
                return
            if tag not in BLOCK and self.tag[self.stack[k]] in BLOCK:
                return

    def _outside(self, tag: str, attributes: str, inside: bool) -> bool:
        if tag in OUTSIDE:
            return True
        if tag == "header" and not inside:
            return True
        if not attributes or tag in ARTICLE or tag in ("html", "body") or tag in HEADINGS and inside:
            return False
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            if name == "role" and value in ("navigation", "banner", "complementary", "contentinfo", "search", "form"):
                return True
            if name in ("class", "id"):
                for item in value.split():
                    words = {w for w in re.split(r"[^a-z]+", item) if w}
                    if words & MARKS and words <= MARKS | BESIDE:
                        return True
                    if "header" in words and not words & OWN_HEAD and not inside:
                        return True
        return False

    def text(self, raw: str) -> None:
        above = self.stack[-1]
        if not self.outside[above]:
            self.nodes.append((above, self.block, raw))


def _read(page: str) -> _Page:
    found, place, held = _Page(), 0, []
    end = len(page)
    while place < end:
        match = TOKEN.search(page, place)
        if match is None:
            held.append(page[place:])
            break
        held.append(page[place : match.start()])
        place = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if held and (raw := "".join(held)):
            found.text(raw)
        held = []
        if match[1] or match[4]:
            found.close(tag)
        elif tag in VOID:
            if tag in BLOCK:
                found.block += 1
            elif tag in ("br", "wbr"):
                found.text(" " if tag == "br" else "")
        else:
            attributes = match[3] or match[6] or ""
            found.open(tag, attributes)
            if tag in RAW:
                last = re.compile(rf"</{tag}\b", re.I).search(page, place)
                place = last.start() if last else end
            elif attributes.endswith("/") and tag not in BLOCK and not UNQUOTED.search(attributes):
                found.close(tag)
    if held and (raw := "".join(held)):
        found.text(raw)
    return found


@dataclass
class _Block:
    """A block of text: its nodes' texts, characters, those in links, whether a node is content, and its elements."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    linked: int = 0
    content: bool = False
    element: int = 0

    @property
    def links(self) -> bool:
        return not self.content and self.linked >= LINKS * self.size


def main_text(page: str | None) -> str:
    """The article's blocks, one on each line."""
    if not page:
        return ""
    found = _read(page)
    nodes = [(e, b, html.unescape(t)) for e, b, t in found.nodes]
    lines = (" ".join("".join(block.parts).split()) for block in _article(found, nodes))
    return "\n".join(line for line in lines if line)


def _blocks(found: _Page, nodes: list) -> list[_Block]:
    """The blocks with text in page order."""
    solid = [(e, t) for e, _, t in nodes if t.strip()]
    content = iter(_fused(found, solid))
    blocks: dict[int, _Block] = {}
    for element, number, text in nodes:
        block = blocks.setdefault(number, _Block())
        block.parts.append(text)
        if text.strip():
            size = len(text.strip())
            block.size += size
            block.linked += size * found.link[element]
            block.content |= next(content)
            block.element = block.element or element
    return [b for b in blocks.values() if b.size]


def _article(found: _Page, nodes: list) -> list[_Block]:
    """The blocks that are the article's."""
    blocks = _blocks(found, nodes)
    if not any(b.content for b in blocks):
        return blocks
    lists = _lists(blocks)
    inside = [found.article[b.element] for b in blocks]
    weight = sum(b.size for b in blocks if b.content)
    if sum(b.size for b, own in zip(blocks, inside) if b.content and own) >= MOST * weight:
        tops = [_top(found, b.element) if own else -1 for b, own in zip(blocks, inside)]
        with_content = {top for b, top in zip(blocks, tops) if b.content}
        return [b for b, top, skip in zip(blocks, tops, lists) if top >= 0 and top in with_content and (b.content or not skip)]
    places = [k for k, b in enumerate(blocks) if b.content]
    first, last = places[0], places[-1]
    while first and _home(found, blocks[first - 1].element)[0] in HEADINGS:
        first -= 1
    homes = {_home(found, blocks[k].element)[1] for k in places}
    return [
        b for k, b in enumerate(blocks)
        if b.content or not lists[k] and (first <= k <= last or _home(found, b.element)[1] in homes or _around(found, b.element) in homes)
    ]


def _lists(blocks: list[_Block]) -> list[bool]:
    """Whether each block is one of some in a row that are little but links."""
    out, k = [False] * len(blocks), 0
    while k < len(blocks):
        end = k
        while end < len(blocks) and blocks[end].links:
            end += 1
        if end - k >= RUN:
            out[k:end] = [True] * (end - k)
        k = max(end, k + 1)
    return out


def _top(found: _Page, element: int) -> int:
    """The outermost article-like element around an element."""
    top = -1
    while element > 0 and found.article[element]:
        if found.tag[element] in ARTICLE:
            top = element
        element = found.parent[element]
    return top


def _home(found: _Page, element: int) -> tuple[str, int]:
    """The tag of the block element that an element is or lies in, and the element around that."""
    while element > 0 and found.tag[element] not in BLOCK:
        element = found.parent[element]
    return found.tag[element], found.parent[element]


def _around(found: _Page, element: int) -> int:
    """The element around the block element that an element is or lies in; of an item, the one around its lists."""
    around = _home(found, element)[1]
    while around > 0 and found.tag[around] in LISTED:
        around = found.parent[around]
    return around


def _fused(found: _Page, solid: list) -> list[bool]:
    """Whether each text node is content, by the fused ratios of its path.

    Neighbours lift a short node, but not one in a link above what its own path has.
    """
    size: dict[int, int] = {}
    marks: dict[int, int] = {}
    count: dict[int, int] = {}
    for element, text in solid:
        path = found.path[element]
        size[path] = size.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
        count[path] = count.get(path, 0) + 1
    paths = [found.path[e] for e, _ in solid]
    characters = _smooth([size[p] / count[p] for p in paths])
    punctuation = _smooth([marks[p] / count[p] for p in paths])
    fused = [c * (1 + p) for c, p in zip(characters, punctuation)]
    for k, ((element, _), path) in enumerate(zip(solid, paths)):
        if found.link[element]:
            fused[k] = min(fused[k], size[path] / count[path] * (1 + marks[path] / count[path]))
    if not fused:
        return []
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    return [x >= THRESHOLD * spread for x in fused]


def _smooth(values: list[float]) -> list[float]:
    side, middle = SMOOTH[0], SMOOTH[1]
    out = []
    for k, value in enumerate(values):
        near = values[max(0, k - 1) : k] + values[k + 1 : k + 2]
        out.append((middle * value + side * sum(near)) / (middle + side * len(near)))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page."""

    def read(batches):
        for batch in batches:
            found = [main_text(page) for page in batch["html"].to_pylist()]
            columns = [batch["page_id"], batch["url"], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
