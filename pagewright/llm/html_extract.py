"""HTML extraction by minimum-cut labelling of text blocks.

A page becomes a sequence of blocks, runs of text between block-level tags, and of regions, the elements that a
mark (tag, role, class name) governs. A linear classifier gives every node its log-odds of being content: a block by
its length, punctuation and share of link text, a region by its mark, once for each block in it. The costs that the
log-odds imply are the nodes' terminal capacities. Smoothness edges join each block to its region, to the next block,
the weaker the more tree steps lie between them, and to the next block under one parent. The minimum cut between
content and boilerplate labels the nodes: a sentence in a comment is content by itself and goes by its region, a
one-word line of an article the other way round.

Defined results: null or empty html, and a page whose blocks are all boilerplate, give the empty text.
Nothing is cut or capped: a block is kept whole or not at all. Broken markup (open comments, quotes,
elements) is read as far as it goes; ``<`` before a letter starts a tag, as in a browser, so that ``a <b and c> d``
loses ``b and c``. Character references are decoded within a run of text, not across tags. Repeated rows and null ids
keep a row each. Columns beyond page_id, url and html are ignored. An empty table gives an empty result. Time and
memory grow with the length of a page, however deep its elements are nested.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import map_batches, slices

#: Elements whose content is never text of the page.
SILENT = "script|style|textarea|title|noscript|template|svg|math|iframe|object|canvas|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{SILENT})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Open elements that an opening tag closes, unless one of ``WALLS`` was opened behind them.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
WALLS = frozenset("ul ol dl table select div article section menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PHRASING_ONLY = HEADINGS | {"p"}

ASIDE_TAGS = frozenset("nav footer aside form button select menu dialog label fieldset option optgroup search legend".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist note".split())
#: Parts of class names and ids that mark boilerplate.
ASIDE_NAMES = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo promos promotion promoted banner banners cookie cookies consent gdpr privacy notice notices notification newsletter subscribe subscription signup sidebar sidebars rail related recommended recommendations trending popular menu menus submenu nav navbar navigation navi breadcrumb breadcrumbs footer foot masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion share sharing social follow popup modal overlay lightbox login register search searchbox widget widgets pagination pager paging copyright legal disclaimer alert skip tagcloud outbrain taboola paywall feedback survey".split()
)
TEXT_NAMES = frozenset("article articlebody post entry content story main maincontent body text prose".split())

#: Log-odds that a mark adds for each block it governs, the edge from a block to its region, and that to the next block.
MARK, GOVERNED, SMOOTH = 4.0, 5.0, 1.5
#: Log-odds of blocks that no mark governs: on a page without any article, and beside one.
BARE, OUTSIDE = 1.0, -3.0
NOTICE = re.compile(r"©|all rights reserved|cookies?\b|subscribe|sign (?:in|up)|log ?in\b", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
ASIDE, TEXT = -1, 1


def marks_of(tag: str, attrs: str) -> tuple[bool, bool, bool, bool]:
    """Whether an element is marked as boilerplate, as an article, as a header, and as invisible."""
    aside, text, header, drop = tag in ASIDE_TAGS, tag in ("article", "main"), tag == "header", tag == "head"
    if not attrs or tag in ("html", "body"):
        return aside, text, header, drop
    names: set[str] = set()
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        key, own = key.lower(), a or b or c
        value = own.lower()
        if key in ("class", "id"):
            names.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", own).lower()))
        elif key == "role":
            aside, text = aside or value in ASIDE_ROLES, text or value in ("main", "article")
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and HIDDEN.search(value)):
            drop = True
    return aside or not names.isdisjoint(ASIDE_NAMES), text or not names.isdisjoint(TEXT_NAMES), header or "header" in names, drop


class Block:
    __slots__ = ("element", "links", "region", "tag", "text")

    def __init__(self, text: str, links: int, element: int, region: int, tag: str) -> None:
        self.text, self.links, self.element, self.region, self.tag = text, links, element, region, tag

    def score(self, side: int) -> float:
        """Log-odds of content by the block's own text; ``side`` is that of its region, 0 for none."""
        words = self.text.count(" ") + 1
        s = min(words, 40) / 20 - 0.5
        if self.text[-1] in ".!?…:;\"'”»)":
            s += 0.7
        s -= min(1.0, self.links / len(self.text)) * (2.5 if side == TEXT else 4.0)
        if self.tag in HEADINGS:
            s += 1.0
        if side != TEXT and words < 25 and NOTICE.search(self.text):
            s -= 3.0
        return s


class Page:
    """The blocks of a page, the side of each region, and of each element its parent and its depth."""

    def __init__(self, html: str) -> None:
        self.blocks: list[Block] = []
        self.sides: list[int] = []
        self.parent, self.depth, self.tags = [-1], [0], [""]
        self.regions, self.dropped = [-1], [False]
        self.stack, self.open_at, self.walls = [0], {}, [0]
        self._read(html)

    def _push(self, tag: str, region: int, drop: bool) -> None:
        above = self.stack[-1]
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.tags.append(tag)
        self.regions.append(region)
        self.dropped.append(drop)
        self.open_at.setdefault(tag, []).append(len(self.stack))
        if tag in WALLS:
            self.walls.append(len(self.stack))
        self.stack.append(len(self.parent) - 1)

    def _close(self, k: int) -> None:
        """Close the elements from place ``k`` of the stack on."""
        while len(self.stack) > k:
            tag = self.tags[self.stack.pop()]
            self.open_at[tag].pop()
            if tag in WALLS:
                self.walls.pop()

    def _governed(self, marks: tuple[bool, bool, bool, bool]) -> tuple[int, int]:
        """(region, or -2 for a new one; its side) of an element with these marks.

        Boilerplate holds whatever it contains; a header is one unless it stands in an article.
        """
        aside, text, header, _ = marks
        region = self.regions[self.stack[-1]]
        side = self.sides[region] if region >= 0 else 0
        if side != ASIDE and (aside or (header and side != TEXT)):
            return -2, ASIDE
        return (-2, TEXT) if text and not side else (region, side)

    def _read(self, html: str) -> None:
        stack, open_at = self.stack, self.open_at
        pieces: list[str] = []
        link_pieces: list[str] = []
        link_depth = 0
        nested: dict[str, int] = {}  # open inline elements that are no node, inside a node of the same tag

        def flush() -> None:
            if pieces:
                text, at = " ".join("".join(pieces).split()), stack[-1]
                if text and not self.dropped[at]:
                    links = len(" ".join("".join(link_pieces).split()))
                    self.blocks.append(Block(text, links, at, self.regions[at], self.tags[at]))
                pieces.clear()
                link_pieces.clear()

        def said(a: int, b: int) -> None:
            if b > a:
                piece = html[a:b]
                if "&" in piece:
                    piece = unescape(piece)
                pieces.append(piece)
                if link_depth:
                    link_pieces.append(piece)

        at = 0
        for m in TOKEN.finditer(html):
            said(at, m.start())
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag, attrs = tag.lower(), m["attrs"]
            if m["end"]:
                if tag == "a":
                    link_depth = 0
                elif nested.get(tag):
                    nested[tag] -= 1
                elif places := open_at.get(tag):
                    flush()
                    self._close(places[-1])
                    link_depth = min(link_depth, len(stack))
                elif tag == "p":
                    flush()
                continue
            if tag == "a":
                link_depth = len(stack)
            is_block = tag in BLOCK
            if tag in VOID:
                if tag == "br":
                    pieces.append(" ")
                elif is_block:
                    flush()
                continue
            if is_block:
                flush()
                if self.tags[stack[-1]] in PHRASING_ONLY:
                    self._close(len(stack) - 1)
                elif tag in CLOSES and (found := [open_at[x][-1] for x in CLOSES[tag] if open_at.get(x) and open_at[x][-1] > self.walls[-1]]):
                    self._close(min(found))
            elif not attrs or tag == "a":
                if open_at.get(tag):
                    nested[tag] = nested.get(tag, 0) + 1
                continue
            marks = marks_of(tag, attrs)
            region, side = self._governed(marks)
            drop = self.dropped[stack[-1]] or marks[3]
            if not is_block:
                if drop == self.dropped[stack[-1]] and not (region == -2 and side == ASIDE):
                    if open_at.get(tag):
                        nested[tag] = nested.get(tag, 0) + 1
                    continue  # an inline element that changes nothing
                flush()
                nested[tag] = 0
            if region == -2:
                self.sides.append(side)
                region = len(self.sides) - 1
            self._push(tag, region, drop)
        said(at, len(html))
        flush()

    def steps(self, a: int, b: int) -> int:
        """Tree steps between two elements."""
        n = 0
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a, n = self.parent[a], n + 1
        return n


def edges_of(page: Page) -> list[tuple[int, int, float]]:
    """Smoothness edges between blocks, numbered as they come, and regions, numbered behind all blocks."""
    edges, last, n = [], {}, len(page.blocks)
    for i, b in enumerate(page.blocks):
        if b.region >= 0:
            edges.append((i, n + b.region, GOVERNED))
        if i:
            edges.append((i - 1, i, SMOOTH / (1 + page.steps(page.blocks[i - 1].element, b.element))))
        parent = page.parent[b.element]
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SMOOTH / 3))
        last[parent] = i
    return edges


def scores_of(page: Page) -> list[float]:
    """Log-odds of blocks, then of regions.

    Blocks without a region are likely content of a page without an article element or the like, unlikely beside one
    that holds a good part of the text.
    """
    sides = [page.sides[b.region] if b.region >= 0 else 0 for b in page.blocks]
    inside, outside = (sum(len(b.text) for b, s in zip(page.blocks, sides, strict=True) if s == side) for side in (TEXT, 0))
    bare = BARE if not inside else OUTSIDE if 4 * inside >= outside else 0.0
    held = [0] * len(page.sides)
    for b in page.blocks:
        if b.region >= 0:
            held[b.region] += 1
    return [b.score(s) + (0.0 if s else bare) for b, s in zip(page.blocks, sides, strict=True)] + [MARK * s * n for s, n in zip(page.sides, held, strict=True)]


#: Rounds in which nodes are settled before the rest is solved by flow.
SWEEPS = 4


def minimum_cut(content: list[float], boilerplate: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of least total cost; ``content`` and ``boilerplate`` are the costs of each label.

    What reaches a node through an edge is at most the edge's capacity, and at most what its neighbour has from its
    own terminal and its other edges. A node whose own preference outweighs all that keeps it in every minimum cut:
    such nodes are settled first, in a few rounds, and pull at their neighbours as terminals do. The rest is solved
    by blocking flows. Of equal cuts, that with least content.
    """
    n = len(content)
    lean = [b - c for c, b in zip(content, boilerplate, strict=True)]
    around: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i, j, w in edges:
        around[i].append((j, w))
        around[j].append((i, w))
    label: list[bool | None] = [None] * n
    pull = [sum(w for _, w in a) for a in around]
    for _ in range(SWEEPS):
        settled = False
        for i in range(n):
            if label[i] is not None:
                continue
            side = 1 if lean[i] > 0 else -1
            against = 0.0
            for j, w in around[i]:
                if label[j] is None:
                    against += min(w, max(0.0, -side * lean[j]) + pull[j] - w)
            if abs(lean[i]) > against + 1e-9:
                label[i], settled = lean[i] > 0, True
                for j, w in around[i]:
                    if label[j] is None:
                        lean[j] += w * side
                        pull[j] -= w
        if not settled:
            break
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        inside = content_side([lean[i] for i in rest], [(i, j, w) for i, j, w in edges if label[i] is None and label[j] is None], rest)
        label = [(i in inside) if x is None else x for i, x in enumerate(label)]
    return label


def content_side(lean: list[float], edges: list[tuple[int, int, float]], names: list[int]) -> set[int]:
    """The nodes on the source's side of the minimum cut, by blocking flows over shortest paths; the source is content."""
    place = {name: k for k, name in enumerate(names)}
    source, sink = len(names), len(names) + 1
    around: list[list[int]] = [[] for _ in range(len(names) + 2)]
    to: list[int] = []
    left: list[float] = []  # residual capacity; an edge and its reverse differ in the last bit of their number

    def join(a: int, b: int, there: float, back: float) -> None:
        around[a].append(len(to))
        around[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((there, back))

    for k, x in enumerate(lean):
        if x > 0:
            join(source, k, x, 0.0)
        elif x < 0:
            join(k, sink, -x, 0.0)
    for i, j, w in edges:
        join(place[i], place[j], w, w)
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for e in around[a]:
                if left[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if sink not in level:
            return {names[k] for k in level if k < len(names)}
        tried, path, a = [0] * len(around), [], source
        while True:
            if a == sink:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if left[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
            while tried[a] < len(around[a]):
                e = around[a][tried[a]]
                if left[e] > 1e-9 and level.get(to[e], -1) == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                tried[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                tried[a] += 1


def labels_of(page: Page) -> list[bool]:
    """Whether each block is content."""
    scores = scores_of(page)
    soft = lambda x: max(x, 0.0) + math.log1p(math.exp(-abs(x)))
    return minimum_cut([soft(-s) for s in scores], [soft(s) for s in scores], edges_of(page))[: len(page.blocks)]


def main_text(html: str | None) -> str:
    page = Page(html or "")
    return " ".join(b.text for b, keep in zip(page.blocks, labels_of(page), strict=True) if keep)


def _extract(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for whole in batches:
        for batch in slices(whole, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_batches(rows, _extract, "page_id bigint, url string, text string, n_chars bigint")
