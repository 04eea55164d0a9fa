"""HTML extraction by minimum cut: which text blocks of a page are its article.

A page is read into blocks of text, each with the elements it stands in. A logistic classifier gives every block
the cost of either label; these are its edges to source and sink. Neighbouring blocks are joined by
edges whose capacity falls with their distance in the page and in the element tree. The minimum cut
labels all blocks together, so a doubtful block follows its neighbours.

The classifier learns from pages that name their parts: blocks in ``article`` or ``main`` are content, blocks
in menus, headers, footers, sidebars, notices, adverts, forms and comments are not. These names only give
training labels; in a page, costs and cut alone decide. Names around an article, and classes of ``html`` and ``body``,
say nothing against it. The features (names of elements, classes and ids, links, length, position) also hold on
pages without such elements. A table whose pages name no content, or nothing else, teaches nothing: its costs come from fixed
weights for the same features (``prior``). Where all labellings cost the same, text is content.

Edge cases: a null, empty or text-free page gives the empty text. Broken markup is read as far as it goes: an open
tag ends with its parent, text outside any element is a block. Nothing is cut or capped; at any depth of nesting the features
of a block's place come from the NEAREST innermost elements around it, and memory grows with the page only. A result
depends on the page alone, so ties, repeated rows and other columns change nothing.
"""

import re
import zlib
from collections import deque
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import struct_array, text_column

# Element names by the role that HTML gives them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img picture source svg path "
    "audio canvas object video math annotation annotation-xml maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
HIDDEN = frozenset("script style template noscript iframe noembed noframes head title svg select option datalist".split())
BOILERPLATE = frozenset("nav header footer aside form button menu dialog fieldset textarea".split())
CONTENT = frozenset(["article", "main"])
ROOTS = frozenset(["html", "body"])
#: An article inside one of these may be a teaser: it is no training label.
DOUBTFUL = frozenset(["nav", "footer", "aside", "menu", "dialog"])
CLOSED_BY = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
IN_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPE = frozenset("article aside body div footer header main nav section table ul ol form".split())
# Words in classes, ids and roles of parts that are not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
    "sidebar side aside widget related recommended recommendations share sharing social cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments reply replies respondents discussion disqus form search pager pagination toolbar copyright legal disclaimer "
    "complementary contentinfo alertdialog skip".split()
)

# A comment, CDATA, a declaration, a tag, or a tag with an open quote.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORD = re.compile(r"[a-z]+")
NAMING = frozenset(["class", "id", "role"])
#: Elements around a block whose names, classes, ids and roles are its features.
NEAREST = 64
FEATURES = 1 << 12


def _hides(name: str, value: str) -> bool:
    """Whether an attribute says that its element is not shown."""
    value = value.strip().lower()
    if name == "hidden":
        return value != "false"
    return (name == "aria-hidden" and value == "true") or (name == "style" and _NO_DISPLAY.search(value) is not None)


class Element:
    """An open element. ``up`` is the one around it, ``block`` the innermost that is no inline element, itself included."""

    __slots__ = ("name", "hides", "number", "own_words", "up", "block", "outer", "depth", "_about")

    def __init__(self, name: str, number: int, up: "Element | None", words: frozenset, hides: bool):
        self.name, self.number, self.up, self.hides, self._about = name, number, up, hides, None
        self.own_words = words if name not in ROOTS else frozenset()
        outer = up.block if up else None
        if name in INLINE:
            self.block, self.outer, self.depth = outer, None, 0
        else:
            self.block, self.outer, self.depth = self, outer, outer.depth + 1 if outer else 1

    def about(self) -> tuple[tuple, frozenset, frozenset]:
        """The names of the elements that are no inline ones, and the words of all, from the outside in; and those of NAMES that
        stand on the innermost article or around it only."""
        if self._about is None:
            near, at = [], self
            while at is not None and len(near) < NEAREST:
                near.append(at)
                at = at.up
            words, around = frozenset(), frozenset()
            for e in reversed(near):
                words = words | e.own_words if e.own_words else words
                if e.name in CONTENT:  # what has been said so far is not about what follows
                    around, words = around | (words & NAMES), words - NAMES
            self._about = tuple(e.name for e in reversed(near) if e.block is e), words, around
        return self._about


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    home: Element | None  # the innermost element around it

    @property
    def about(self) -> tuple[tuple, frozenset, frozenset]:
        return self.home.about() if self.home else ((), frozenset(), frozenset())

    @property
    def words(self) -> frozenset:
        return self.about[1]

    @property
    def block(self) -> Element | None:
        return self.home.block if self.home else None


def steps_apart(a: Element | None, b: Element | None) -> int:
    """Steps in the element tree from one element to the other."""
    steps = 0
    while a is not b:
        if b is None or (a is not None and a.depth >= b.depth):
            a = a.outer
        else:
            b = b.outer
        steps += 1
    return steps


class Page:
    """Reads markup in order into blocks."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.stack: list[Element] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = self.number = 0

    def flush(self) -> None:
        if not self.parts:
            return
        text = "".join(self.parts)
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text:
            self.blocks.append(Block(text, min(self.linked, len(text)), self.stack[-1] if self.stack else None))
        self.parts.clear()
        self.linked = 0

    def take(self, text: str) -> None:
        if text and not self.hidden:
            self.parts.append(text)
            if self.links:
                self.linked += len(text.strip())

    def leave(self, depth: int) -> None:
        while len(self.stack) > depth:
            gone = self.stack.pop()
            self.hidden -= gone.hides
            self.links -= gone.name == "a"

    def open(self, name: str, attributes: str) -> None:
        """Close what the element cannot stand in, then enter it."""
        stack = self.stack
        ends = CLOSED_BY.get(name, ()) if name not in IN_P else (*CLOSED_BY.get(name, ()), "p")
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in ends:
                    self.leave(i)
                    break
                if stack[i].name in SCOPE:
                    break
        words, hides = frozenset(), name in HIDDEN
        if attributes:
            listed = [(n.lower(), a or b or c) for n, a, b, c in _ATTRIBUTE.findall(attributes)]
            words = frozenset(w for n, value in listed if n in NAMING for w in _WORD.findall(value.lower()))
            hides = hides or (_MAY_HIDE.search(attributes) is not None and any(_hides(*x) for x in listed))
        self.number += 1
        stack.append(Element(name, self.number, stack[-1] if stack else None, words, hides))
        self.hidden += hides
        self.links += name == "a"

    def close(self, name: str) -> None:
        """Leave the innermost element of the name; an inline end does not close the parts of a page."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name == name:
                self.leave(i)
                return
            if name in INLINE and self.stack[i].name in SCOPE:
                return


def blocks_of(text: str) -> list[Block]:
    """The visible text blocks of a page in order, white space as one space."""
    page, at, end = Page(), 0, len(text)
    while at < end:
        m = _MARKUP.search(text, at)
        if m is None:
            page.take(text[at:])
            break
        page.take(text[at : m.start()])
        at = m.end()
        closing, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if name is None:
            if m.group().startswith("<![CDATA["):
                page.take(m.group()[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = name.lower()
        if name not in INLINE:
            page.flush()
        elif name == "br":
            page.take(" ")
        if closing:
            page.close(name)
        elif name not in VOID and not (name in INLINE and attributes.endswith("/")):
            page.open(name, attributes)
            if name in RAW:  # no markup inside
                over = re.compile(rf"</{name}\s*>", re.I).search(text, at)
                page.take(text[at : over.start() if over else end])
                page.flush()
                at = over.end() if over else end
                page.leave(len(page.stack) - 1)
    page.flush()
    return page.blocks


def seed(names: tuple, words: frozenset) -> int:
    """A training label. 1: in a part named as content, -1: in one named as something else, 0: neither. The names
    inside the innermost article count; ``words`` has none of those around it."""
    inside = max((i + 1 for i, n in enumerate(names) if n in CONTENT), default=0)
    if words & NAMES or any(n in BOILERPLATE and not (n == "header" and "article" in names[:inside]) for n in names[inside:]):
        return -1
    return 1 if inside and not DOUBTFUL.intersection(names[:inside]) else 0


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


def _place_features(names: tuple, words: frozenset, around: frozenset = frozenset()) -> list[int]:
    """Of the elements a block stands in."""
    said = (*(f"as {w}" for w in sorted(words)), *(f"around {w}" for w in sorted(around)))
    return [_bucket(x) for x in (*(f"in {n}" for n in sorted(set(names))), *said, f"own {names[-1] if names else ''}")]


def _text_features(block: Block, i: int, n: int) -> tuple:
    """Of the text of block i of n."""
    return len(block.text).bit_length(), 4 * block.linked // len(block.text), block.text[-1] in ".!?", 4 * i // n


def _text_buckets(features: tuple) -> list[int]:
    length, links, ends, place = features
    return [_bucket(x) for x in ("bias", f"length {min(10, length)}", f"links {links}", f"ends {ends}", f"place {place}")]


def prior() -> np.ndarray:
    """Weights for pages that teach nothing: long texts with an end and without links are content, headings too; what is named as
    another part is not."""
    weights = np.zeros(FEATURES)
    said = {f"length {bits}": min(2.0, 0.4 * (bits - 5)) for bits in range(11)} | {f"links {quarter}": -0.8 * quarter for quarter in range(5)}
    said |= {"ends True": 1.0, "ends False": -0.4, **{f"own h{i}": 1.5 for i in range(1, 7)}, "own p": 0.5}
    said |= {f"in {name}": -4.0 for name in sorted(BOILERPLATE)} | {f"as {word}": -4.0 for word in sorted(NAMES)}
    for feature, weight in said.items():
        weights[_bucket(feature)] += weight
    return weights


def train(pages: list[str], visits: int = 100_000, seed_: int = 5) -> np.ndarray:
    """Logistic weights from the blocks whose part is named, each class with half the weight; ``prior()`` if there is only
    one class."""
    rows, y = [], []
    for page in pages:
        blocks = blocks_of(page or "")
        for i, b in enumerate(blocks):
            names, words, around = b.about
            s = seed(names, words)
            if s:
                rows.append(_place_features(names, words, around) + _text_buckets(_text_features(b, i, len(blocks))))
                y.append(s)
    if len(set(y)) < 2:
        return prior()
    weights = np.zeros(FEATURES)
    y = np.array(y)
    weight = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    rng, squares = np.random.default_rng(seed_), np.full(FEATURES, 1e-6)
    for _ in range(max(1, min(12, visits // len(rows)))):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            g = -weight[i] * y[i] / (1 + np.exp(y[i] * weights[at].sum()))
            squares[at] += g * g
            weights[at] -= 0.1 * g / np.sqrt(squares[at])
    return weights


def max_flow_side(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of the minimum cut, of several the one with most of them. ``terminal`` is the
    capacity from the source less that to the sink.

    A node whose terminal outweighs all its edges keeps its side in every minimum cut; it is fixed first
    and its edges become terminals of its neighbours. Shortest augmenting paths solve the rest.
    """
    n = len(terminal)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    t = list(terminal)
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(t[i]) >= sum(near[i].values()):
            side[i] = t[i] >= 0
            for j, c in near[i].items():
                t[j] += c if side[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        source, sink = n, n + 1
        cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest} | {source: {}, sink: {}}
        for i in rest:
            a, b = (source, i) if t[i] > 0 else (i, sink)
            cap[a][b] = abs(t[i])
            cap[b].setdefault(a, 0.0)
        while True:
            came = {source: source}
            queue = deque([source])
            while queue and sink not in came:
                u = queue.popleft()
                for v, c in cap[u].items():
                    if c > 1e-9 and v not in came:
                        came[v] = u
                        queue.append(v)
            if sink not in came:
                break
            path, v = [], sink
            while v != source:
                path.append((came[v], v))
                v = came[v]
            flow = min(cap[u][v] for u, v in path)
            for u, v in path:
                cap[u][v] -= flow
                cap[v][u] = cap[v].get(u, 0.0) + flow
        # All that cannot reach the sink any more: of equal cuts, that with most on the source's side.
        leads = {sink}
        queue = deque([sink])
        while queue:
            v = queue.popleft()
            for u in cap[v]:  # every edge has its reverse
                if u not in leads and cap[u].get(v, 0.0) > 1e-9:
                    leads.add(u)
                    queue.append(u)
        for i in rest:
            side[i] = i not in leads
    return side


class Costs:
    """What a block's label costs, remembered by the elements it stands in and by the look of its text."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.places: dict[tuple, float] = {}
        self.looks: dict[tuple, float] = {}

    def __call__(self, block: Block, i: int, n: int) -> float:
        """The cost of calling it boilerplate, less that of calling it content."""
        key = block.about
        if key not in self.places:
            if len(self.places) > 50_000:
                self.places.clear()
            self.places[key] = float(self.weights[_place_features(*key)].sum())
        look = _text_features(block, i, n)
        if look not in self.looks:
            self.looks[look] = float(self.weights[_text_buckets(look)].sum())
        return max(-6.0, min(6.0, self.places[key] + self.looks[look]))


def content(blocks: list[Block], costs: Costs, strength: float = 1.0) -> list[bool]:
    """Labels by minimum cut."""
    n = len(blocks)
    terminal = [costs(b, i, n) for i, b in enumerate(blocks)]
    edges = []
    for i in range(n - 1):
        edges.append((i, i + 1, strength / (1 + steps_apart(blocks[i].block, blocks[i + 1].block))))
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):  # the next block in the same parent, if another stands between
        parent = b.block.outer.number if b.block and b.block.outer else 0
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, strength / 2))
        last[parent] = i
    return max_flow_side(terminal, edges)


def fit(pages: DataFrame, max_pages: int = 500, id_col: str = "page_id", html_col: str = "html") -> np.ndarray:
    """Train on at most ``max_pages`` pages, picked by a hash of the id; they go to the driver. Ids are picked
    without their pages, so that tasks send no pages that others displace."""
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    order = [F.xxhash64("id"), F.col("id")]
    ids = rows.select(F.col("id").alias("chosen")).orderBy(F.xxhash64("chosen"), "chosen").limit(max_pages)
    few = rows.join(ids, F.col("id").eqNullSafe(F.col("chosen")), "left_semi")
    return train([r.html for r in few.orderBy(*order, F.xxhash64("html")).limit(max_pages).collect()])


def main_text(html: Column, weights: np.ndarray) -> Column:
    """struct(text, n_blocks, n_content): the article's blocks, one on each line."""

    def extract(page: str | None, costs: Costs) -> tuple[str, int, int]:
        blocks = blocks_of(page) if page else []
        own = [b.text for b, keep in zip(blocks, content(blocks, costs)) if keep]
        return "\n".join(own), len(blocks), len(own)

    kinds = {"text": pa.string(), "n_blocks": pa.int32(), "n_content": pa.int32()}

    def work():
        costs = Costs(weights)

        def do(pages: pa.Array) -> pa.Array:
            columns = zip(*[extract(p, costs) for p in pages.to_pylist()])
            return struct_array(**{n: pa.array(c, type=t) for (n, t), c in zip(kinds.items(), columns)})

        return do

    return text_column(work, "text string, n_blocks int, n_content int", pa.struct(list(kinds.items())))(html)
