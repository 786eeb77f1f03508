"""Main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks of text, each with the elements around it.  A classifier gives every
block log-odds of being content: evidence of the markup (an article, a menu, telling names of
classes and ids) plus a linear model of the text (words, share of links, sentence ends, kind of
element).  In the graph of a page the log-odds are capacities to the terminals, and blocks that
follow each other or have the same parent are joined by smoothness edges, weaker the further
apart they are in the page's tree.  The maximum flow gives the cheapest labelling, and the
blocks on the content side, in page order, are the text.

The linear model is trained (``fit``) on blocks of a bounded sample of pages, labelled by those
elements that state what they hold (``article`` against ``nav``, ``footer`` and so on), and kept
near stated starting weights, so that pages of one make cannot turn it.

Defined results: null and empty pages have an empty text, as have pages without text; markup
that is never closed or badly nested is read as browsers do, roughly; text outside any element
is a block; blocks with equal costs on both sides are content; white space includes no-break
spaces; line breaks, table cells and inline elements stay within a block; the text of scripts,
styles, templates and form fields is no text; nothing is cut, however long; repeated rows stay
separate rows; all other columns stay.
"""

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.columns import _quoted, keep_rows_with
from obsengine.llm.workers import map_arrow

# Elements by what they do, as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
HIDDEN = frozenset("audio button canvas datalist head math noscript object select svg template video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open one of the same group, and the elements that shield it.
SIBLINGS = {
    **dict.fromkeys(["li"], (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"]))),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), frozenset(["dl"]))),
    **dict.fromkeys(["tr"], (frozenset(["tr", "td", "th"]), frozenset(["table"]))),
    **dict.fromkeys(["td", "th"], (frozenset(["td", "th"]), frozenset(["table", "tr"]))),
    **dict.fromkeys(["option"], (frozenset(["option"]), frozenset(["select", "datalist"]))),
}

# What elements and words in class, id and role say about their text.
BOILERPLATE = frozenset("aside dialog fieldset footer form header menu nav search".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline captcha"
    " comment commentlist comments complementary consent contentinfo cookie cookies disclaimer disqus"
    " footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter"
    " notice notices notification pager pagination popup privacy promo promoted promotion recommended"
    " related replies reply respond search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe subscription tags teaser toolbar widget widgets".split()
)
GOOD_WORDS = frozenset("article articlebody body content entry main post story".split())
#: Names that say nothing inside an article.
INNER_WORDS = frozenset("header search".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+)\s*(=?)\s*")
_BARE = re.compile(r"[^\s>]*")
#: Mark of an element that is not shown, among the words of its names.
_UNSEEN = "#hidden"
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")

#: Log-odds of what the markup says; a boilerplate element around a block outweighs an article.
IN_BOILERPLATE, IN_ARTICLE, IN_OTHER_ARTICLE, IN_GOOD = -8.0, 5.0, 1.0, 2.0
#: Smoothness between neighbours, divided by their distance in the tree, and between siblings.
NEIGHBOUR, SIBLING = 1.5, 0.75
#: Capacities are whole numbers, so that a cut is exact.
_UNIT = 1000
_TEXT_LIMIT = 3.0

#: Features: 1, log words, share of link text, sentence end, heading, paragraph, list item.
START = (-1.5, 0.6, -3.0, 0.7, 0.5, 0.6, -0.8)


@dataclass
class Element:
    name: str
    parent: "Element | None"
    depth: int
    words: list[str]
    main: bool = False  # holds the main article
    titled: bool = False  # a header that holds a heading
    length: int = 0


@dataclass
class Block:
    """Text of a stretch of a page between two block elements."""

    text: str
    element: Element
    links: int
    shared: int  # depth of the last element that holds this block and the one before
    features: tuple[float, ...] = field(default=())
    evidence: float = 0.0


def _names(html: str, at: int, quotes: dict[str, bool]) -> tuple[list[str], int, bool]:
    """Words of class, id and role of a start tag, the position after it, and whether it is hidden."""
    words, hidden = [], False
    while True:
        found = _ATTRIBUTE.match(html, at)
        if found is None:
            end = html.find(">", at)
            return words, (end + 1 if end >= 0 else len(html)), hidden
        at, value = found.end(), ""
        if found.group(2):
            quote = html[at : at + 1]
            # A quote that is never closed is part of a bare value; it is looked for once a page.
            close = html.find(quote, at + 1) if quote in ("'", '"') and quotes.get(quote, True) else -1
            if close >= 0:
                value, at = html[at + 1 : close], close + 1
            else:
                if quote in ("'", '"'):
                    quotes[quote] = False
                bare = _BARE.match(html, at)
                value, at = bare.group(), bare.end()
        name = found.group(1).lower()
        if name in ("class", "id", "role", "itemprop"):
            words += [w.lower() for w in _WORD.findall(value)]
        elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            hidden = True


class _Reader:
    """Reads one page into blocks."""

    def __init__(self, html: str):
        self._root = Element("#page", None, 0, [])
        self._stack = [self._root]
        self._open: dict[str, int] = {}
        self._pieces: list[str] = []
        self._links = self._hidden = self._anchors = 0
        self._shared = 0
        self.blocks: list[Block] = []
        self.elements: list[Element] = []
        self._read(html)

    def _flush(self) -> None:
        text = " ".join("".join(self._pieces).split())
        if text:
            inside = next(e for e in reversed(self._stack) if e.name in BLOCK or e is self._root)
            self.blocks.append(Block(text, inside, self._links, min(self._shared, inside.depth)))
            self._shared = inside.depth
        self._pieces, self._links = [], 0

    def _text(self, raw: str) -> None:
        if raw and not self._hidden:
            text = unescape(raw) if "&" in raw else raw
            self._pieces.append(text)
            if self._anchors:
                self._links += len(text.strip())

    def _push(self, name: str, words: list[str]) -> None:
        element = Element(name, self._stack[-1], len(self._stack), words)
        self._stack.append(element)
        self._open[name] = self._open.get(name, 0) + 1
        self._hidden += name in HIDDEN
        self._anchors += name == "a"
        self.elements.append(element)
        if name in HEADINGS and self._open.get("header"):
            next(e for e in reversed(self._stack) if e.name == "header").titled = True

    def _pop(self, at: int = -1) -> None:
        name = self._stack.pop(at).name
        self._open[name] -= 1
        self._hidden -= name in HIDDEN
        self._anchors -= name == "a"
        if at == -1:
            self._shared = min(self._shared, len(self._stack) - 1)

    def _close(self, at: int) -> None:
        while len(self._stack) > at:
            self._pop()

    def _end(self, name: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name in BLOCK:
            self._flush()
        if not self._open.get(name):
            return
        at = len(self._stack) - 1
        crossed = False
        while self._stack[at].name != name:
            crossed = crossed or self._stack[at].name in BLOCK
            at -= 1
        if crossed and name not in BLOCK and name not in HIDDEN:
            self._pop(at)  # an inline element ends, the blocks inside it go on
        else:
            self._close(at)

    def _start(self, name: str, words: list[str], hidden: bool) -> None:
        if self._open.get("head") and (name in BLOCK or name == "body"):
            self._close(next(i for i, e in enumerate(self._stack) if e.name == "head"))
        if name in BLOCK:
            self._flush()
            if self._open.get("p"):
                # A paragraph ends where a block starts, unless a table cell or object shields it.
                at = len(self._stack) - 1
                while self._stack[at].name not in ("p", "td", "th", "caption", "object"):
                    at -= 1
                if self._stack[at].name == "p":
                    self._close(at)
        if name in SIBLINGS:
            ended, shields = SIBLINGS[name]
            if any(self._open.get(e) for e in ended):
                at = len(self._stack) - 1
                last = 0
                while at > 0 and self._stack[at].name not in shields:
                    if self._stack[at].name in ended:
                        last = at
                    at -= 1
                if last:
                    self._close(last)
        if name in SPACED:
            self._text(" ")
        if name in VOID:
            return
        self._push(name, words)
        if hidden:
            self._stack[-1].words.append(_UNSEEN)

    def _read(self, html: str) -> None:
        at, length, quotes = 0, len(html), {}
        while at < length:
            tag = html.find("<", at)
            if tag < 0:
                self._text(html[at:])
                break
            self._text(html[at:tag])
            following = html[tag + 1 : tag + 2]
            if html.startswith("<!--", tag):
                end = tag + 5 if html.startswith("<!-->", tag) else html.find("-->", tag + 4) + 3
                at = end if end > 2 else length
            elif following.isascii() and following.isalpha():
                name = _NAME.match(html, tag + 1).group().lower()
                words, at, hidden = _names(html, tag + 1 + len(name), quotes)
                if name in RAW:
                    end = _RAW_END[name].search(html, at)
                    at = html.find(">", end.end()) + 1 or length if end else length
                elif name == "plaintext":
                    self._text(html[at:])
                    at = length
                else:
                    self._start(name, words, hidden)
            elif following == "/" and html[tag + 2 : tag + 3].isalpha():
                name = _NAME.match(html, tag + 2)
                if name:
                    self._end(name.group().lower())
                at = html.find(">", tag) + 1 or length
            elif following in ("/", "!", "?"):
                at = html.find(">", tag) + 1 or length
            else:
                self._text("<")
                at = tag + 1
        self._flush()


def _features(block: Block) -> tuple[float, ...]:
    name, text = block.element.name, block.text
    return (
        1.0,
        float(np.log1p(len(text.split()))),
        min(1.0, block.links / len(text)),
        float(bool(_SENTENCE.search(text))),
        float(name in HEADINGS),
        float(name == "p"),
        float(name in ("li", "dt", "dd", "option")),
    )


def read_blocks(html: str | None) -> list[Block]:
    """Blocks of a page with their features and the evidence of the markup."""
    page = _Reader(html or "")
    for block in page.blocks:
        block.element.length += len(block.text)
    for element in reversed(page.elements):  # inner elements come after those around them
        element.parent.length += element.length
    named = [e for e in page.elements if e.name in ("article", "main")] or [
        e
        for e in page.elements
        if e.name in BLOCK - BOILERPLATE and GOOD_WORDS.intersection(e.words) and not _named_bad(e)
    ]
    # Of nested ones of one length the innermost.
    largest = max(reversed(named), key=lambda e: e.length, default=None)
    above = largest
    while above is not None and not above.main:
        above.main = True
        above = above.parent
    judged: dict[int, tuple[float, bool]] = {}
    for block in page.blocks:
        block.features = _features(block)
        block.evidence = _evidence(block.element, largest, judged)[0]
    return page.blocks


def _evidence(
    element: Element | None, largest: Element | None, judged: dict[int, tuple[float, bool]]
) -> tuple[float, bool]:
    """Log-odds of an element by its markup and what is around it, and whether that is final."""
    way = []
    while element is not None and id(element) not in judged:
        way.append(element)
        element = element.parent
    found = judged[id(element)] if element is not None else (0.0, False)
    for element in reversed(way):
        value, settled = found
        if not settled:
            value, settled = _own_evidence(element, value, largest)
        found = judged[id(element)] = value, settled
    return found


def _named_bad(element: Element, inside: bool = False) -> bool:
    """Whether its class, id or role calls an element boilerplate; ``inside`` an article."""
    return bool(BAD_WORDS.intersection(element.words).difference(INNER_WORDS if inside else ()))


def _own_evidence(element: Element, above: float, largest: Element | None) -> tuple[float, bool]:
    inside = above >= IN_ARTICLE
    if _UNSEEN in element.words:
        return IN_BOILERPLATE, True
    # The main article's own header holds its title; names of what holds that article say nothing.
    if not element.main and element.name not in ("html", "body"):
        if element.name in BOILERPLATE and not (element.titled and inside):
            return IN_BOILERPLATE, True
        if _named_bad(element, inside):
            return IN_BOILERPLATE, True
    if element is largest and element.name in ("article", "main"):
        return IN_ARTICLE, False
    if element.name in ("article", "main"):
        return max(above, IN_OTHER_ARTICLE), False
    if GOOD_WORDS.intersection(element.words):
        return max(above, IN_GOOD), False
    return above, False


class Flow:
    """Maximum flow by shortest augmenting layers over whole-number capacities."""

    def __init__(self, n: int):
        self._to: list[int] = []
        self._left: list[int] = []
        self._edges: list[list[int]] = [[] for _ in range(n)]

    def join(self, a: int, b: int, there: int, back: int = 0) -> None:
        for end, start, capacity in ((b, a, there), (a, b, back)):
            self._edges[start].append(len(self._to))
            self._to.append(end)
            self._left.append(capacity)

    def _layers(self, source: int) -> list[int]:
        layer = [-1] * len(self._edges)
        layer[source] = 0
        waiting = deque([source])
        while waiting:
            node = waiting.popleft()
            for edge in self._edges[node]:
                end = self._to[edge]
                if self._left[edge] and layer[end] < 0:
                    layer[end] = layer[node] + 1
                    waiting.append(end)
        return layer

    def run(self, source: int, sink: int) -> int:
        total = 0
        while True:
            layer = self._layers(source)
            if layer[sink] < 0:
                return total
            following = [0] * len(self._edges)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    amount = min(self._left[e] for e in path)
                    total += amount
                    back = 0
                    for i, edge in enumerate(path):
                        self._left[edge] -= amount
                        self._left[edge ^ 1] += amount
                        if not self._left[edge] and not back:
                            back = i + 1
                    del path[back - 1 :]
                    node = self._to[path[-1]] if path else source
                edges = self._edges[node]
                while following[node] < len(edges):
                    edge = edges[following[node]]
                    if self._left[edge] and layer[self._to[edge]] == layer[node] + 1:
                        break
                    following[node] += 1
                else:
                    if not path:
                        break
                    edge = path.pop()
                    node = self._to[edge ^ 1]
                    following[node] += 1
                    continue
                path.append(edge)
                node = self._to[edge]

    def reaching(self, sink: int) -> list[bool]:
        """Nodes from which the sink can still be reached; the others are the source's side."""
        seen = [False] * len(self._edges)
        seen[sink] = True
        waiting = deque([sink])
        while waiting:
            node = waiting.popleft()
            for edge in self._edges[node]:
                end = self._to[edge]
                if self._left[edge ^ 1] and not seen[end]:
                    seen[end] = True
                    waiting.append(end)
        return seen


def links(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: neighbours by their distance in the tree, and next blocks of one parent."""
    out, latest = [], {}
    for at, block in enumerate(blocks):
        if at:
            before = blocks[at - 1].element.depth
            steps = max(1, before + block.element.depth - 2 * block.shared)
            out.append((at - 1, at, max(1, round(_UNIT * NEIGHBOUR / steps))))
        parent = id(block.element.parent)
        if parent in latest:
            out.append((latest[parent], at, round(_UNIT * SIBLING)))
        latest[parent] = at
    return out


def costs(blocks: list[Block], weights: tuple[float, ...]) -> list[int]:
    """Log-odds of every block in whole units; positive for content."""
    out = []
    for block in blocks:
        text = sum(w * x for w, x in zip(weights, block.features))
        out.append(round(_UNIT * (block.evidence + max(-_TEXT_LIMIT, min(_TEXT_LIMIT, text)))))
    return out


def label(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling (content or not) of least cost; of several, the one with most content."""
    n = len(odds)
    flow = Flow(n + 2)
    for at, value in enumerate(odds):
        if value > 0:
            flow.join(n, at, value)
        elif value < 0:
            flow.join(at, n + 1, -value)
    for a, b, capacity in edges:
        flow.join(a, b, capacity, capacity)
    flow.run(n, n + 1)
    return [not reached for reached in flow.reaching(n + 1)[:n]]


def main_text(html: str | None, weights: tuple[float, ...] = START) -> str:
    blocks = read_blocks(html)
    kept = label(costs(blocks, weights), links(blocks))
    return "\n".join(block.text for block, content in zip(blocks, kept) if content)


def extract(pages: DataFrame, html: str = "html", weights: tuple[float, ...] = START) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points)."""

    def run(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(at)]
            yield [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return keep_rows_with(pages, html, [("text", "string"), ("n_chars", "long")], run)


def _stated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and labels of the blocks whose elements state what they hold."""
    for batch in batches:
        rows, said = [], []
        for page in batch.column(0):
            blocks = [b for b in read_blocks(page.as_py()) if abs(b.evidence) >= IN_ARTICLE]
            # As many blocks a page at most, evenly from all of it.
            for block in blocks[:: max(1, -(-len(blocks) // BLOCKS_A_PAGE))]:
                rows.append(block.features)
                said.append(block.evidence > 0)
        yield pa.RecordBatch.from_pydict(
            {"features": pa.array(rows, pa.list_(pa.float64())), "content": pa.array(said, pa.bool_())}
        )


BLOCKS_A_PAGE = 100


def fit(
    pages: DataFrame, key: str = "page_id", html: str = "html", sample_pages: int = 1000, hold: float = 50.0
) -> tuple[float, ...]:
    """Weights of the text features, learned from at most ``sample_pages`` pages.

    The pages with the smallest hashes of ``key`` are the sample, ``BLOCKS_A_PAGE`` blocks of
    each; their hashes are found first, from the keys alone, so that no task gathers more pages
    than that.  Logistic regression by Newton's method; ``hold`` is the strength that keeps the
    weights near ``START``, which is also the result without a page that states anything.
    """
    hashed = pages.select(F.col(_quoted(html)).alias("html"), F.xxhash64(_quoted(key)).alias("hash"))
    last = hashed.select("hash").orderBy("hash").limit(sample_pages).agg(F.max("hash")).first()[0]
    sample = (
        hashed.where(F.col("hash") <= F.lit(last).cast("long"))
        .orderBy("hash", "html")
        .limit(sample_pages)
        .select("html")
    )
    found = map_arrow(sample, _stated, "features array<double>, content boolean").toPandas()
    start = np.array(START)
    if found.empty:
        return START
    x, y = np.array(found["features"].tolist()), found["content"].to_numpy(dtype=float)
    # Content and boilerplate weigh the same, whatever their shares.
    share = np.where(y == 1, 1 / max(1, y.sum()), 1 / max(1, (1 - y).sum())) * len(y) / 2
    w = start.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + hold * (w - start)
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + hold * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(round(v, 6)) for v in w)
