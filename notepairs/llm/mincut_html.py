"""Main text of HTML pages by minimum-cut labelling.

A page becomes a row of text blocks. What a block and its ancestors show gives the cost
of calling it content and that of calling it boilerplate; these are its capacities to the
two terminals. Neighbours in the page, and following blocks of the same container, are
joined by edges that weigh more the closer they are in the DOM. A maximum flow leaves the
cheapest labelling: content is what the source still reaches.

Defined cases: a null or empty page, or one without content, has the empty text; broken
markup is read as far as it goes, an unclosed comment or script hides the rest; pages of any
length are read whole; a block that costs as much either way is content; repeated rows are
extracted each; an empty table gives an empty result; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from notepairs.llm.common import by_bytes, record_batches, text_or_empty

#: Elements whose content is not text of the page. The first end with their end tag or the page;
#: the others hide nothing where their end tag is missing, and foreign ones may close themselves.
RAW = "script|style|textarea|title|iframe"
HIDDEN = "noscript|template|svg|math|select|object|canvas|audio|video"
_QUOTED = r"\"[^\"]*\"|'[^']*'"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:{_QUOTED}|[^'\">])*+>.*?(?:</\1\s*>|\Z)|<(?:svg|math)\b(?:{_QUOTED}|[^'\">/]|/(?!>))*+/>"
    rf"|<({HIDDEN})\b(?:{_QUOTED}|[^'\">])*+>.*?</\2\s*>|<!\[CDATA\[|<[!?][^>]*>"
    rf"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:{_QUOTED}|[^'\">])*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr img picture source nobr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form button dialog menu fieldset datalist head option".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
#: Words of class and id names, met as whole words, and those met inside longer words. Those of
#: the first line name what never is the article; the last only hint, as sections of texts bear them too.
REMARK_NAMES = frozenset("comment comments disqus replies reply respond".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv nav navbar navigation menu footer sidebar aside widget widgets notice notices banner promo promos popup modal cookie"
    " cookies consent gdpr breadcrumb breadcrumbs pager pagination login signup signin subscribe newsletter toolbar topbar masthead copyright".split()
)
HINT_NAMES = frozenset("alert disclaimer form legal recommended related search share sharing side skip social tags".split())
BOILERPLATE_PARTS = ("advert", "sponsor", "sidebar", "newsletter", "breadcrumb", "cookie", "navbar", "outbrain", "taboola")
#: Beginnings of names that tell of a page or a text what it has or is filed under.
TELLING = ("no-", "has-", "with-", "without-", "category-", "cat-", "tag-", "tagged-", "type-", "format-", "is-", "js-")
CONTENT_NAMES = frozenset("article content post entry story articlebody".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p"
    " pre section table ul li dd dt tr td th".split()
)
#: What one open element of a kind closes when the next of the kind begins.
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table menu".split())
#: Costs: what elements and hidden parts weigh, names, and hints; being inside and outside of marked content.
#: A block's own looks come to about 7 and its neighbours to about 4, so prose outweighs hints.
STRONG, NAMED, HINTED = 24.0, 14.0, 6.0
INSIDE, OUTSIDE = 16.0, 8.0
NEAR, FOLLOWING = 3.0, 1.0


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    good: bool
    bad: float
    link: bool
    own: float


@dataclass(slots=True)
class Block:
    text: str
    node: int
    linked: int
    heading: bool


def _named(value: str, inside: bool) -> tuple[bool, float]:
    """Whether class or id names stand for content, and how much for boilerplate."""
    good, bad = False, 0.0
    for name in value.split():
        if name.startswith(TELLING):
            continue
        words = set(_WORDS.findall(name))
        content = not CONTENT_NAMES.isdisjoint(words)
        if not REMARK_NAMES.isdisjoint(words) or "comment" in name:
            bad = max(bad, STRONG)
        elif not BOILERPLATE_NAMES.isdisjoint(words) or any(p in name for p in BOILERPLATE_PARTS) or ("header" in words and not inside):
            bad = max(bad, NAMED)
        elif not HINT_NAMES.isdisjoint(words) and not content:
            bad = max(bad, HINTED)
        good |= content
    return good, bad


def _marks(tag: str, attributes: str, inside: bool) -> tuple[bool, float, float]:
    """Whether an element starts content, what it weighs as boilerplate, and how much of that by its names alone."""
    good, bad, named = tag in CONTENT_TAGS, STRONG * (tag in BOILERPLATE_TAGS or (tag == "header" and not inside)), 0.0
    if attributes and tag != "html" and tag != "body":
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                bad = max(bad, STRONG * (value in BOILERPLATE_ROLES))
                good |= value in ("main", "article")
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                bad = STRONG
            elif name == "itemprop":
                good |= value == "articlebody"
            elif name in ("class", "id"):
                content, weight = _named(value, inside)
                good |= content
                named = max(named, weight)
    return good, bad, named


def blocks_of(page: str) -> tuple[list[Block], list[Node]]:
    """Text blocks in page order, and the elements that hold them."""
    nodes = [Node("", -1, 0, False, 0.0, False, 0.0)]
    stack = [0]
    blocks: list[Block] = []
    parts: list[str] = []
    linked = 0
    owner = 0
    heading = False

    def flush() -> None:
        nonlocal linked, heading
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, owner, linked, heading))
            parts.clear()
        linked = 0
        heading = False

    def text(raw: str) -> None:
        nonlocal linked, owner, heading
        if not raw:
            return
        words = html.unescape(raw) if "&" in raw else raw
        at = stack[-1]
        while nodes[at].tag in INLINE:
            at = nodes[at].parent
        owner = at
        heading |= len(nodes[at].tag) == 2 and nodes[at].tag[0] == "h" and nodes[at].tag[1].isdigit()
        parts.append(words)
        if nodes[stack[-1]].link:
            linked += len(words)

    def close(tags: tuple[str, ...] | frozenset[str], scopes: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[i]].tag
            if tag in tags:
                del stack[i:]
                return
            if tag in scopes or tag in CONTENT_TAGS:
                return

    last = 0
    for m in _TOKEN.finditer(page):
        text(page[last : m.start()])
        last = m.end()
        tag = (m[4] or m[7] or "").lower()
        if not tag:
            if m[1] or m[2]:
                flush()
            continue
        if tag not in INLINE:
            if tag == "br":
                parts.append(" ")
                continue
            flush()
        if m[3] or m[6]:
            for i in range(len(stack) - 1, 0, -1):
                if nodes[stack[i]].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in _CLOSES_P:
            close(("option",), frozenset(("select",)))
            close(("p",), frozenset(("div", "section", "td", "li", "blockquote", "form", "nav", "footer", "aside", "header")))
        if tag in _SIBLINGS:
            close(_SIBLINGS[tag], _SCOPES)
        if tag in VOID:
            continue
        up = nodes[stack[-1]]
        good, bad, named = _marks(tag, m[5] or m[8] or "", up.good)
        nodes.append(Node(tag, stack[-1], up.depth + 1, up.good or good, bad, up.link or tag == "a", named))
        stack.append(len(nodes) - 1)
    text(page[last:])
    flush()
    _inherit(blocks, nodes)
    return blocks, nodes


def _inherit(blocks: list[Block], nodes: list[Node]) -> None:
    """Hand marks down to all that an element holds; boilerplate inside content stays boilerplate.

    A name does not count on an element that holds most of the page's words outside links
    and all that is marked as content, such as a wrapper named after all its parts, unless
    it names readers' remarks.
    """
    held, marked = [0] * len(nodes), [0] * len(nodes)
    for b in blocks:
        words = max(0, len(b.text) - b.linked)
        held[b.node] += words
        marked[b.node] += words * nodes[b.node].good
    for i in range(len(nodes) - 1, 0, -1):
        held[nodes[i].parent] += held[i]
        marked[nodes[i].parent] += marked[i]
    for i in range(1, len(nodes)):
        node = nodes[i]
        void = 2 * held[i] > held[0] and marked[i] == marked[0]
        named = 0.0 if void and node.own < STRONG else node.own
        node.bad = max(node.bad, named, nodes[node.parent].bad)


def capacities(block: Block, node: Node, any_good: bool) -> tuple[float, float]:
    """Costs of calling a block boilerplate, and of calling it content."""
    words = block.text.count(" ") + 1
    share = min(1.0, block.linked / max(1, len(block.text)))
    ends = block.text[-1] in ".!?:;…\"”»。！？"
    content = 0.5 + min(words, 40) / 8 * (1 - share) + 1.5 * ends
    boilerplate = 1.0 + 6.0 * share + (1.5 if words < 4 and not block.heading else 0.0)
    boilerplate += node.bad
    if node.good and not node.bad:
        content += INSIDE
    elif any_good and not node.good:
        boilerplate += OUTSIDE
    return content, boilerplate


def _distance(nodes: list[Node], a: int, b: int) -> int:
    """Steps from one element to another in the DOM."""
    steps = 0
    while a != b:
        if nodes[a].depth < nodes[b].depth:
            a, b = b, a
        a = nodes[a].parent
        steps += 1
    return steps


def min_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True where a node is on the source's side of a minimum cut.

    ``gains`` are the source's capacity less the sink's, of which only the difference
    matters; edges have equal capacity both ways. Levels and blocking flows, without
    recursion.
    """
    n = len(gains)
    links: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, weight in edges:
        links[a].append(len(to))
        to.append(b)
        room.append(weight)
        links[b].append(len(to))
        to.append(a)
        room.append(weight)
    left = list(gains)
    tiny = 1e-9
    while True:
        level = [0 if g > tiny else -1 for g in left]
        queue = [i for i in range(n) if level[i] == 0]
        reached = False
        for a in queue:
            for e in links[a]:
                b = to[e]
                if room[e] > tiny and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
                    reached |= left[b] < -tiny
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * n
        for source in range(n):
            while left[source] > tiny and level[source] == 0:
                path: list[int] = []
                at = source
                while True:
                    if left[at] < -tiny:
                        flow = min(left[source], -left[at], *[room[e] for e in path])
                        for e in path:
                            room[e] -= flow
                            room[e ^ 1] += flow
                        left[source] -= flow
                        left[at] += flow
                        break
                    while turn[at] < len(links[at]):
                        e = links[at][turn[at]]
                        if room[e] > tiny and level[to[e]] == level[at] + 1:
                            break
                        turn[at] += 1
                    if turn[at] < len(links[at]):
                        path.append(links[at][turn[at]])
                        at = to[path[-1]]
                    elif path:
                        e = path.pop()
                        at = to[e ^ 1]
                        turn[at] += 1
                    else:
                        level[source] = -2
                        break


def main_text(page: str) -> str:
    """The content blocks of a page in order, joined by one space."""
    blocks, nodes = blocks_of(page)
    if not blocks:
        return ""
    any_good = any(nodes[b.node].good and not nodes[b.node].bad for b in blocks)
    costs = [capacities(b, nodes[b.node], any_good) for b in blocks]
    edges = []
    before: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR / (1 + _distance(nodes, blocks[i - 1].node, block.node))))
        container = nodes[block.node].parent
        if before.get(container, i - 1) < i - 1:
            edges.append((before[container], i, FOLLOWING))
        before[container] = i
    kept = min_cut([c - b for c, b in costs], edges)
    return " ".join(b.text for b, keep in zip(blocks, kept) if keep)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_bytes(batch, "html", 4 << 20):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield record_batches({
                "page_id": part.column("page_id"), "url": part.column("url"), "text": texts, "n_chars": [len(t) for t in texts],
            }, _OUT)


def extract(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(
        pages[id_column].cast("long").alias("page_id"), pages[url_column].cast("string").alias("url"), text_or_empty(pages, html_column).alias("html")
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
