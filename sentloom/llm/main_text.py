"""Main text of web pages by minimum cuts.

A page becomes blocks of text in page order. A linear classifier over the block and its ancestors gives each block a
cost of being called content and one of being called boilerplate; these are its capacities to the two terminals.
Neighbouring blocks and the blocks of one parent are joined by edges that weaken with their distance in the document
tree. The minimum cut, found by maximum flow, is the cheapest labelling. Classes and ids count against the text below
them, except where their element wraps the page's main text.

Defined results: a null or empty page has an empty text; unclosed and stray tags are read as browsers do, as far as
block bounds go, in linear time; a line break is white space; repeated rows keep one row each; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose text is never shown as text of the page.
RAW = "script|style|noscript|template|iframe|object|svg|canvas|textarea|select"
# Elements that bound blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element of the first kind ends where one of the second kind starts.
ENDS = {
    "p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]), "head": frozenset(["body"]),
}

# The classifier: what ancestors and the block itself add to the log-odds of content.
CONTAINERS = {
    "nav": -7.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "menu": -7.0, "button": -7.0, "dialog": -7.0, "head": -20.0,
    "title": -20.0, "fieldset": -7.0, "search": -7.0, "header": -7.0, "label": -4.0,
}
OWN = {"p": 0.8, "h1": 0.8, "h2": 0.5, "h3": 0.5, "h4": 0.5, "blockquote": 0.5, "pre": 0.5, "li": -0.3}
IN_ARTICLE, NAMED_CONTENT, NAMED_BOILERPLATE, HIDDEN = 2.5, 1.5, -7.0, -8.0
BIAS, LENGTH, SENTENCE, LINKS, RIGHTS = -1.0, 0.5, 0.5, -4.0, -2.0
#: Share of a page's text from which on an element with its longest article or first-rank heading is a wrapper, whatever its name.
WRAPPER_SHARE = 0.5
#: Strength of the edges between blocks.
SMOOTH = 0.6

BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adsense adslot banner billboard promo promotion promotions sponsor sponsored "
    "sidebar rail nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot header masthead topbar cookie "
    "cookies consent gdpr privacy notice notices notification alert disclaimer popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments commentlist "
    "disqus reply replies respond search searchbox widget toolbar pagination pager legal copyright tagcloud".split()
)
CONTENT_NAMES = frozenset("article main content post entry story body text".split())
NOT_ITSELF = frozenset("has with no without".split())
BANNERS = frozenset("banner navigation complementary contentinfo search form dialog alertdialog menu menubar".split())

_INSIDE = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
# The end of a tag. A quote that nothing closes is an ordinary character; a tag that nothing closes takes the rest of the
# page, as in browsers. So no part of a page is read again for a tag that fails.
_END = r"""(?:>|(?=["'])[^>]*+(?:>|\Z)|\Z)"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>]){_INSIDE}{_END}"""
    rf"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<inside>{_INSIDE}){_END}|<[!?][^>]*+(?:>|\Z)""",
    re.S | re.I,
)
# What ends a raw element: an end tag of its own name. Those that nest are matched outside of comments, scripts and styles.
RAW_END = {r: re.compile(rf"</{r}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for r in RAW.split("|")}
NESTED = {
    r: re.compile(
        rf"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])[^>]*+(?:>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)"
        rf"|<(?P<end>/?){r}(?=[\s/>]){_INSIDE}{_END}", re.S | re.I
    )
    for r in ("svg", "template", "object")
}
# Start tags that end a drawing without an end tag.
BREAKOUT = re.compile(
    r"<(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre|ruby|s|small|"
    r"span|strong|strike|sub|sup|table|tt|u|ul|var)(?=[\s/>])|</(?:p|body|html|article|main|section|div|li|a|span|button)(?=[\s/>])", re.I
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RIGHTS_TEXT = re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved", re.I)
SENTENCE_END = re.compile(r"[.!?…。！？](?:\s|$)")


def named(attributes: str) -> tuple[float, float]:
    """What an element says about the text in it: by class and id alone, and by role and being hidden."""
    name = state = 0.0
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in NAME.findall(word)}
                if parts & BOILERPLATE_NAMES and not parts & NOT_ITSELF:
                    name = min(name, NAMED_BOILERPLATE)
                elif parts & CONTENT_NAMES and name >= 0:
                    name = NAMED_CONTENT
        elif kind == "role":
            if value.lower() in BANNERS:
                state = min(state, NAMED_BOILERPLATE)
            elif value.lower() in ("main", "article") and state >= 0:
                state = NAMED_CONTENT
        elif kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and "display:none" in value.replace(" ", ""):
            state = min(state, HIDDEN)
    return name, state


def nested_ends(source: str, raw: str) -> dict[int, int]:
    """Where the elements of a raw name end, by the end of their start tags; those without an end tag are left out."""
    out, starts = {}, []
    for m in NESTED[raw].finditer(source):
        if m["end"]:
            if starts:
                out[starts.pop()] = m.end()
        elif m["end"] is not None:
            if raw == "svg" and m[0].endswith("/>"):
                out[m.end()] = m.end()
            else:
                starts.append(m.end())
    return out


def raw_end(source: str, raw: str, at: int, ends: dict[str, dict[int, int]]) -> int:
    """Where the raw element ends whose start tag ends at ``at``; ``ends`` keeps what is known of the page."""
    if raw in NESTED:
        if raw not in ends:
            ends[raw] = nested_ends(source, raw)
        if at in ends[raw]:
            return ends[raw][at]
        m = BREAKOUT.search(source, at) if raw == "svg" else None
        return m.start() if m else len(source)
    m = RAW_END[raw].search(source, at)
    return m.end() if m else len(source)


class Page:
    """Blocks of a page: text, log-odds of content and element; elements: parent and depth."""

    def __init__(self, source: str):
        self.parent, self.depth = [-1], [0]
        self.texts: list[str] = []
        self.odds: list[float] = []
        self.element: list[int] = []
        # Of each element: whether its class or id alone names boilerplate, whether it is a main text's own element (2: main,
        # 1: article), and the text below it that nothing else than such names speaks against.
        self.charged, self.principal, self.free = [False], [0], [0]
        self.headed = [False]
        #: Of each block, the worst that its ancestors say besides class and id.
        self.worst: list[float] = []
        # Of each open element: tag, number, worst and best of the ancestors, whether an article is around.
        stack: list[tuple[str, int, float, float, bool]] = [("", 0, 0.0, 0.0, False)]
        count: dict[str, int] = {}
        buffer: list[str] = []
        linked, in_links, at = 0, 0, 0
        ends: dict[str, dict[int, int]] = {}

        def flush() -> None:
            nonlocal linked
            if buffer:
                text = " ".join(html.unescape("".join(buffer)).split())
                if text:
                    tag, number, worst, best, article = stack[-1]
                    own = next((t[0] for t in reversed(stack) if t[0] in BLOCKS), "")
                    odds = BIAS + best + OWN.get(own, 0.0) + (IN_ARTICLE if article else 0.0)
                    odds += LENGTH * math.log1p(len(text) / 40) + LINKS * min(linked / len(text), 1.0)
                    if SENTENCE_END.search(text):
                        odds += SENTENCE
                    if RIGHTS_TEXT.search(text) and len(text) < 300:
                        odds += RIGHTS
                    self.texts.append(text)
                    self.odds.append(odds)
                    self.element.append(number)
                    self.worst.append(worst)
                    if worst >= 0:
                        self.free[number] += len(text)
                        self.headed[number] |= own == "h1"
                buffer.clear()
            linked = 0

        def close(tag: str) -> None:
            nonlocal in_links
            while True:
                top = stack.pop()[0]
                count[top] -= 1
                in_links -= top == "a"
                if top == tag:
                    return

        while m := TOKEN.search(source, at):
            if m.start() > at:
                piece = source[at : m.start()]
                buffer.append(piece)
                if in_links:
                    linked += len(piece)
            at = m.end()
            if m["raw"]:
                at = raw_end(source, m["raw"].lower(), at, ends)
            if m["tag"] is None:
                continue
            tag = m["tag"].lower()
            block = tag in BLOCKS
            if block:
                flush()
            elif tag == "br":
                buffer.append(" ")
            if m["end"]:
                if count.get(tag):
                    close(tag)
                continue
            while len(stack) > 1 and tag in ENDS.get(stack[-1][0], ()):
                close(stack[-1][0])
            if block and count.get("p") and any(t[0] == "p" for t in stack[-4:]):
                close("p")
            if tag in VOID or m["inside"].endswith("/") and not block:
                continue
            _, above, worst, best, article = stack[-1]
            name, state = named(m["inside"]) if m["inside"] and tag not in ("html", "body") else (0.0, 0.0)
            own_name = name < 0
            if tag in ("article", "main"):
                article, name, state = True, max(name, 0.0), max(state, 0.0)
            own = CONTAINERS.get(tag, 0.0)
            if tag == "header" and article:
                own = 0.0
            worst = min(worst, own, state)
            best = max(best, max(name, state) if min(name, state) >= 0 else 0.0)
            self.charged.append(name < 0)
            self.principal.append(0 if worst < 0 else 2 if tag == "main" else 1 if (tag == "article" or state > 0) and not own_name else 0)
            self.free.append(0)
            self.headed.append(False)
            self.parent.append(above)
            self.depth.append(self.depth[above] + 1)
            stack.append((tag, len(self.parent) - 1, worst, best, article))
            count[tag] = count.get(tag, 0) + 1
            in_links += tag == "a"
        if at < len(source):
            buffer.append(source[at:])
        flush()
        self.charge_names()

    def charge_names(self) -> None:
        """Adds to the odds what ancestors say against a block; class and id count unless their element wraps the main text.

        It does if it holds a ``main``, or if it holds the longest ``article`` or a first-rank heading and most of the text
        that no other name speaks against.
        """
        parent, n = self.parent, len(self.parent)
        main, chief = [p == 2 for p in self.principal], list(self.headed)
        articles = [e for e, p in enumerate(self.principal) if p == 1]
        if articles:
            below = self.sums(self.free)
            chief[max(articles, key=lambda e: (below[e], -e))] = True
        for e in range(n - 1, 0, -1):
            main[parent[e]] |= main[e]
            chief[parent[e]] |= chief[e]
        apart = [False] * n
        for e in range(1, n):
            apart[e] = apart[parent[e]] or self.charged[e] and not main[e] and not chief[e]
        text = self.sums([0 if x else t for x, t in zip(apart, self.free, strict=True)])
        against = [False] * n
        for e in range(1, n):
            wraps = main[e] or chief[e] and text[e] >= WRAPPER_SHARE * text[0]
            against[e] = against[parent[e]] or self.charged[e] and not wraps
        for i, e in enumerate(self.element):
            self.odds[i] += min(self.worst[i], NAMED_BOILERPLATE if against[e] else 0.0)

    def sums(self, values: list[int]) -> list[int]:
        """Of each element, the total of its own value and those of the elements below it."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def distance(self, a: int, b: int, most: int = 12) -> int:
        """Steps between two elements in the tree, ``most`` if they are farther apart."""
        steps = 0
        while a != b and steps < most:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a, steps = self.parent[a], steps + 1
        return steps

    def edges(self) -> list[tuple[int, int, float]]:
        """Between each block and the next, and between blocks whose elements have one parent."""
        out, last = [], {}
        for i, e in enumerate(self.element):
            if i:
                out.append((i - 1, i, SMOOTH * math.exp(-self.distance(self.element[i - 1], e) / 2)))
            up = self.parent[e]
            if up in last and last[up] < i - 1:
                out.append((last[up], i, SMOOTH * math.exp(-1.0)))
            last[up] = i
        return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labels (True: content) of the least total of terminal and edge costs."""
    n = len(odds)
    label: list[bool | None] = [None] * n
    around: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        around[a].append((b, c))
        around[b].append((a, c))
    cost, free = list(odds), [sum(c for _, c in x) for x in around]
    # A block whose own cost exceeds all its edges keeps its label in every minimum cut; its edges then are costs of
    # its neighbours.
    ready = deque(range(n))
    while ready:
        i = ready.popleft()
        if label[i] is None and abs(cost[i]) >= free[i]:
            label[i] = cost[i] > 0
            for j, c in around[i]:
                if label[j] is None:
                    cost[j] += c if label[i] else -c
                    free[j] -= c
                    ready.append(j)
    left = [i for i in range(n) if label[i] is None]
    if left:
        number = {v: k for k, v in enumerate(left)}
        inner = [(number[a], number[b], c) for a, b, c in edges if label[a] is None and label[b] is None]
        for v, side in zip(left, maximum_flow([cost[v] for v in left], inner), strict=True):
            label[v] = side
    return [bool(x) for x in label]


def maximum_flow(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The source side of a minimum cut, by shortest augmenting paths in levels."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        join(source, i, x, 0.0) if x > 0 else join(i, sink, -x, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-12 and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if sink not in level:
            return [i in level for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path, a = [], source
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > 1e-12 and level.get(to[e], -1) == level[a] + 1:
                    break
                at[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                at[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    labels = minimum_cut(page.odds, page.edges())
    return "\n".join(t for t, keep in zip(page.texts, labels, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch["html"]]
            yield pa.record_batch(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    columns = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return columns.mapInArrow(read, "page_id long, url string, text string, n_chars long")
