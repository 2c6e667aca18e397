"""Main text of web pages: a minimum cut between content and boilerplate blocks.

A page is read once into blocks, the runs of text between block-level tags, each with the elements that
hold it. A classifier gives every block a log-odds of being content: what its ancestors are (article,
navigation, comments, ...), its length, its share of link text, its closing punctuation and its tag. In
the graph of a page these costs are the capacities to the two terminals; smoothness edges join blocks
that follow each other, more strongly inside one element, and join every block with its element and
elements with their parents, so that blocks close in the DOM prefer one side. The maximum flow
separates them; blocks on the source side are the text. Where several cuts cost the same, the one
with the least content is taken.

`pages` have no labels to train on, so the log-odds are fixed (below); the operator looks at one page at
a time and needs no shuffle.

Edge cases: a null or empty page, and one without content, gives an empty text; tags that are never
closed end with their parent or the page, a tag or comment cut by the end of the page is dropped; text in
elements that show none (script, style, head, template, ...) or hold controls is never text; references
without a semicolon are decoded as browsers do; all Unicode white space counts as white space. Pages are
read whole, whatever their length or depth, in time that grows with their number of blocks. Rows that
repeat are pages of their own. Extra columns stay; ``_h_text`` and ``_h_chars`` are replaced.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import map_arrow

# HTML elements by what they do to the text around them.
GROUPS = frozenset("address article aside blockquote body center details dialog dir div dl fieldset figure footer form header hgroup html main menu nav ol section table tbody tfoot thead tr ul".split())
LINES = frozenset("caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary td th".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("audio button canvas datalist head noscript object select svg template video".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}

# The classifier's log-odds, in hundredths.
TAGS = {"article": 600, "main": 400, "header": -300, "form": -400, "nav": -900, "aside": -900, "footer": -900, "dialog": -900, "menu": -900}
LASTING = frozenset("nav aside footer dialog menu".split())  # article or main inside them change nothing
ROLES = {"main": 400, "article": 600, "navigation": -900, "banner": -300, "contentinfo": -900, "complementary": -900, "search": -900, "form": -400,
         "dialog": -900, "alertdialog": -900, "alert": -900, "menu": -900, "menubar": -900, "toolbar": -900}
GOOD = frozenset("article articlebody content entry main post postcontent story text".split())
BAD = frozenset("ad ads advert advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent copyright "
                "disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup "
                "promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
                "subscription teaser toolbar topbar widget".split())
STATES = frozenset("has no with without is not show hide open closed active enabled disabled".split())
GOOD_NAME, BAD_NAME, HIDDEN = 250, -900, -900
BASE, PER_CHAR, MOST_CHARS, LINK, SENTENCE, RIGHTS = -80, 1, 400, -400, 60, -300
LINE_TAGS = {"p": 50, "h1": 60, "h2": 40, "h3": 40, "pre": 40, "li": -40, "td": -30, "th": -30}
# Smoothness, in the same unit.
NEXT_SAME, NEXT_NEAR, NEXT_FAR, BLOCK_GROUP, GROUP_GROUP = 100, 50, 20, 60, 40

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)*+>""")
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_ENDS = tuple(".!?…:;\"'”’»)。！？")


@dataclass(slots=True)
class Element:
    tag: str
    group: int       # number of the element of GROUPS that holds the text
    odds: int        # what it and its ancestors say about the text, in hundredths
    lasting: bool    # boilerplate whatever stands inside
    unseen: bool
    line: str        # tag of the line the text is in


@dataclass(slots=True)
class Block:
    text: str
    group: int
    odds: int


def _named(names: str) -> int:
    """The log-odds of an element's class or id."""
    good = 0
    for name in names.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in STATES or words[-1] in STATES or STATES & set(words) & {"with", "without", "has", "no"}:
            continue
        if any(w in BAD for w in words):
            return BAD_NAME
        if any(w in GOOD for w in words) or "".join(words) in GOOD:
            good = GOOD_NAME
    return good


def _element(tag: str, attrs: str, up: Element, group: int) -> Element:
    odds, lasting = TAGS.get(tag, 0), tag in LASTING
    if tag == "header" and up.odds > 0:
        odds = 0  # the heading of an article
    if attrs and tag not in ("html", "body"):
        for name, *value in _ATTR.findall(attrs):
            value = unescape("".join(value))
            name = name.lower()
            if name in ("class", "id"):
                found = _named(value)
                if found < 0 and tag in ("article", "main") and "comment" not in value.lower():
                    found = 0
            elif name == "role":
                found = ROLES.get(value.strip().lower(), 0)
            elif name == "style":
                found = HIDDEN if _NO_DISPLAY.search(value) else 0
            else:
                found = HIDDEN if value.lower() != "false" else 0
            odds = min(odds, found) if found < 0 else max(odds, found) if odds >= 0 else odds
    lasting = lasting or odds <= -900
    if up.lasting:
        odds, lasting = min(up.odds, odds), True
    elif odds == 0:
        odds = up.odds
    return Element(tag, group, odds, lasting, up.unseen or tag in UNSEEN, tag if tag in LINES else up.line if tag not in GROUPS else "")


def _odds(text: str, linked: float, at: Element) -> int:
    n = len(text)
    out = at.odds + BASE + PER_CHAR * min(n, MOST_CHARS) + int(LINK * linked) + LINE_TAGS.get(at.line, 0)
    if text.endswith(_ENDS):
        out += SENTENCE
    if n < 300 and "©" in text:
        out += RIGHTS
    return min(out, -600) if at.lasting else out


def blocks(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page in order, and the parent of every group element (the root's is itself)."""
    found: list[Block] = []
    parents = [0]
    stack = [Element("", 0, 0, False, False, "")]
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    sizes = [0, 0]  # characters of the block, of its links
    link = False

    def text(raw: str) -> None:
        if raw and not stack[-1].unseen:
            raw = unescape(raw) if "&" in raw else raw
            parts.append(raw)
            sizes[0] += len(raw)
            sizes[1] += len(raw) if link else 0

    def flush() -> None:
        if parts:
            whole = " ".join("".join(parts).split())
            if whole:
                at = stack[-1]
                found.append(Block(whole, at.group, _odds(whole, sizes[1] / sizes[0], at)))
            parts.clear()
            sizes[:] = [0, 0]

    def push(tag: str, attrs: str) -> None:
        up = stack[-1]
        group = up.group
        if tag in GROUPS:
            parents.append(group)
            group = len(parents) - 1
        stack.append(_element(tag, attrs, up, group))
        open_tags[tag] = open_tags.get(tag, 0) + 1

    def pop() -> None:
        open_tags[stack.pop().tag] -= 1

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        if m[1]:
            close = page.find("-->", m.start() + 2)
            at = close + 3 if close >= 0 else end
            continue
        if m[2]:
            close = page.find(">", m.end())
            at = close + 1 if close >= 0 else end
            continue
        rest = _REST.match(page, m.end())
        if rest is None:
            break  # cut by the end of the page
        at, tag, attrs = rest.end(), m[4].lower(), rest[0][:-1]
        block = tag in GROUPS or tag in LINES
        if m[3]:
            if block:
                flush()
            if tag == "a":
                link = False
            elif open_tags.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
                if block:
                    link = False
            continue
        if open_tags.get("head") and tag not in IN_HEAD:
            while stack[-1].tag != "head":
                pop()
            pop()
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
        elif tag == "a":
            link = True
        elif tag in ("br", "img", "wbr"):
            text(" " if tag == "br" else "")
        elif tag == "hr":
            flush()
        elif block or tag in UNSEEN:
            if block:
                flush()
                if stack[-1].tag in CLOSES.get(tag, ("p",)):
                    pop()
            if not (attrs.endswith("/") and tag == "svg"):
                push(tag, attrs)
    flush()
    return found, parents


def min_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source: node i has an edge of capacity ``odds[i]`` from the source, or of
    ``-odds[i]`` to the sink, and ``edges`` (a, b, capacity) hold in both directions. The maximum flow is
    found phase by phase over shortest paths."""
    n = len(odds)
    source, sink = n, n + 1
    to, cap, out = [], [], [[] for _ in range(n + 2)]

    def arc(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forth)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, c in enumerate(odds):
        if c > 0:
            arc(source, i, c, 0)
        elif c < 0:
            arc(i, sink, -c, 0)
    for a, b, c in edges:
        arc(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                v = to[e]
                if cap[e] and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if not cap[e])
                u = to[path[first] ^ 1]
                del path[first:]
                continue
            own = out[u]
            while at[u] < len(own) and not (cap[own[at[u]]] and level[to[own[at[u]]]] == level[u] + 1):
                at[u] += 1
            if at[u] < len(own):
                path.append(own[at[u]])
                u = to[own[at[u]]]
            elif u == source:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]
                at[u] += 1


def graph(found: list[Block], parents: list[int]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminal capacities and smoothness edges: the blocks first, then the groups that hold any."""
    odds = [b.odds for b in found]
    node: dict[int, int] = {}
    edges = []
    for i, b in enumerate(found):
        g, new = b.group, None
        while g not in node:
            node[g] = len(odds)
            odds.append(0)
            if new is not None:
                edges.append((new, node[g], GROUP_GROUP))
            new = node[g]
            if parents[g] == g:
                new = None
                break
            g = parents[g]
        if new is not None:
            edges.append((new, node[g], GROUP_GROUP))
        edges.append((i, node[b.group], BLOCK_GROUP))
        if i:
            a = found[i - 1].group
            near = a == parents[b.group] or b.group == parents[a] or parents[a] == parents[b.group]
            edges.append((i - 1, i, NEXT_SAME if a == b.group else NEXT_NEAR if near else NEXT_FAR))
    return odds, edges


def main_text(page: str | None) -> str:
    found, parents = blocks(page or "")
    if not any(b.odds > 0 for b in found):
        return ""
    side = min_cut(*graph(found, parents))
    return " ".join(b.text for b, content in zip(found, side, strict=False) if content)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without their markup, with ``_h_text`` (the main text) and ``_h_chars`` (its code points)."""
    rows = pages.drop("_h_text", "_h_chars")
    others = [c for c in rows.columns if c != html]
    rows = rows.select(*[f"`{c}`" for c in others], rows[html].cast("string").alias("_h_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(x) for x in part.column(len(others)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=[*others, "_h_text", "_h_chars"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_h_text", T.StringType()), T.StructField("_h_chars", T.LongType())])
    return map_arrow(rows, run, schema)
