"""HTML extraction by minimum-cut labelling.

A page is cut into text blocks. A linear classifier over a block's element, ancestors, class names, length, punctuation
and link share gives its terminal capacities; neighbours in page order and near relatives in the DOM are tied by
smoothness edges. The minimum cut (equal to the maximum flow) labels each block content or boilerplate at the least total
cost.

The classifier is a logistic regression that the driver fits on pages composed by `mincut_training` from many layouts, a
few thousand labelled blocks; only its weights, of a fixed number, go to the executors. Class names are evidence, never a
verdict: they count where they name a part of the page, not on `html` or `body`, not on an element that holds nearly all of
the page's text and its article, and not where they tell a state (`with-sidebar`, `cookie-ok`, `comments-open`).

Blocks whose terminal capacity outweighs all their edges keep their label in any minimum cut; they are settled first and
their edges folded into their neighbours', and the flow is computed on what is left. Each page is handled alone.

Defined cases: null html counts as empty; a page without content blocks has an empty text. Character references are
decoded, white space within a block becomes one space, blocks are joined by a line feed. Malformed markup is read as
`html.parser` does, with implied ends of the head, paragraphs, items and cells; its cost is linear in the page. Repeated
rows give repeated results; extra columns are carried in a struct of their own, so clashing names do no harm.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import mincut_training
from corpusloom.llm.common import arrow_scan, table

# HTML elements by their part in a page.
BLOCKS = frozenset([
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
])
HIDDEN = frozenset([
    "audio", "button", "canvas", "datalist", "head", "iframe", "map", "math", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title", "video",
])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
IN_HEAD = frozenset(["base", "link", "meta", "noscript", "script", "style", "template", "title"])
#: Elements that an opening tag ends, if open within the nearest of BOUNDS.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BOUNDS = frozenset(["article", "aside", "body", "div", "dl", "footer", "form", "header", "html", "main", "menu", "nav", "ol", "section", "table", "ul"])

#: What tags, roles and words of class names say of the part of a page they stand for.
PARTS = {
    "nav": "navigation", "menu": "navigation", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form", "dialog": "dialog", "header": "head", "article": "article",
    "main": "main", "address": "address",
}
ROLES = {
    "navigation": "navigation", "banner": "head", "contentinfo": "foot", "complementary": "side", "search": "form", "form": "form", "dialog": "dialog", "alertdialog": "dialog",
    "main": "main", "article": "article",
}
NAMES = {
    "named-ad": ["ad", "ads", "adv", "advert", "advertisement", "advertising", "adsense", "adslot", "banner", "sponsor", "sponsored", "promo", "promoted", "promotion", "outbrain", "taboola"],
    "named-comment": ["comment", "comments", "commentary", "commentlist", "disqus", "respond", "response", "responses", "reply", "replies", "discussion", "feedback", "reviews", "guestbook"],
    "named-notice": ["cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "overlay", "alert", "paywall", "disclaimer"],
    "named-form": ["newsletter", "subscribe", "subscription", "signup", "login", "search", "form", "register"],
    "named-navigation": ["nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "topbar", "toc", "skip"],
    "named-side": ["side", "sidebar", "rail", "widget", "widgets", "related", "recommend", "recommended", "recommendations", "trending", "popular", "teaser", "tags", "share", "sharing", "social"],
    "named-foot": ["footer", "foot", "copyright", "legal", "imprint", "colophon"],
    "named-head": ["header", "head", "masthead", "logo", "brand"],
    "named-content": ["article", "content", "post", "entry", "story", "body", "text", "main", "prose", "page"],
}
_PART_OF_NAME = {word: part for part, words in NAMES.items() for word in words}
#: A class word with one of these tells a state of the element, or a topic, not its part.
STATES = frozenset([
    "allowed", "accepted", "category", "closed", "disabled", "dismissed", "enabled", "format", "has", "is", "no", "not", "off", "ok", "on", "open", "single", "status", "tag", "template", "type", "with", "without",
])
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
#: An element with this share of the page's text, and any article and main element in it, says nothing by its class names.
WHOLE = 0.9
#: An article or main element with this share of the text casts doubt on what is outside.
CHIEF = 0.25

LENGTHS = (15, 40, 80, 160, 320)
LINKED = (0.0, 0.2, 0.5, 0.9)
OWNERS = {"p": "p", "h1": "h1", "h2": "h2", "h3": "h2", "h4": "h2", "h5": "h2", "h6": "h2", "li": "li", "dd": "li", "dt": "li", "td": "td", "th": "td", "caption": "td", "pre": "pre", "blockquote": "pre", "figcaption": "caption"}
FEATURES = [
    *dict.fromkeys([*PARTS.values(), *ROLES.values()]), *NAMES, *(f"owner-{o}" for o in (*dict.fromkeys(OWNERS.values()), "other")), *(f"length-{k}" for k in range(len(LENGTHS) + 1)),
    *(f"linked-{k}" for k in range(len(LINKED) + 1)), "ends", "sentences", "commas", "marks", "outside", "head-inside",
]
NUMBER = {name: i for i, name in enumerate(FEATURES)}
#: Cost units of one unit of log odds, the largest edge, and the largest cost of a block.
SCALE, NEAR, MOST = 12, 18, 120


class _Element:
    __slots__ = ("tag", "parent", "depth", "block", "part", "names", "hidden", "link", "chars", "chiefs", "inline")

    def __init__(self, tag: str, parent: _Element | None, part: str | None, names: frozenset, hidden: bool, link: bool):
        self.tag, self.parent, self.part, self.names, self.hidden, self.link = tag, parent, part, names, hidden, link
        self.depth = parent.depth + 1 if parent else 0
        self.block: _Element = self if parent is None or tag in BLOCKS else parent.block
        self.chars = self.chiefs = 0
        self.inline: dict[str, int] = {}  # inline elements open right within a block


class Block:
    __slots__ = ("text", "owner", "links")

    def __init__(self, text: str, owner: _Element, links: int):
        self.text, self.owner, self.links = text, owner, links


@lru_cache(10_000)
def named_parts(value: str) -> frozenset:
    """The parts of a page that an element's class or id names."""
    found = set()
    for word in value.split():
        pieces = [p.lower() for p in _SPLIT.split(word) if p]
        if not STATES.intersection(pieces):
            found.update(_PART_OF_NAME[p] for p in pieces if p in _PART_OF_NAME)
    return frozenset(found)


_NONE: frozenset = frozenset()


class _Blocks(HTMLParser):
    """Collects the text blocks of a page with their DOM element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = _Element("", None, None, _NONE, False, False)
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.buffer: list[str] = []
        self.links = 0
        self.owner = self.at

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.blocks.append(Block(text, self.owner, self.links))
            self.buffer, self.links = [], 0

    def pop_to(self, element: _Element) -> None:
        while self.at is not element:
            self.open[self.at.tag] -= 1
            if self.at.block is not self.at:
                self.at.block.inline[self.at.tag] -= 1
            self.at = self.at.parent

    def nearest(self, tags: frozenset | set) -> _Element | None:
        e = self.at.block
        while e.parent is not None:
            if e.tag in tags:
                return e
            if e.tag in BOUNDS:
                return None
            e = e.parent.block
        return None

    def end_head(self) -> None:
        if self.open.get("head"):
            e = self.at
            while e.tag != "head":
                e = e.parent
            self.pop_to(e.parent)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD and self.open.get("head") and self.at.tag == "head":
            self.end_head()
        if tag in BLOCKS:
            self.flush()
            if self.open.get("p") and tag not in ("html", "body") and (p := self.nearest({"p"})):
                self.pop_to(p.parent)
            if tag in ENDS and any(self.open.get(t) for t in ENDS[tag]) and (e := self.nearest(ENDS[tag])):
                self.pop_to(e.parent)
        elif tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        part, names, hidden = PARTS.get(tag), _NONE, self.at.hidden or tag in HIDDEN
        for name, value in attrs:
            if name in ("class", "id") and value and tag not in ("html", "body"):
                names |= named_parts(value)
            elif name == "role" and value:
                part = ROLES.get(value.lower(), part)
            elif name == "hidden" or name == "style" and value and "display:none" in value.replace(" ", "").lower():
                hidden = True
        self.at = _Element(tag, self.at, part, names, hidden, self.at.link or tag == "a")
        self.open[tag] = self.open.get(tag, 0) + 1
        if self.at.block is not self.at:
            inline = self.at.block.inline
            inline[tag] = inline.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and self.at.tag == tag and tag in ("svg", "math"):
            self.pop_to(self.at.parent)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
            found = self.open.get(tag)
        else:  # an inline end tag ends nothing outside its block, but what hides text ends wherever it began
            found = self.open.get(tag) if tag in HIDDEN else self.at.block.inline.get(tag)
        if found:
            e = self.at
            while e.tag != tag:
                e = e.parent
            self.pop_to(e.parent)

    def handle_data(self, data: str) -> None:
        if self.at.tag == "head" and data.strip():
            self.end_head()
        if self.at.hidden:
            return
        if not self.buffer:
            self.owner = self.at.block
        self.buffer.append(data)
        if self.at.link:
            self.links += len(data.strip())


def blocks_of(html: str) -> list[Block]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.blocks


class Page:
    """The blocks of a page, and what their ancestors say of them."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks
        self.known: dict[int, frozenset] = {}
        self.total = sum(len(b.text) for b in blocks)
        elements: dict[int, _Element] = {}
        for b in blocks:
            b.owner.chars += len(b.text)
            e = b.owner
            while e is not None and id(e) not in elements:
                elements[id(e)] = e
                e = e.parent
        listed = sorted(elements.values(), key=lambda e: -e.depth)
        for e in listed:
            e.chiefs += e.part in ("article", "main")
            if e.parent is not None:
                e.parent.chars += e.chars
                e.parent.chiefs += e.chiefs
        chiefs = listed[-1].chiefs if listed else 0
        self.chief = any(e.part in ("article", "main") and e.chars >= CHIEF * self.total for e in listed)
        for e in reversed(listed):  # parents first: what is known of a parent holds for its children
            above = self.known[id(e.parent)] if e.parent is not None else _NONE
            # what holds the whole page, its article included, says nothing of its blocks: a form, header or dialog round all
            whole = e.chars >= WHOLE * self.total and e.chiefs == chiefs
            own = {e.part} if e.part and (not whole or e.part in ("article", "main")) else set()
            if e.names and not whole:
                own |= e.names
            if e.part == "head" and ("article" in above or "main" in above):
                own = own - {"head"} | {"head-inside"}
            self.known[id(e)] = above | own if own else above

    def features(self, b: Block) -> list[int]:
        """Numbers of the features that a block has."""
        text, n = b.text, len(b.text)
        said = self.known[id(b.owner)]
        share = min(1.0, b.links / n)
        out = [NUMBER[s] for s in said]
        out.append(NUMBER["owner-" + OWNERS.get(b.owner.tag, "other")])
        out.append(NUMBER["length-0"] + sum(n > x for x in LENGTHS))
        out.append(NUMBER["linked-0"] + sum(share > x for x in LINKED))
        if text[-1] in ".!?…»”\"')。！？":
            out.append(NUMBER["ends"])
        if ". " in text or "? " in text or "! " in text:
            out.append(NUMBER["sentences"])
        if "," in text:
            out.append(NUMBER["commas"])
        if "©" in text or "|" in text or "›" in text or "·" in text:
            out.append(NUMBER["marks"])
        if self.chief and "article" not in said and "main" not in said:
            out.append(NUMBER["outside"])
        return out


def fitted(pages: list[str], l2: float = 0.7, steps: int = 25) -> list[float]:
    """Log odds of each feature and, last, of none: logistic regression by Newton steps on marked blocks.

    A block of a training page is content if it begins with `mincut_training.MARK`, which is not part of its text.
    """
    seen: dict[tuple[int, ...], list[int]] = {}
    for html in pages:
        blocks, content = [], []
        for b in blocks_of(html):
            marked, b.text = b.text.startswith(mincut_training.MARK), b.text.replace(mincut_training.MARK, "").strip()
            if b.text:
                blocks.append(b)
                content.append(marked)
        page = Page(blocks)
        for b, marked in zip(blocks, content):
            seen.setdefault(tuple(sorted(page.features(b))), [0, 0])[marked] += 1
    x = np.zeros((len(seen), len(FEATURES) + 1))
    x[:, -1] = 1
    for i, r in enumerate(seen):
        x[i, list(r)] = 1
    no, yes = np.array(list(seen.values()), float).T
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * ((no + yes) * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ ((no + yes) * p - yes) + l2 * w)
    return w.tolist()


@lru_cache(1)
def weights() -> tuple[int, ...]:
    """The classifier's weights as whole cost units."""
    return tuple(round(SCALE * v) for v in fitted(mincut_training.pages()))


def evidence(page: Page, costs: tuple[int, ...]) -> list[int]:
    """For each block, the cost of calling it boilerplate, less that of calling it content."""
    return [max(-MOST, min(MOST, costs[-1] + sum(costs[k] for k in page.features(b)))) for b in page.blocks]


def distance(a: _Element, b: _Element, most: int = 8) -> int:
    """Steps in the DOM from one element to the other, `most` if there are as many or more."""
    steps = 0
    while a is not b and steps < most:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges between neighbours in page order and from each block to the last one under the same parent element."""
    edges, last = [], {}
    for j, b in enumerate(blocks):
        if j:
            edges.append((j - 1, j, NEAR // (2 + distance(blocks[j - 1].owner, b.owner))))
        parent = id(b.owner.parent)
        if parent in last and last[parent] < j - 1:
            edges.append((last[parent], j, NEAR // 4))
        last[parent] = j
    return [e for e in edges if e[2] > 0]


def minimum_cut(score: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for each node on the source side of a minimum cut: source capacity max(score, 0), sink capacity max(-score, 0)."""
    n = len(score)
    t, near = list(score), [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0) + c
        near[b][a] = near[b].get(a, 0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(t[i]) <= sum(near[i].values()) and near[i]:
            continue
        label[i] = t[i] > 0
        for j, c in near[i].items():
            t[j] += c if label[i] else -c
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow({x: k for k, x in enumerate(rest)}, t, near, rest)):
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(number: dict[int, int], t: list[int], near: list[dict[int, int]], rest: list[int]) -> list[bool]:
    """Dinic's algorithm; True for nodes that the source still reaches."""
    n = len(rest)
    source, sink = n, n + 1
    cap: list[dict[int, int]] = [{} for _ in range(n + 2)]
    for i in rest:
        k = number[i]
        for j, c in near[i].items():
            cap[k][number[j]] = c
        a, b = (source, k) if t[i] > 0 else (k, sink)
        cap[a][b] = abs(t[i])
        cap[b].setdefault(a, 0)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [k in level for k in range(n)]
        out = {u: list(cap[u]) for u in level}
        at = dict.fromkeys(level, 0)
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(cap[a][b] for a, b in zip(path, path[1:]))
                cut = 0
                for k, (a, b) in reversed(list(enumerate(zip(path, path[1:])))):
                    cap[a][b] -= flow
                    cap[b][a] = cap[b].get(a, 0) + flow
                    if not cap[a][b]:
                        cut = k
                path = path[: cut + 1]
                continue
            # an edge is left when it is full or leads nowhere
            while at[u] < len(out[u]) and not (cap[u][out[u][at[u]]] > 0 and level.get(out[u][at[u]]) == level[u] + 1):
                at[u] += 1
            if at[u] < len(out[u]):
                path.append(out[u][at[u]])
            else:
                path.pop()
                if path:
                    at[path[-1]] += 1


def main_text(html: str, costs: tuple[int, ...] | None = None) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    keep = minimum_cut(evidence(Page(blocks), costs or weights()), smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


RESULTS = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extracted(pages: DataFrame, carry: dict[str, Column], html: str = "html") -> DataFrame:
    """Columns `row` and `res`: text, n_chars."""
    costs = weights()

    def run(arr: pa.Array) -> list[pa.Array]:
        texts = [main_text(h, costs) for h in arr.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return arrow_scan(pages, html, carry, RESULTS, run)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"), {"page_id": F.col("page_id"), "url": F.col("url")}).select("row.*", "res.*")
