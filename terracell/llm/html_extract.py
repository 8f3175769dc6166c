"""Main text of HTML pages by minimum-cut labelling of their blocks.

A tolerant scan of tags cuts a page into blocks of text, each with its place in the tree of
elements. What a block's words look like (length, share of links, how it ends, headings and list
items) becomes the cost of calling it content or boilerplate; an element that opens a region, such as an article or
a menu, is a node too, with the cost of calling the region so. These are the terminal capacities.
Smoothness edges join each block to its region, neighbours in page order, the stronger the
nearer they are in the tree, and neighbours in one container. The minimum cut is the labelling
of least cost: a line that looks like boilerplate by itself stays with the article around it, a
long sentence in a footer goes with the footer, and a region that its name calls a sidebar is content
after all if enough of its text is. Nodes whose own cost outweighs all their
edges keep their side in any minimum cut and are settled first; maximum flow (Dinic) labels
what is left. All costs are log-odds.

The classifier of words is a logistic regression, fitted on blocks whose side their elements tell:
those in article or main against those in nav, header, footer or aside. It takes at most about
``pages`` pages by a hash of their html and ``blocks`` evenly spaced labelled blocks of each, both
parameters of ``fit``, and leans on fixed weights, which stand where nothing can be learned.

Regions: article and main hold content; nav, footer, aside, dialogs, hidden elements and names
such as comments, cookie or share lead away from it, whatever stands around them or in them;
names of layout such as sidebar or menu do so too, and forms and page headers, until an article
or main begins inside. Names are whole words of class and id; role, hidden, aria-hidden and
style count as attributes of just that name.

Edge cases: null or empty html gives empty text; markup that is cut off or badly nested is read
as far as it goes; pages of any length are read whole; a page without content blocks has an
empty text; ties go to boilerplate; repeated rows are pages of their own; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from html import unescape
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea iframe svg math object select title canvas audio video".split()
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset(("button", "option", "body", "html"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# Where elements, roles and names lead. LAYOUT ends where an article or main begins.
NONE, CONTENT, LAYOUT, AWAY = range(4)
ELEMENTS = dict.fromkeys(("article", "main"), CONTENT) | dict.fromkeys(("nav", "footer", "aside", "button", "menu", "dialog", "head", "label"), AWAY) | dict.fromkeys(("form", "fieldset"), LAYOUT)
ROLES = dict.fromkeys(("main", "article"), CONTENT) | dict.fromkeys(("navigation", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"), AWAY) | dict.fromkeys(("banner", "form"), LAYOUT)
NAMES = dict.fromkeys("ad ads adv advert adverts advertisement sponsor sponsored promo cookie cookies consent gdpr popup modal newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments reply replies respond disqus copyright hidden".split(), AWAY) | dict.fromkeys("nav navbar navigation menu menus header masthead topbar footer foot sidebar aside banner notice notices alert search widget widgets toolbar legal form".split(), LAYOUT)

# Log-odds of content: of a region, what it is worth to each block in it, what words say before anything is learned, and what neighbours are worth.
REGION, IN_REGION = {CONTENT: 1e9, LAYOUT: -12.0, AWAY: -1e9}, {CONTENT: 3.5, LAYOUT: 5.0, AWAY: 12.0}
PRIOR = (-3.5, 0.6, -5.0, 1.0, 1.5, -0.5)  # one, log2 of the length, share of links, ends a sentence, heading, list item
TRUST, MOST_ODDS = 5.0, 4.0
NEXT, SIBLING, ACROSS = 1.5, 1.0, 0.2
PAGES, BLOCKS = 1000, 64

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^>]*+(?:>.*?(?:</\1\b[^>]*>|\Z)|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>|[^>]*+(?:>|\Z))",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I).search
_ENDS = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"'\u00bb\u201c\u201d\u2019)\]]*$").search


class Block:
    """Text, how much of it is linked, its element, the element's container, the region and the element that opens it."""

    __slots__ = ("container", "element", "kind", "links", "opener", "region", "side", "text")

    def __init__(self, text: str, links: int, element: int, container: int, kind: str, region: int, opener: int, side: int):
        self.text, self.links, self.element, self.container, self.kind, self.region, self.opener, self.side = text, links, element, container, kind, region, opener, side

    def features(self) -> tuple[float, ...]:
        n = len(self.text)
        return (1.0, log2(1 + n), min(1.0, self.links / n), float(bool(_ENDS(self.text))), float(self.kind in HEADINGS), float(self.kind == "li"))


def region_of(tag: str, attributes: str, around: int) -> int:
    """The region that an element opens inside another."""
    found = ELEMENTS.get(tag, NONE)
    if tag == "header" and around != CONTENT:
        found = LAYOUT
    if tag not in ("body", "html") and len(attributes) > 5:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            now = NONE
            if name in ("class", "id"):
                kinds = [NAMES.get(w.lower(), NONE) for w in _WORDS(value)]
                # inside an article a header or a form's name is the article's own
                now = AWAY if AWAY in kinds else LAYOUT if LAYOUT in kinds and around != CONTENT and found != CONTENT else LAYOUT if {w.lower() for w in _WORDS(value)} & {"nav", "navigation", "menu", "sidebar", "aside", "widget", "footer"} and tag not in ("article", "main") and around == CONTENT else NONE
            elif name == "role":
                now = ROLES.get(value.lower(), NONE)
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _UNSEEN(value)):
                now = AWAY
            found = max(found, now)
    if around == AWAY or found == NONE:
        return around
    if around == LAYOUT and found != CONTENT:
        return max(around, found)
    return found


def scan(html: str) -> tuple[list[Block], list[int]]:
    """The page's blocks of text in order, and the parent of each element."""
    out: list[Block] = []
    parents = [0]
    # open elements: (tag, number, region, its opener, side that the element itself tells: 1 content, -1 not, 0 unknown)
    stack: list[tuple[str, int, int, int, int]] = [("", 0, NONE, 0, 0)]
    text: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                at = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK or not k)
                tag, element, region, opener, side = stack[at]
                up = next((k for k in range(at - 1, -1, -1) if stack[k][0] in BLOCK or not k), 0)
                out.append(Block(joined, linked, element, stack[up][1], tag, region, opener, side))
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            said = unescape(raw) if "&" in raw else raw
            text.append(said)
            if in_link:
                linked += len(said.strip())

    at = 0
    for m in _TAG.finditer(html):
        say(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if tag == "a":
                in_link = 0
            deep = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag in BLOCK:
                flush()
            if deep:
                del stack[deep:]
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                open_p = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p"), 0)
                if open_p and not any(e[0] in BLOCK for e in stack[open_p + 1 :]):
                    del stack[open_p:]
            if tag == "li" and stack[-1][0] == "li":
                stack.pop()
        if tag in VOID:
            continue
        if tag == "a":
            in_link = 1
        _, up, around, opener, side = stack[-1]
        told = {CONTENT: 1, AWAY: -1}.get(ELEMENTS.get(tag), -1 if tag == "header" and around != CONTENT else 0)
        parents.append(up)
        region = region_of(tag, m[4], around)
        stack.append((tag, len(parents) - 1, region, opener if region == around else len(parents) - 1, told if told and side >= 0 else side))
    say(html[at:])
    flush()
    return out, parents


def steps(a: int, b: int, parents: list[int], most: int = 12) -> int:
    """Steps between two elements through the tree, at most ``most``; an element's number is above its parent's."""
    n = 0
    while a != b and n < most:
        if a > b:
            a = parents[a]
        else:
            b = parents[b]
        n += 1
    return n


def graph(found: list[Block], parents: list[int], weights: np.ndarray) -> tuple[list[float], dict[int, dict[int, float]]]:
    """Costs of the blocks and, behind them, of their regions; and the edges: of blocks with their region,
    between neighbours in page order, by their distance in the tree, and between neighbours in one container.
    Neighbours of one region are those without regard to what stands between; across regions an edge is worth little."""
    own, regions = odds(found, weights), {b.opener: b.region for b in found if b.region}
    place = {opener: len(found) + k for k, opener in enumerate(regions)}
    own += [REGION[r] for r in regions.values()]
    edges: dict[int, dict[int, float]] = {i: {} for i in range(len(own))}

    def join(i: int, j: int, w: float) -> None:
        edges[i][j] = edges[j][i] = edges[i].get(j, 0.0) + w

    near = lambda i, j: NEXT / max(1, steps(found[i].element, found[j].element, parents) - 1)
    beside: dict[tuple[int, int], int] = {}  # the last block of a container, and of a region
    before: dict[int, int] = {}
    for i, b in enumerate(found):
        if i and found[i - 1].opener != b.opener:
            join(i - 1, i, ACROSS * near(i - 1, i))
        if (j := before.get(b.opener)) is not None:
            join(j, i, near(j, i))
        if (j := beside.get((b.container, b.opener))) is not None:
            join(j, i, SIBLING)
        before[b.opener] = beside[b.container, b.opener] = i
        if b.region:
            join(i, place[b.opener], IN_REGION[b.region])
    return own, edges


def odds(found: list[Block], weights: np.ndarray) -> list[float]:
    """Log-odds of content of each block's words."""
    return np.clip(np.array([b.features() for b in found]) @ weights, -MOST_ODDS, MOST_ODDS).tolist()


def min_cut(scores: list[float], edges: dict[int, dict[int, float]]) -> list[bool]:
    """True for content: least sum of the scores' costs and the edges that are cut."""
    own, side = list(scores), [None] * len(scores)
    weight = {i: sum(e.values()) for i, e in edges.items()}
    todo = deque(range(len(scores)))
    while todo:  # settle what its edges cannot turn
        i = todo.popleft()
        if side[i] is None and abs(own[i]) >= weight[i] - 1e-12:
            side[i] = own[i] > 0
            for j, w in edges[i].items():
                if side[j] is None:
                    own[j] += w if side[i] else -w
                    weight[j] -= w
                    todo.append(j)
    rest = [i for i, s in enumerate(side) if s is None]
    if rest:
        for i, s in zip(rest, flow_labels([own[i] for i in rest], [{rest_at: w for j, w in edges[i].items() if (rest_at := _at(rest, j)) is not None} for i in rest]), strict=True):
            side[i] = s
    return side  # type: ignore[return-value]


def _at(rest: list[int], j: int) -> int | None:
    k = bisect_left(rest, j)
    return k if k < len(rest) and rest[k] == j else None


def flow_labels(scores: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """The source side of a minimum cut, by Dinic's maximum flow; positive scores hang on the source."""
    n = len(scores)
    s, t, tiny = n, n + 1, 1e-12
    cap: list[dict[int, float]] = [dict(e) for e in edges] + [{}, {}]
    for i, x in enumerate(scores):
        a, b = (s, i) if x > 0 else (i, t)
        cap[a][b] = cap[a].get(b, 0.0) + abs(x)
        cap[b].setdefault(a, 0.0)
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            return [i in level for i in range(n)]
        turns = [iter(list(e)) for e in cap]
        path = [s]
        while path:
            u = path[-1]
            if u == t:
                amount = min(cap[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    cap[a][b] -= amount
                    cap[b][a] = cap[b].get(a, 0.0) + amount
                short = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if cap[a][b] <= tiny)
                del path[short + 1 :]
                turns[path[-1]] = iter(list(cap[path[-1]]))
                continue
            step = next((v for v in turns[u] if cap[u][v] > tiny and level.get(v) == level[u] + 1), None)
            if step is None:
                level[u] = -1
                path.pop()
            else:
                path.append(step)


def main_text(html: str | None, weights: np.ndarray) -> str:
    found, parents = scan(html or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, min_cut(*graph(found, parents, weights)), strict=False) if keep)


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, both sides weighing alike, with a Gaussian prior around PRIOR."""
    w = prior = np.array(PRIOR)
    if not len(y) or y.min() == y.max():
        return w
    share = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    for _ in range(25):
        odds = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (odds - y)) + TRUST * (w - prior)
        bend = (x * (share * odds * (1 - odds))[:, None]).T @ x + TRUST * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(pages: DataFrame, pages_: int = PAGES, blocks: int = BLOCKS) -> np.ndarray:
    """Weights of the classifier of words, from at most about ``pages_`` pages and ``blocks`` labelled blocks of each."""
    usable = pages.where("html is not null and html <> ''")
    share = min(1.0, pages_ / max(1, usable.count()))
    drawn = usable.select("html").where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html in batch.column(0):
                told = [b for b in scan(html.as_py())[0] if b.side]
                out += [[*told[i * len(told) // blocks if len(told) > blocks else i].features(), float(told[i * len(told) // blocks if len(told) > blocks else i].side > 0)] for i in range(min(len(told), blocks))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64()))], ["x"])

    rows = np.array(sorted(r[0] for r in drawn.mapInArrow(run, "x array<double>").collect())).reshape(-1, len(PRIOR) + 1)  # the sample
    return regression(rows[:, :-1], rows[:, -1])


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Per row of (page_id, url, html): page_id, url, text, n_chars; by weights of ``fit``, on these pages if none are given."""
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    weights = fit(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), weights) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
