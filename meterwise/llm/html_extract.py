"""Main-text extraction by minimum-cut labelling.

A page is cut into text blocks. A logistic regression over a block's features (its
tag, link share, length, punctuation, and the menus, notices and the like that it
stands in) gives the log-odds of content, whose size is the block's capacity to the
content or the boilerplate terminal. Smoothness edges join neighbouring blocks, each
block with its container, each container with its parent, and each block with the
article or main that it stands in. An article's node has a capacity to the content
terminal that its own blocks can't outweigh; it reaches them only through edges. The
minimum cut is the labelling of least total cost; blocks on the content side are the
text.

The regression is fitted to a bounded sample of pages that have an article element:
blocks outside are boilerplate, blocks inside are content (those inside that stand under
a mark are left out), and the article itself is no feature. It starts from stated
weights, which features that the sample never shows keep.

Blocks that outweigh all their edges are settled first, which leaves the cut as
it is; the maximum flow runs on the rest.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)|<[!?][^>]*+>"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S | re.I)
#: Any attribute, so that names are read whole and never inside a value.
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: HTML elements that bound a block, and those whose text is not shown as text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul title noscript template svg iframe object select textarea button canvas audio video option""".split())
UNSHOWN = frozenset("head title noscript template svg iframe object select textarea button canvas audio video option".split())
VOID = frozenset(["hr"])
#: Elements that end an open one of the same kind.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
SIDE = frozenset(["nav", "footer", "aside", "menu", "dialog"])
#: Words in a class, id or role that mark menus, notices, adverts, comments and the like.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related
    recommended recommendations sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments
    commentlist reply replies respond disqus widget widgets toolbar search skip copyright disclaimer contentinfo complementary
    dialog alert alertdialog form toc""".split())
TOP_MARKS = frozenset(["header", "masthead", "topbar"])
#: Marks that an article's own prose may stand under: there they weigh on a block without settling it.
SOFT = frozenset("""share sharing social promo promotion form search skip toolbar widget widgets toc notice notices alert signup
    login copyright disclaimer banner""".split())
PUNCTUATION = re.compile(r"[.!?;:,]")
#: Features of a block, and the log-odds that each adds before any page is seen.
PRIOR = {"bias": 0.0, "length": 1.0, "punctuation": 0.25, "links": -3.0, "paragraph": 0.5, "heading": 0.25, "other": -1.0,
         "label": -0.5, "side": -10.0, "top": -6.0, "rights": -3.0, "mark": -10.0, "soft": -3.0}
WEIGHTS = tuple(PRIOR.values())
#: The sample's blocks together count as this many, against one unit of precision on each prior weight.
EVIDENCE = 200.0
#: Largest capacity of a block to a terminal.
CLIP = 4.0
#: Edges: neighbours in one container and in two, block and container, container and parent, block and its
#: article: more than ``CLIP``, less under soft marks, none under others.
NEXT, ACROSS, INSIDE, UP, ARTICLE, SOFT_ARTICLE = 0.8, 0.3, 0.3, 0.2, 5.0, 1.5
#: Cost of content under a mark; under a page wrapper's, for this many characters of content, and less in proportion for more.
MARK, WRAPPER = 10.0, 50
#: Share of the content's characters that must lie outside marks for all marks to count in full.
UNMARKED = 0.05


class Box:
    """An open element: what it and its ancestors say about text inside.

    ``marks`` counts the marked elements from the root down to this one, ``above``
    those of them that an article or main was opened under; ``soft`` marks are all in ``SOFT``.
    """

    __slots__ = ("tag", "parent", "index", "shown", "article", "side", "top", "marked", "soft", "marks", "above")

    def __init__(self, tag: str, parent: "Box | None", index: int, attrs: str):
        self.tag, self.parent, self.index = tag, parent, index
        self.shown = (parent is None or parent.shown) and tag not in UNSHOWN
        self.article = (parent is not None and parent.article) or tag in ("article", "main")
        self.side = parent.side if parent else False
        self.top = parent.top if parent else False
        if tag in ("article", "main"):
            self.top = False
        self.side = self.side or tag in SIDE
        self.top = self.top or (tag == "header" and not self.article)
        self.marked = tag == "form"
        self.soft = not self.marked
        if attrs and tag not in ("html", "body", "main", "article"):
            for m in ATTRIBUTE.finditer(attrs):
                name, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
                if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDDEN.search(value)):
                    self.side = True
                elif name in ("class", "id", "role"):
                    words = set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
                    self.marked = self.marked or not words.isdisjoint(MARKS)
                    self.soft = self.soft and words.isdisjoint(MARKS - SOFT)
                    self.top = self.top or (not self.article and not words.isdisjoint(TOP_MARKS))
        self.marks = (parent.marks if parent else 0) + self.marked
        self.above = self.marks if tag in ("article", "main") else parent.above if parent else 0


def page_blocks(page: str) -> list[tuple[str, Box, int]]:
    """Shown blocks of a page as (text, its box, characters inside links)."""
    root = Box("html", None, 0, "")
    box, n_boxes, links = root, 1, 0
    blocks: list[tuple[str, Box, int]] = []
    parts: list[str] = []
    in_links = 0

    def flush() -> None:
        nonlocal parts, in_links
        if parts:
            text = " ".join("".join(parts).split())
            if text and box.shown:
                blocks.append((text, box, in_links))
            parts, in_links = [], 0

    def add(raw: str) -> None:
        nonlocal in_links
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links > 0:
                in_links += len(text.strip())

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            links = max(0, links + (-1 if m["end"] else 1))
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            links = 0
            if m["end"]:
                open_ = box
                while open_ is not root and open_.tag != tag:
                    open_ = open_.parent
                if open_ is not root:
                    box = open_.parent
            elif tag not in VOID and tag != "html":
                while box is not root and (box.tag == "p" or box.tag in SIBLINGS.get(tag, ())
                                           or (box.tag == "head" and tag == "body")):
                    box = box.parent
                if not m["attrs"].endswith("/") or tag not in UNSHOWN:
                    box = Box(tag, box, n_boxes, m["attrs"])
                    n_boxes += 1
    add(page[at:])
    flush()
    return blocks


def block_features(text: str, box: Box, in_links: int) -> list[float]:
    """Values of ``PRIOR``'s features, the marks at 0; whether the block stands in an article is none of them."""
    size = len(text)
    paragraph = box.tag in ("p", "blockquote", "pre", "td", "dd")
    heading = box.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    stops = len(PUNCTUATION.findall(text))
    return [1.0, min(size / 100, 2.0), float(min(stops, 4)), min(in_links / size, 1.0), float(paragraph), float(heading),
            float(not paragraph and not heading), float(size < 25 and not stops), float(box.side), float(box.top),
            float("©" in text and size < 200), 0.0, 0.0]


def page_features(blocks: list[tuple[str, Box, int]], weights: tuple[float, ...]) -> list[list[float]]:
    """Features of a page's blocks, the marks' share of their cost included."""
    rows = [block_features(*b) for b in blocks]
    scores = [dot(weights, x) + (ARTICLE if box.article else 0.0) for x, (_, box, _) in zip(rows, blocks)]
    for x, (_, box, _), (cost, hard) in zip(rows, blocks, mark_costs(blocks, scores)):
        x[-1 if box.article and not hard and cost == MARK else -2] = cost / MARK
    return rows


def dot(weights: tuple[float, ...], x: list[float]) -> float:
    return sum(w * v for w, v in zip(weights, x) if v)


def fit_weights(pages: list[str]) -> tuple[float, ...]:
    """Weights of the block features from pages with an article element (``WEIGHTS`` if there are none).

    Newton steps to the maximum of the posterior: normal priors around ``WEIGHTS``, all
    blocks together counting as ``EVIDENCE`` observations.
    """
    rows, wanted = [], []
    for page in pages:
        blocks = page_blocks(page)
        if not any(box.article for _, box, _ in blocks):
            continue
        for x, (_, box, _) in zip(page_features(blocks, WEIGHTS), blocks):
            if not box.article or not (x[8] or x[-1] or x[-2]):
                rows.append(x)
                wanted.append(float(box.article))
    if not rows:
        return WEIGHTS
    x, y, prior = np.array(rows), np.array(wanted), np.array(WEIGHTS)
    share = EVIDENCE / len(rows)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return share * float((np.logaddexp(0, z) - y * z).sum()) + 0.5 * float(((w - prior) ** 2).sum())

    w = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = share * (x.T @ (p - y)) + w - prior
        step = np.linalg.solve(share * (x.T * (p * (1 - p))) @ x + np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def mark_costs(blocks: list[tuple[str, Box, int]], scores: list[float]) -> list[tuple[float, bool]]:
    """What the marks on the blocks' containers weigh, and whether one of full weight isn't soft.

    A mark speaks against its text only beside other text. Where nearly all content
    (blocks of a positive score, those in articles or main if there are any) has marks
    above it, the marks over the least marked content are the page's own wrappers: they
    cost nothing where an article or main is opened under them. Elsewhere, if they hold most
    of that content, their cost falls with its length. Every other mark costs ``MARK``.
    """
    if not any(box.marks for _, box, _ in blocks):
        return [(0.0, False)] * len(blocks)
    content = [(box, len(text)) for (text, box, _), score in zip(blocks, scores) if score > 0]
    if any(box.article for box, _ in content):
        content = [c for c in content if c[0].article]
    content.sort(key=lambda c: c[0].marks)
    total, outside, least = sum(n for _, n in content), 0, 0
    for box, n in content:
        outside, least = outside + n, box.marks
        if outside >= UNMARKED * total:
            break
    content = [c for c in content if c[0].marks <= least]

    boxes: dict[int, Box] = {}
    for _, box, _ in blocks:
        while box is not None and box.index not in boxes:
            boxes[box.index] = box
            box = box.parent
    order = sorted(boxes)  # a parent comes before its children
    held, over = dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for box, n in content:
        held[box.index] += n
        over[box.index] = max(over[box.index], box.above)
    for i in reversed(order):
        if boxes[i].parent is not None:
            up = boxes[i].parent.index
            held[up] += held[i]
            over[up] = max(over[up], over[i])
    most = sum(n for _, n in content) / 2
    cost: dict[int, float] = {}
    full: dict[int, bool] = {}
    hard: dict[int, bool] = {}
    for i in order:
        box = boxes[i]
        wrapper = held[i] > 0 and (over[i] >= box.marks or held[i] > most)
        full[i] = (box.parent is not None and full[box.parent.index]) or (box.marked and not wrapper)
        hard[i] = (box.parent is not None and hard[box.parent.index]) or (box.marked and not wrapper and not box.soft)
        cost[i] = 0.0 if box.parent is None or box.tag in ("article", "main") else cost[box.parent.index]
        if box.marked and wrapper:
            cost[i] += MARK * min(1.0, WRAPPER / held[i])
    return [(MARK if full[box.index] else cost[box.index], hard[box.index]) for _, box, _ in blocks]


def minimum_cut(weight: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (True: content) of least cost: |weight| for going against its sign, an edge's value for cutting it."""
    n = len(weight)
    weight = list(weight)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (u, v), w in edges.items():
        near[u][v] = near[u].get(v, 0.0) + w
        near[v][u] = near[v].get(u, 0.0) + w
    label: list[bool | None] = [None] * n
    # A node that outweighs its edges keeps its own side; its edges then weigh on its neighbours.
    queue = deque(range(n))
    while queue:
        u = queue.popleft()
        if label[u] is None and abs(weight[u]) >= sum(near[u].values()) and weight[u] != 0:
            label[u] = weight[u] > 0
            for v, w in near[u].items():
                weight[v] += w if label[u] else -w
                del near[v][u]
                queue.append(v)
            near[u] = {}
    rest = [u for u in range(n) if label[u] is None]
    if rest:
        for u, side in _max_flow(rest, weight, near).items():
            label[u] = side
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], weight: list[float], near: list[dict[int, float]]) -> dict[int, bool]:
    """Level-graph maximum flow from the content to the boilerplate terminal; True: on the content side."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {u: dict(near[u]) for u in nodes}
    room[source] = {u: weight[u] for u in nodes if weight[u] > 0}
    room[sink] = {}
    for u in nodes:
        room[u][source] = 0.0
        if weight[u] < 0:
            room[u][sink] = -weight[u]
            room[sink][u] = 0.0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > 1e-9 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return {u: u in level for u in nodes}
        ways = {u: iter(list(room[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                cut = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= 1e-9)
                # The arc before the cut may carry more: go back to its start and try it again.
                del path[cut + 1:]
                continue
            for v in ways[u]:
                if room[u][v] > 1e-9 and level.get(v, -1) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()


def page_graph(blocks: list[tuple[str, Box, int]], weights: tuple[float, ...] = WEIGHTS,
               ) -> tuple[list[float], dict[tuple[int, int], float]]:
    """Terminal weights of blocks, then of their containers, and smoothness edges."""
    rows = page_features(blocks, weights)
    weight = [max(-CLIP, min(CLIP, dot(weights, x))) for x in rows]
    edges: dict[tuple[int, int], float] = {}
    for i in range(len(blocks) - 1):
        same = blocks[i][1].parent is blocks[i + 1][1].parent
        edges[i, i + 1] = NEXT if same else ACROSS
    at: dict[int, int] = {}

    def node(box: Box) -> int:
        fresh = []
        while box.index not in at:
            at[box.index] = len(weight)
            weight.append(0.0)
            fresh.append(box)
            if box.parent is None:
                break
            box = box.parent
        for b in fresh:
            if b.parent is not None:
                edges[at[b.index], at[b.parent.index]] = UP
        return at[fresh[0].index] if fresh else at[box.index]

    owner: dict[int, Box | None] = {}  # a container's article or main

    def article(box: Box | None) -> Box | None:
        path = []
        while box is not None and box.index not in owner and box.tag not in ("article", "main"):
            path.append(box.index)
            box = box.parent
        found = box if box is None or box.tag in ("article", "main") else owner[box.index]
        for i in path:
            owner[i] = found
        return found

    for i, (x, (_, box, _)) in enumerate(zip(rows, blocks)):
        up = node(box.parent or box)
        edges[i, up] = INSIDE
        if box.article and not box.side and x[-2] < 1:
            near = SOFT_ARTICLE if x[-1] else ARTICLE
            own = node(article(box))
            edges[i, own] = near + (INSIDE if own == up else 0.0)
            weight[own] += near
    return weight, edges


def label_blocks(blocks: list[tuple[str, Box, int]], weights: tuple[float, ...] = WEIGHTS) -> tuple[list[bool], int]:
    """Whether each block is content, and for how many the cut differs from the classifier alone."""
    weight, edges = page_graph(blocks, weights)
    labels = minimum_cut(weight, edges)[:len(blocks)]
    return labels, sum(content != (w > 0) for content, w in zip(labels, weight))


def extract_page(page: str | None, weights: tuple[float, ...] = WEIGHTS) -> tuple[str, int, int]:
    """The main text of a page (content blocks in order, joined by an empty line), its blocks, and those the cut turned."""
    blocks = page_blocks(page or "")
    if not blocks:
        return "", 0, 0
    labels, turned = label_blocks(blocks, weights)
    return "\n\n".join(text for (text, _, _), content in zip(blocks, labels) if content), len(blocks), turned


def main_text(page: str | None, weights: tuple[float, ...] = WEIGHTS) -> str:
    return extract_page(page, weights)[0]


def _extract(weights: tuple[float, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract_page(p, weights) for p in batch.column(2).to_pylist()]
            texts = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_turned"])
    return run


def sample_pages(slim: DataFrame, fit_pages: int, max_chars: int) -> list[str]:
    """At most ``fit_pages`` pages that have an article element and at most ``max_chars`` characters, by hash."""
    marked = slim.filter((F.length("html") <= max_chars) & F.col("html").rlike("(?i)<article[ >]"))
    n = marked.count()
    if not n:
        return []
    # About four times the wanted number, then the least hashes of those.
    keyed = marked.select(F.xxhash64("page_id", "html").alias("h"), "html")
    if n > 4 * fit_pages:
        keyed = keyed.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * 4 * fit_pages / n) + 1)
    return [r.html for r in keyed.orderBy("h", "html").limit(fit_pages).collect()]


def extract_main_text(pages: DataFrame, fit_pages: int = 128, max_chars: int = 32768) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_turned`` for every row of ``pages`` (page_id, url, html).

    ``n_turned`` counts the blocks whose label in the cut isn't the classifier's. The classifier is
    fitted to at most ``fit_pages`` pages of at most ``max_chars`` characters; every whole page is extracted.

    * null or empty html, or a page without content: empty text, 0 characters;
    * null page_id and url stay null; repeated rows are extracted alike;
    * no page with an article element: the stated weights hold;
    * an empty table gives an empty result; other columns are ignored.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    weights = fit_weights(sample_pages(slim, fit_pages, max_chars))
    return slim.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long, n_blocks long, n_turned long")
