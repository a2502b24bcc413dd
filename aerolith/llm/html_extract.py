"""HTML extraction: a minimum cut parts a page's blocks into content and boilerplate.

A page is read into blocks: runs of text between block-level tags, with the chain of elements they stand in. A logistic
classifier turns a block's features into log-odds: the elements around it, inside and outside an article; the words of class names and ids, of parts of a page and of what wraps most of it;
its length, links and end; its place in the page; what else its container holds. The log-odds, bounded by BOUND, become the block's terminal capacities, to the source if it looks like content, to the sink if not. Smoothness edges
tie a block to the next one, and to the next one in the same container, with a weight for each distance in the element tree.
The cut of least capacity labels all blocks at once.

Weights of features and edges are fitted together, so that they are on one scale: logistic regression of a block's label on its features and on the labels of the blocks that edges tie it to (the pseudo-likelihood of
the model whose best labelling the cut finds), over TRAINING invented pages of six shapes whose main text is known (html_pages). No list of good or bad names is
built in. A name that these pages do not have says nothing, and neither does a name on an element that holds most of the page, unless wrappers were seen to tell.

Most blocks are settled before any flow: a block whose terminal capacity exceeds the sum of its edges keeps that
terminal's label in every minimum cut, and its edges become terminal capacities of its neighbours. What is left is
solved by augmenting shortest paths. Both steps are exact.

Scale: one pass without shuffle; a task holds one Arrow batch; a page's graph has two edges per block. The model is fitted once, by the driver, in a few seconds, and sent with the tasks. Lost executors cost only their own
tasks.

Defined cases: a null or empty html gives an empty text. Pages that break off, tags left open and stray end tags are read as
they stand; an unfinished tag at the end is dropped. What is hidden by its attributes is no content. Very long pages are read whole. If several cuts have the least
capacity, the one with the fewest content blocks is taken. Repeated rows are read alike. Other columns are left alone. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s])(class|id|role|hidden|aria-hidden|style|type)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.IGNORECASE)
#: Fixed values of HTML: elements without an end tag, elements whose content is not markup, elements that do not break a block.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "template", "textarea", "title", "iframe", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "mi", "mn", "mo", "ms", "mtext", "mrow", "msup", "msub", "mfrac", "msqrt", "math", "tspan", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "br", "wbr"}
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_ARTICLE = {"article", "main"}
_PARAGRAPH = {"p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Most that a block's log-odds can say, and an edge. How many invented pages are fitted on.
BOUND, EDGE_BOUND, TRAINING = 8.0, 4.0, 700
#: A weight's penalty in the fit.
RIDGE = 0.05


@dataclass
class Node:
    """An open element. After reading: the characters of text in it, and how many of them are linked; its blocks."""

    tag: str
    depth: int
    parent: Node | None
    names: tuple[str, ...] = ()
    article: bool = False
    hidden: bool = False
    chars: int = 0
    linked: int = 0
    blocks: int = 0


@dataclass
class Block:
    text: str
    node: Node
    linked: int
    tag: str


def _pieces(value: str) -> list[str]:
    """What a class name, id or role says: a single word, or the first and the last word and the whole of a compound."""
    out = []
    for name in _CAMEL.sub("-", html_lib.unescape(value)).lower().split():
        words = re.split(r"[-_]+", name.strip("-_"))
        out += words if len(words) == 1 else [f"{words[0]}-", f"-{words[-1]}", "-".join(words)]
    return out


def _open(tag: str, attributes: str, parent: Node | None) -> Node:
    node = Node(tag, parent.depth + 1 if parent else 0, parent, (), tag in _ARTICLE, bool(parent and parent.hidden))
    if attributes:
        names: list[str] = []
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id", "role"):
                names += _pieces(value)
                node.article |= name == "role" and value.lower() in _ARTICLE
                if name == "class" and re.search(r"(?:^|\s)(?:hidden|sr-only|visually-hidden)(?:$|\s)", value):
                    node.hidden = True
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                node.hidden = True
        node.names = tuple(names)
    return node


def blocks(page: str) -> list[Block]:
    """The page's runs of text, with references decoded and white space folded."""
    out: list[Block] = []
    node = Node("", 0, None)
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, node, len(" ".join(html_lib.unescape(" ".join(linked)).split())), node.tag))
        parts, linked = [], []

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            tail = page[at:]
            cut = tail.rfind("<")
            if cut >= 0 and re.match(r"</?[A-Za-z]*\Z|<!-*\Z", tail[cut:]):  # an unfinished tag
                tail = tail[:cut]
            parts.append(tail)
            if in_link:
                linked.append(tail)
            break
        if m.start() > at:
            run = page[at : m.start()]
            parts.append(run)
            if in_link:
                linked.append(run)
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if not m[4]:  # broken off inside the tag
            break
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = close.end() if close else end
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            elif not closing and m[3] and tag not in VOID:
                found = _open(tag, m[3], node)
                if found.hidden and not node.hidden:  # a hidden inline element is a block of its own
                    flush()
                    node = found
            elif closing and node.tag == tag:
                flush()
                node = node.parent or node
            continue
        flush()
        if closing:
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        in_link = 0
        if tag in VOID or m[3].endswith("/") and tag not in _PARAGRAPH:
            continue
        while node.parent is not None and (node.tag == "p" or node.tag in CLOSES.get(tag, ()) or node.tag in _PARAGRAPH and tag in _PARAGRAPH and node.tag != "blockquote"):
            node = node.parent
        node = _open(tag, m[3], node)
    flush()
    for b in out:
        up: Node | None = b.node
        while up is not None:
            up.chars += len(b.text)
            up.linked += b.linked
            up.blocks += 1
            up = up.parent
    return out


#: Fixed values of HTML: elements that name a part of a page.
_MARKS = {"<nav>", "<header>", "<footer>", "<aside>", "<form>", "<article>", "<main>", "<section>", "<menu>", "<dialog>"}
#: Features of what a block's text and place are like.
_LOOKS = ("size:", "links:", "end:", "mark:", "place:", "edge:", "box:", "held:", "page:")


def _level(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def features(found: list[Block]) -> list[set[str]]:
    """What is said of each block."""
    total = sum(len(b.text) for b in found)
    whole = f"page:{any(b.linked for b in found)}:{_level(len(found), (2, 4, 8, 20))}"
    out, before = [], 0
    for k, b in enumerate(found):
        size = len(b.text)
        said = {"any", whole, f"tag:{b.tag}", f"size:{_level(size, (8, 20, 40, 80, 160))}", f"links:{_level(b.linked / size, (0.01, 0.5, 0.95))}", f"end:{b.text[-1] in '.!?…。:;'}", f"mark:{b.text.lower().startswith(('©', '(c)', 'copyright'))}"}
        said.add(f"place:{_level((before + size / 2) / total, (0.02, 0.1, 0.3, 0.7, 0.9, 0.98))}")
        said.add(f"edge:{min(k, 2)}:{min(len(found) - 1 - k, 2)}")
        before += size
        box = _container(b.node)
        said.add(f"box:{_level(box.linked / box.chars, (0.01, 0.3, 0.8))}:{_level(box.chars / box.blocks, (20, 60, 150))}")
        said.add(f"held:{_level(box.chars / total, (0.05, 0.2, 0.5))}")
        up: Node | None = b.node
        where = "in"
        while up is not None:
            wide = up.chars * 2 > total and up.blocks > 1
            if up.tag not in ("div", "body", "html", "") and up.tag not in _PARAGRAPH:
                said.add(f"{where}:<{up.tag}>")
            for name in up.names:
                if wide:
                    said.add(f"wide:{name}")
                else:
                    said |= {f"name:{name}", f"{where}:{name}"}
            if up.article and where == "in":
                said.add("article")
                where = "around"
            up = up.parent
        if where == "in":  # in no article
            said = {x.replace("in:", "out:", 1) if x.startswith("in:") else x for x in said}
        out.append(said)
    return out


@dataclass(frozen=True)
class Model:
    """Weights of features; of edges, by kind (see _steps)."""

    weights: dict[str, float]
    edges: tuple[float, ...]


#: Edges to the next block by distance in the tree, 4 or more the last, and to the next of the same container with others between.
_KINDS = 6


def _steps(found: list[Block]) -> list[tuple[int, int, int]]:
    """Pairs of blocks that an edge ties, and the kind of edge."""
    out, last = [], {}
    for k, b in enumerate(found):
        box = _container(b.node)
        if k:
            out.append((k - 1, k, min(_distance(_container(found[k - 1].node), box), _KINDS - 2)))
        if id(box) in last and last[id(box)] < k - 1:
            out.append((last[id(box)], k, _KINDS - 1))
        last[id(box)] = k
    return out


@functools.cache
def model(seed: int = 0) -> Model:
    """The same on every call."""
    from .html_pages import SHAPES, pages

    said: list[set[str]] = []
    truth: list[float] = []
    pairs: list[tuple[int, int, int]] = []
    for page, labels in pages(seed, TRAINING, [*SHAPES, "bare", "bare"]):
        found = blocks(page)
        pairs += [(a + len(said), b + len(said), kind) for a, b, kind in _steps(found)]
        said += features(found)
        truth += [float(c) for _, c in labels]
    times = Counter(name for x in said for name in x)
    place = {name: k for k, name in enumerate(sorted(n for n, t in times.items() if t >= 5))}
    y, n = np.array(truth), len(place)
    x = np.zeros((len(said), n + _KINDS), np.float32)
    for k, names in enumerate(said):
        x[k, [place[name] for name in names if name in place]] = 1
    for a, b, kind in pairs:
        x[a, n + kind] += 2 * y[b] - 1
        x[b, n + kind] += 2 * y[a] - 1
    # once more without looks, where marks speak for themselves: else they would be left half their weight
    marked = np.flatnonzero(x[:, [k for name, k in place.items() if name.startswith(("name:", "article")) or name.split(":")[-1] in _MARKS]].any(axis=1))
    again = x[marked]
    again[:, [k for name, k in place.items() if name.startswith(_LOOKS)]] = 0
    x, y = np.concatenate([x, again]), np.concatenate([y, y[marked]])
    x = np.hstack([x, (np.arange(len(x)) >= len(truth))[:, None].astype(np.float32)])  # which rows are so
    w = np.zeros(x.shape[1])
    for _ in range(8):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p)).astype(np.float32)[:, None]) + RIDGE * np.eye(len(w)), x.T @ (y - p) - RIDGE * w)
    w = w.round(6)
    return Model(dict(zip(place, w[:n].tolist(), strict=True)), tuple(np.clip(w[n : n + _KINDS], 0.0, EDGE_BOUND).tolist()))


def log_odds(found: list[Block], fitted: Model, said: list[set[str]] | None = None) -> list[float]:
    """The classifier: positive for content."""
    weight = fitted.weights.get
    return [-BOUND if b.node.hidden else max(-BOUND, min(BOUND, sum(weight(name, 0.0) for name in sorted(x)))) for b, x in zip(found, said or features(found), strict=True)]


def _container(n: Node) -> Node:
    while n.tag in _PARAGRAPH and n.parent is not None:
        n = n.parent
    return n


def _distance(a: Node, b: Node) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth and a.parent is not None:
            a = a.parent
        elif b.parent is not None:
            b = b.parent
        else:
            break
        steps += 1
    return steps


def edges(found: list[Block], fitted: Model) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block to the next, and to the next of the same container."""
    return [(a, b, fitted.edges[kind]) for a, b, kind in _steps(found)]


def min_cut(odds: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it lies on the source side of the minimum cut with the smallest source side."""
    n = len(odds)
    terminal = list(odds)
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in links:
        around[a][b] = around[a].get(b, 0.0) + w
        around[b][a] = around[b].get(a, 0.0) + w
    total = [sum(x.values()) for x in around]
    label: list[bool | None] = [None] * n
    todo = [k for k in range(n) if abs(terminal[k]) > total[k]]
    while todo:
        k = todo.pop()
        if label[k] is not None or abs(terminal[k]) <= total[k]:
            continue
        label[k] = terminal[k] > 0
        for j, w in around[k].items():
            if label[j] is None:
                terminal[j] += w if label[k] else -w
                total[j] -= w
                if abs(terminal[j]) > total[j]:
                    todo.append(j)
    left = [k for k in range(n) if label[k] is None]
    if left:
        for k, side in _augment(left, terminal, around, label).items():
            label[k] = side
    return [bool(x) for x in label]


def _augment(left: list[int], terminal: list[float], around: list[dict[int, float]], label: list) -> dict[int, bool]:
    """Max-flow by shortest augmenting paths over the nodes that are left; the source side of its cut."""
    rest = {k: {j: w for j, w in around[k].items() if label[j] is None} for k in left}
    give = {k: max(terminal[k], 0.0) for k in left}
    take = {k: max(-terminal[k], 0.0) for k in left}
    tiny = 1e-12
    while True:
        before: dict[int, int] = {}
        queue = deque(k for k in left if give[k] > tiny)
        seen = set(queue)
        goal = None
        while queue:
            k = queue.popleft()
            if take[k] > tiny:
                goal = k
                break
            for j, w in rest[k].items():
                if w > tiny and j not in seen:
                    seen.add(j)
                    before[j] = k
                    queue.append(j)
        if goal is None:
            return {k: k in seen for k in left}
        path = [goal]
        while path[-1] in before:
            path.append(before[path[-1]])
        path.reverse()
        flow = min(give[path[0]], take[goal], *[rest[a][b] for a, b in zip(path, path[1:], strict=False)])
        give[path[0]] -= flow
        take[goal] -= flow
        for a, b in zip(path, path[1:], strict=False):
            rest[a][b] -= flow
            rest[b][a] = rest[b].get(a, 0.0) + flow


def labelled(page: str, fitted: Model | None = None) -> list[tuple[str, bool, bool]]:
    """The page's blocks in order, each with whether it is content, and whether the classifier alone would say so."""
    fitted = fitted or model()
    found = blocks(page)
    odds = log_odds(found, fitted)
    return [(b.text, label, x > 0) for b, label, x in zip(found, min_cut(odds, edges(found, fitted)), odds, strict=True)]


def main_text(page: str | None, fitted: Model | None = None) -> str:
    return "\n".join(text for text, content, _ in labelled(page or "", fitted) if content)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_changed) of every row: n_blocks counts all blocks of the page, n_changed those whose label the cut changed."""
    ship(pages.sparkSession)
    fitted = model()
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, changed = [], [], []
            for page in batch.column(2):
                found = labelled(page.as_py() or "", fitted)
                texts.append("\n".join(t for t, content, _ in found if content))
                sizes.append(len(found))
                changed.append(sum(content != alone for _, content, alone in found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), *[pa.array(x, pa.int64()) for x in ([len(t) for t in texts], sizes, changed)]], ["page_id", "url", "text", "n_chars", "n_blocks", "n_changed"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_changed long")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
