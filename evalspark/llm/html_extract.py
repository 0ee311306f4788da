"""Main text of web pages by a tree-structured graphical model (operator 10).

A page becomes a tree of its block elements. Each node has a hidden label, content or boilerplate.
A node's own features (element, class and id words, amount of text and links) give its unary
potential; a potential on each edge couples parent and child. Sum-product message passing, once up
and once down the tree, gives the exact marginal of every node. The text of the nodes with a
content marginal of at least one half is the result, in page order.

Training: pages that mark their article (``article``, ``main`` or role=main) label their own nodes:
inside it content, outside boilerplate, whatever the elements are called. Each is learned twice, as
it is and without its marks, since other pages have none. At most ``sample`` such pages (picked by a hash) fit the edge potentials, from counts of parent and child labels, and the
unary weights, by the likelihood of the labels under the whole tree: its gradient is the labels
less the marginals of message passing. Priors (a weight per feature, ``EDGE_NODES`` nodes per edge
rate) say what element and class names mean where the sample does not show it; each bad word has a
weight of its own, so one that a site uses for its articles loses its meaning there. All pages are
then extracted.

A box that only its class or id calls boilerplate, while all running text of the page lies inside
it and nothing else is marked or named as the article, is not taken at its word (feature ``sole``). A ``header`` inside an article holds its title and
is not the page's.

Text: character references are decoded; white space inside a block becomes one space; blocks are
trimmed and joined by one space. Inline elements do not end a block, ``br`` counts as white space.
Comments, scripts, styles, form controls and the source notes of formulas (``annotation``) are
dropped. Time and memory are linear in the length of a page, however deep its elements nest.

Defined cases: null or empty html, and pages without content, give an empty text; broken markup
(unclosed elements, stray end tags, a tag cut off at the end) is read as browsers do in the common
cases; repeated rows each give a row; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

# --- fixed values -------------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is not running text of the page.
SILENT = frozenset("script style noscript template head title iframe select option optgroup button textarea datalist annotation annotation-xml".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption "
    "header footer nav aside form fieldset legend address details summary dialog center hgroup menu search".split())
CLOSES_P = BLOCK - {"html", "body", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend", "summary"} | {"hr"}
#: A start tag ends an open element of these names, up to one of the containers.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
BAD_TAGS = frozenset("nav footer header aside dialog menu search".split())
P_LIMITS = ("td", "th", "li", "button", "table")  # a new block ends no paragraph beyond these
DOUBTFUL_TAGS = frozenset("form fieldset address legend".split())  # a form may hold a whole page
#: A class with one of these words talks about something else than its element.
MODIFIERS = frozenset("with without has no not is js tag category hide show".split())
GOOD_TAGS = frozenset("article main".split())
BAD_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot header masthead topbar sidebar side aside ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations widget widgets subscribe subscription newsletter signup login search popup modal overlay toolbar pagination pager "
    "tags copyright legal disclaimer skip toc".split())
GOOD_WORDS = frozenset("article articlebody content main post entry story body text prose page".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

LONG_TEXT = 80  # code points of a block's own text
#: Feature -> prior weight (log odds of content).
PRIOR = {
    "bias": -0.5, "tag:article": 5.0, "tag:main": 4.0, "tag:p": 0.8, "tag:heading": 0.5, "tag:list": 0.0, "tag:table": 0.0, "tag:body": -1.0, "tag:html": -1.5,
    "tag:div": 0.0, "tag:section": 0.3, "tag:quote": 0.8, "bad_tag": -6.0, "bad_word": -6.0, "sole": -1.0, "doubtful": -6.0, "modified": -4.0, "good_word": 2.5,
    "text:some": 0.2, "text:medium": 1.2, "text:long": 2.5, "links:half": -2.5, "links:most": -3.0, "stops": 0.5,
    "boxed": -1.0, "boxed:text": 0.0, **{f"word:{w}": 0.0 for w in sorted(BAD_WORDS)}}
#: Prior rates of content, given a boilerplate and a content parent, for each kind of child
#: (``node_kinds``), and the number of nodes that they weigh.
EDGE_RATES, EDGE_NODES = ((0.01, 0.98), (0.2, 0.98), (0.001, 0.1), (0.001, 0.9)), 50.0
NAMES = list(PRIOR)
INDEX = {n: i for i, n in enumerate(NAMES)}
TAG_FEATURE = {"p": "tag:p", "article": "tag:article", "main": "tag:main", "body": "tag:body", "html": "tag:html", "div": "tag:div", "section": "tag:section",
               "blockquote": "tag:quote", "pre": "tag:quote", "ul": "tag:list", "ol": "tag:list", "li": "tag:list", "dl": "tag:list", "dt": "tag:list", "dd": "tag:list",
               "table": "tag:table", "tr": "tag:table", "td": "tag:table", "th": "tag:table", "tbody": "tag:table",
               **{f"h{i}": "tag:heading" for i in range(1, 7)}}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPLIT_WORDS = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


# --- page tree ----------------------------------------------------------------------------------

class Node:
    __slots__ = ("tag", "parent", "marks", "text_len", "link_len", "stops", "own_len")

    def __init__(self, tag: str, parent: int, marks: tuple[str, ...]):
        self.tag, self.parent, self.marks = tag, parent, marks
        self.text_len = self.link_len = self.stops = self.own_len = 0


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """Which of main, good_word, bad_tag, bad_word (with its words), doubtful and modified the
    element and its attributes show."""
    out = set()
    if tag in BAD_TAGS:
        out.add("bad_tag")
    elif tag in DOUBTFUL_TAGS:
        out.add("doubtful")
    if "=" in attributes or "hidden" in attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            value = a or b or c
            if name.lower() == "role":
                if value.lower() in BAD_ROLES:
                    out.add("bad_tag")
                if value.lower() in ("main", "article"):
                    out.add("main")
                continue
            for token in value.split():
                words = set(_SPLIT_WORDS.split(_CAMEL.sub("-", token).lower()))
                words.add(token.lower())
                if words & BAD_WORDS:
                    if not words & MODIFIERS:
                        out.add("bad_word")
                        out.update(f"word:{w}" for w in words & BAD_WORDS)
                    elif tag not in GOOD_TAGS:
                        out.add("modified")
                elif words & GOOD_WORDS:
                    out.add("good_word")
        if _HIDDEN.search(attributes):
            out.add("bad_tag")
    if tag in ("html", "body"):
        return ()
    if out & {"bad_tag", "bad_word", "doubtful"}:
        out.discard("good_word")
    return tuple(sorted(out))


def _named_good(node: "Node") -> bool:
    return node.tag in GOOD_TAGS or "main" in node.marks or "good_word" in node.marks


def _named_bad(marks: tuple[str, ...]) -> bool:
    return "bad_tag" in marks or "bad_word" in marks


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (parents first) and runs of text (node, text)."""
    nodes: list[Node] = [Node("html", -1, ())]
    runs: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements that are nodes or silent
    depths: defaultdict[str, list[int]] = defaultdict(list)  # where each name is open, ascending
    silent = link = 0
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = " ".join("".join(pending).split())
            pending.clear()
            if text:
                at = stack[-1][1]
                runs.append((at, text))
                node = nodes[at]
                node.own_len += len(text)
                node.stops += text.count(".") + text.count("?") + text.count("!")

    def add_text(raw: str) -> None:
        if silent or not raw:
            return
        text = htmllib.unescape(raw) if "&" in raw else raw
        pending.append(text)
        if link:
            nodes[stack[-1][1]].link_len += len(text.strip())

    def pop_to(depth: int) -> None:
        nonlocal silent
        flush()
        while len(stack) > depth:
            tag, _ = stack.pop()
            depths[tag].pop()
            silent -= tag in SILENT

    def push(tag: str, node: int) -> None:
        depths[tag].append(len(stack))
        stack.append((tag, node))

    def deepest(names) -> int:
        return max((depths[x][-1] for x in names if depths[x]), default=0)

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if m is None:
            add_text(page[pos:])
            break
        if m.start() > pos:
            add_text(page[pos:m.start()])
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, attributes = name.lower(), m[3] if m[2] else m[6]
        if m[1] or m[4]:  # end tag
            if tag == "a":
                link = max(0, link - 1)
            if depths[tag]:
                pop_to(depths[tag][-1])
            continue
        if tag in VOID:
            if tag == "br":
                add_text(" ")
            elif tag == "hr":
                flush()
            continue
        if tag == "html":
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
            pos = close.end() if close else end
            continue
        if tag in CLOSES_P:
            if depths["p"] and depths["p"][-1] > deepest(P_LIMITS):
                pop_to(depths["p"][-1])
        if tag in ENDS:
            names, limits = ENDS[tag]
            limit = deepest(limits)
            above = [depths[x][bisect_right(depths[x], limit)] for x in names if depths[x] and depths[x][-1] > limit]
            if above:
                pop_to(min(above))
        if tag == "body" and depths["head"]:
            pop_to(1)
        if attributes and attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag in SILENT:
            push(tag, stack[-1][1])
            silent += 1
            continue
        marks = _marks(tag, attributes or "")
        if tag == "header" and (depths["article"] or depths["main"]):
            marks = tuple(m for m in marks if m != "bad_tag")
        if tag in BLOCK or _named_bad(marks):
            flush()
            link = 0 if tag in BLOCK else link
            nodes.append(Node(tag, stack[-1][1], marks))
            push(tag, len(nodes) - 1)
        if tag == "a":
            link += 1
    flush()
    for node in reversed(nodes):
        node.text_len += node.own_len
        if node.parent >= 0:
            nodes[node.parent].text_len += node.text_len
            nodes[node.parent].link_len += node.link_len
    _mark_sole(nodes)
    return nodes, runs


def _mark_sole(nodes: list[Node]) -> None:
    """Where all running text of a page lies in one box whose class or id alone calls it
    boilerplate, and no other element is marked or named as the article, the box gets the mark
    ``sole`` in place of ``bad_word``."""
    box = [0] * len(nodes)  # the outermost element with a bad name around a node
    running: dict[int, int] = {}
    for i, node in enumerate(nodes):
        if i:
            box[i] = box[node.parent] or (i if _named_bad(node.marks) else 0)
        if not box[i] and node.text_len and _named_good(node):
            return
        if node.own_len >= LONG_TEXT and 2 * node.link_len < node.own_len and not (box[i] and "bad_tag" in nodes[box[i]].marks):
            running[box[i]] = running.get(box[i], 0) + node.own_len
    total = sum(running.values())
    for i, length in running.items():
        if i and length > 0.8 * total and 0 not in running:
            nodes[i].marks = tuple(m for m in nodes[i].marks if m != "bad_word") + ("sole",)


def node_features(node: Node, kind: int) -> list[int]:
    """Indices of the features that hold for a node. Text in a box named like boilerplate says
    little by its length: sidebars and comments are long, too."""
    out = ["bias"]
    out += [m for m in node.marks if m in INDEX]
    if kind >= 2:
        out.append("boxed")
        if node.own_len:
            out.append("boxed:text")
        return [INDEX[n] for n in out]
    if node.tag in TAG_FEATURE:
        out.append(TAG_FEATURE[node.tag])
    if "main" in node.marks:
        out.append("tag:main")
    if node.own_len >= LONG_TEXT:
        out.append("text:long")
    elif node.own_len >= 25:
        out.append("text:medium")
    elif node.own_len:
        out.append("text:some")
    if node.text_len:
        share = node.link_len / node.text_len
        if share > 0.8:
            out.append("links:most")
        elif share > 0.4:
            out.append("links:half")
    if node.stops >= 2:
        out.append("stops")
    return [INDEX[n] for n in out]


def node_kinds(nodes: list[Node]) -> list[int]:
    """0 plain, 1 named like content, 2 named like boilerplate, 3 inside an element named like
    boilerplate: edge potentials differ by the child's kind."""
    kinds = []
    for node in nodes:
        if _named_bad(node.marks):
            kinds.append(2)
        elif node.parent >= 0 and kinds[node.parent] >= 2:
            kinds.append(3)
        else:
            kinds.append(1 if _named_good(node) else 0)
    return kinds


# --- the model ----------------------------------------------------------------------------------

@dataclass
class PageModel:
    """weights: feature -> log odds; edges[kind][parent][child]: log probability of the child's
    label given the parent's (0 boilerplate, 1 content)."""

    weights: list[float]
    edges: list[list[list[float]]]

    def unary(self, node: Node, kind: int) -> float:
        return sum(self.weights[i] for i in node_features(node, kind))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Content marginal of every node."""
        kinds = node_kinds(nodes)
        return self.pass_messages([x.parent for x in nodes], kinds, [self.unary(x, k) for x, k in zip(nodes, kinds)])

    def pass_messages(self, parents: list[int], kinds: list[int], unary: list[float]) -> list[float]:
        """Content marginals of a tree: messages from the leaves up, then down."""
        n = len(parents)
        up0, up1 = [0.0] * n, [0.0] * n  # evidence of a node's subtree for its labels
        msg0, msg1 = [0.0] * n, [0.0] * n  # message to the parent
        for i in range(n - 1, -1, -1):
            up1[i] += unary[i]
            if i:
                e = self.edges[kinds[i]]
                msg0[i] = _log_add(e[0][0] + up0[i], e[0][1] + up1[i])
                msg1[i] = _log_add(e[1][0] + up0[i], e[1][1] + up1[i])
                p = parents[i]
                up0[p] += msg0[i]
                up1[p] += msg1[i]
        all0, all1 = up0[:], up1[:]  # with what comes down
        for i in range(1, n):
            p, e = parents[i], self.edges[kinds[i]]
            rest0, rest1 = all0[p] - msg0[i], all1[p] - msg1[i]
            all0[i] = up0[i] + _log_add(rest0 + e[0][0], rest1 + e[1][0])
            all1[i] = up1[i] + _log_add(rest0 + e[0][1], rest1 + e[1][1])
            shift = max(all0[i], all1[i])
            all0[i] -= shift
            all1[i] -= shift
        return [1 / (1 + math.exp(min(700.0, max(-700.0, b - a)))) for a, b in zip(all1, all0)]

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        nodes, runs = parse(page)
        if not runs:
            return ""
        content = self.marginals(nodes)
        return " ".join(text for node, text in runs if content[node] >= 0.5)


def _log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def own_labels(nodes: list[Node]) -> list[int] | None:
    """Labels of the nodes of a page that marks its article; None for other pages."""
    inside, found, kinds = [0] * len(nodes), False, node_kinds(nodes)
    for i, node in enumerate(nodes):
        if i == 0:
            continue
        start = kinds[i] == 1 and (node.tag in GOOD_TAGS or "main" in node.marks)
        found |= start
        inside[i] = int(start or inside[node.parent])
    return inside if found else None


def without_marks(nodes: list[Node]) -> list[Node]:
    """The page as if its article were an unnamed box."""
    out = []
    for node in nodes:
        copy = Node("div" if node.tag in GOOD_TAGS else node.tag, node.parent, tuple(m for m in node.marks if m != "main"))
        copy.text_len, copy.link_len, copy.stops, copy.own_len = node.text_len, node.link_len, node.stops, node.own_len
        out.append(copy)
    _mark_sole(out)
    return out


def fit_page_model(examples: list[tuple[list[Node], list[int]]], ridge: float = 2.0, rounds: int = 30) -> PageModel:
    """Edges from counts, weights by the likelihood of the labels under the tree, with a ridge
    around PRIOR. Steps are Newton steps as if nodes were independent, of at most 0.5 a weight."""
    edges, trees, x, y = np.zeros((4, 2, 2)), [], [], []
    for nodes, labels in examples:
        kinds, parents = node_kinds(nodes), [n.parent for n in nodes]
        for node, kind, label in zip(nodes, kinds, labels):
            x.append(node_features(node, kind))
            y.append(label)
            if node.parent >= 0:
                edges[kind, labels[node.parent], label] += 1
        trees.append((parents, kinds))
    expected = np.array(EDGE_RATES)
    rate = (edges[:, :, 1] + EDGE_NODES * expected) / (edges.sum(axis=2) + EDGE_NODES)
    prior = np.array([PRIOR[n] for n in NAMES])
    model = PageModel(prior.tolist(), np.log(np.stack([1 - rate, rate], axis=2)).tolist())
    if not y:
        return model
    design = np.zeros((len(x), len(NAMES)))
    for i, on in enumerate(x):
        design[i, on] = 1
    w, target = prior.copy(), np.array(y, dtype=float)
    for _ in range(rounds):
        unary, p, at = (design @ w).tolist(), [], 0
        for parents, kinds in trees:
            p += model.pass_messages(parents, kinds, unary[at:at + len(parents)])
            at += len(parents)
        p = np.array(p)
        grad = design.T @ (target - p) - ridge * (w - prior)
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    model.weights = w.tolist()
    return model


def train_page_model(pages: DataFrame, sample: int = 400, id_col: str = "page_id", html_col: str = "html") -> PageModel:
    """Model from at most ``sample`` pages that mark their article."""
    marked = pages.select(F.col(id_col).cast("string").alias("key"), F.col(html_col).cast("string").alias("html"))
    marked = marked.filter(F.lower("html").rlike(r"<(article|main)[\s>]|role\s*=\s*[\"']?main"))
    n = marked.count()
    rate = min(1.0, 4.0 * sample / n) if n else 1.0  # a first cut by hash: only some pages are sorted
    h = F.xxhash64("key", "html")
    picked = marked.withColumn("h", h).filter((F.pmod("h", F.lit(1 << 20)) / (1 << 20)) < rate).orderBy("h").limit(sample)
    examples = []
    for r in picked.select("html").toLocalIterator():
        nodes, _ = parse(r["html"])
        labels = own_labels(nodes)
        if labels is not None:
            examples += [(nodes, labels), (without_marks(nodes), labels)]
    return fit_page_model(examples)


def extract_text(pages: DataFrame, model: PageModel, carry: list[str], html_col: str = "html") -> DataFrame:
    """``carry`` columns of every page plus ``text``."""
    C.prepare(pages.sparkSession)
    fields = pages.select(*carry).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [model.extract(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())], names=[*batch.schema.names[:-1], "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", text string"
    return pages.select(*carry, F.col(html_col).cast("string").alias("__html")).mapInArrow(run, schema)
