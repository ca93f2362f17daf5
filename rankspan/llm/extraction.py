"""Main text of web pages by a tree-structured graphical model.

Each element of a page's DOM that forms a block (or carries a class or id) is a
binary variable: content or not.  Unary potentials come from its tag, names,
links and text; parent-child potentials join them.  Sum-product messages pass
from the leaves to the root and back, which gives exact marginals on the tree;
the text of elements with a marginal of one half or more is the main text.

Training (driver, ``labelled_pages``): unary weights by logistic regression on
the labelled elements, parent-child potentials from the labels' joint counts.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one newline; ``br`` is white space.

Defined cases: null and empty html give empty text; unclosed and misnested tags
are repaired as the tree is built; a page of any length or depth is handled
whole (no recursion); repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches
from .labelled_pages import labelled_pages

# Kinds of elements.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template head title iframe svg math object audio video canvas select option "
                    "textarea button datalist".split())
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript"))
UNENDING = frozenset(("script", "style"))
CLOSES_P = BLOCKS - frozenset(("body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
            "tbody": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead", "tfoot")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
          "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
# end tags and the like, found in the page as it is written
_END_TAG = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in DROPPED | RAW}
_BODY = re.compile(r"<body(?=[\s/>]|\Z)", re.I | re.A)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME = re.compile(r"[a-z]+")

TAG_GROUPS = {"article": "article", "main": "main", "section": "section", "div": "div", "p": "p", "nav": "nav", "menu": "nav",
              "header": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "legend": "form",
              "ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "blockquote": "quote",
              "pre": "quote", "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table",
              "thead": "table", "tfoot": "table", "caption": "table", "figure": "figure", "figcaption": "figure",
              "body": "body", "html": "body", "dialog": "dialog", **{f"h{i}": "heading" for i in range(1, 7)}}
# Parts of class, id and role names.
NAMES = {
    "content": frozenset("article content post entry story main body text blog page news".split()),
    "menu": frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar top toolbar logo banner "
                      "search pagination pager skip tabs".split()),
    "foot": frozenset("footer foot bottom copyright legal contentinfo colophon disclaimer".split()),
    "side": frozenset("sidebar side aside widget secondary rail complementary related recommended recommend more next "
                      "share social sharing tags meta author byline".split()),
    "advert": frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted "
                        "commercial slot".split()),
    "notice": frozenset("cookie cookies consent notice alert gdpr popup modal overlay dialog banner message paywall "
                        "newsletter subscribe subscription signup login register form".split()),
    "comment": frozenset("comment comments commentlist reply replies discussion disqus response responses respond "
                         "feedback thread".split()),
}
FEATURES = ("one", *sorted(set(TAG_GROUPS.values())), "other", *NAMES, "hidden", "links0", "links1", "links2", "links3",
            "text0", "text1", "text2", "text3", "text4", "sentence", "controls", "named")
_AT = {name: i for i, name in enumerate(FEATURES)}


# A plain element - an unnamed text element, not mostly links, inside a telling
# one - has no unary potential; its parent decides through the potentials that
# such elements have of their own (each row a distribution, so that the number of
# paragraphs weighs neither for nor against their parent).
TEXT_TAGS = frozenset(t for t, g in TAG_GROUPS.items() if g in ("p", "heading", "list", "item", "quote", "table", "figure"))
BARE = frozenset("html body div center section".split())


@dataclass
class Node:
    tag: str
    parent: int
    names: frozenset
    hidden: bool
    label: int
    own: int = 0          # characters of text in the subtree
    linked: int = 0       # of these, inside links
    marks: int = 0        # sentence marks
    controls: int = 0
    plain: int = 0


def _attributes(raw: str) -> tuple[frozenset, bool, int]:
    names, hidden, label = set(), False, 0
    for key, a, b, c in _ATTRIBUTE.findall(raw):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id", "role"):
            names.update(_NAME.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif key == "data-main":
            label = 1
    return frozenset(names), hidden, label


def parse(html: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """(nodes, pieces): element variables in page order (parents first), and the
    page's text as (node, text); text None is a block border."""
    nodes = [Node("html", -1, frozenset(), False, 0)]
    pieces: list[tuple[int, str | None]] = []
    stack: list[tuple[str, int, bool]] = []      # tag, node, link
    current, in_link, dropped = 0, 0, 0

    def close(to: int) -> None:
        nonlocal current, in_link
        border = False
        while len(stack) > to:
            tag, before, link = stack.pop()
            in_link -= link
            border |= tag in BLOCKS or current != before
            current = before
        if border:
            pieces.append((current, None))

    def text(raw: str) -> None:
        if not raw:
            return
        value = unescape(raw) if "&" in raw else raw
        pieces.append((current, value))
        size = len(value) - value.count(" ") if not value.isspace() else 0
        if size:
            node = nodes[current]
            node.own += size
            node.marks += value.count(". ") + value.count("! ") + value.count("? ") + value.rstrip().endswith((".", "!", "?"))
            if in_link:
                node.linked += size

    at, end = 0, len(html)
    lost: set[str] = set()                       # elements without a further end tag
    search = _TOKEN.search
    while at < end:
        m = search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if m.group().startswith("<![CDATA["):
                text(m.group()[9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                if tag == "p":
                    pieces.append((current, None))
            continue
        if tag in DROPPED or tag in RAW:
            nodes[current].controls += tag in ("button", "select", "textarea")
            if m.group(3).endswith("/") and tag not in RAW:
                continue
            if tag in ("option",):
                continue
            stop = None if tag in lost else _END_TAG[tag].search(html, at)
            if tag == "head" and (body := _BODY.search(html, at)) and (stop is None or body.start() < stop.start()):
                at = body.start()
                continue
            if stop is None:
                # script and style run to the page's end; of others the start tag alone is left out
                lost.add(tag)
                at = end if tag in UNENDING else at
            else:
                at = html.find(">", stop.end()) + 1 or end
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append((current, " "))
            elif tag == "hr":
                pieces.append((current, None))
            nodes[current].controls += tag == "input"
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    break
                if stack[i][0] in SCOPES[tag]:
                    break
        names, hidden, label = _attributes(m.group(3)) if m.group(3) else (frozenset(), False, 0)
        before = current
        if tag in BLOCKS or names or hidden:
            nodes.append(Node(tag, current, names, hidden, label))
            current = len(nodes) - 1
            if tag in BLOCKS:
                pieces.append((current, None))
        stack.append((tag, before, tag == "a"))
        in_link += tag == "a"
        if m.group(3).endswith("/") and tag not in BLOCKS:
            close(len(stack) - 1)
    close(0)
    for i in range(len(nodes) - 1, 0, -1):
        node, up = nodes[i], nodes[nodes[i].parent]
        up.own += node.own
        up.linked += node.linked
        up.marks += node.marks
        up.controls += node.controls
    for node in nodes[1:]:
        up = nodes[node.parent]
        node.plain = int(not node.names and not node.hidden and 2 * node.linked <= node.own and node.tag in TEXT_TAGS and
                         (up.tag not in BARE or bool(up.names)))
    return nodes, pieces


def unary_features(nodes: list[Node]) -> np.ndarray:
    x = np.zeros((len(nodes), len(FEATURES)))
    for row, node in zip(x, nodes, strict=True):
        if node.plain:
            continue
        row[0] = 1
        row[_AT[TAG_GROUPS.get(node.tag, "other")]] = 1
        if node.names:
            row[_AT["named"]] = 1
            for kind, words in NAMES.items():
                if not words.isdisjoint(node.names):
                    row[_AT[kind]] = 1
        row[_AT["hidden"]] = node.hidden
        share = node.linked / node.own if node.own else 0.0
        row[_AT["links0"] + (0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3)] = 1
        size = node.own
        row[_AT["text0"] + (0 if size == 0 else 1 if size < 25 else 2 if size < 80 else 3 if size < 250 else 4)] = 1
        row[_AT["sentence"]] = node.marks > 0
        row[_AT["controls"]] = node.controls > 0
    return x


def sum_product(odds: np.ndarray, parents: list[int], kinds: list[int], pair: np.ndarray):
    """(marginals, edges): P(content) of every node by one pass of messages up
    and one down, and the joint [parent, child] beliefs of each node's edge."""
    p = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
    one, zero = p.tolist(), (1.0 - p).tolist()
    tables = [t.ravel().tolist() for t in pair]
    n = len(parents)
    own0, own1 = zero[:], one[:]               # unary times the messages from below
    up0, up1 = [1.0] * n, [1.0] * n
    for i in range(n - 1, 0, -1):              # children stand after parents
        a, b = own0[i], own1[i]
        p00, p01, p10, p11 = tables[kinds[i]]
        m0, m1 = p00 * a + p01 * b, p10 * a + p11 * b
        total = m0 + m1
        up0[i], up1[i] = m0 / total, m1 / total
        j = parents[i]
        a, b = own0[j] * up0[i], own1[j] * up1[i]
        total = a + b
        own0[j], own1[j] = a / total, b / total
    belief1 = own1[:]
    edges = np.zeros((n, 4))
    for i in range(1, n):
        j = parents[i]
        # the parent's belief without this child's own message
        a, b = (1.0 - belief1[j]) / max(up0[i], 1e-300), belief1[j] / max(up1[i], 1e-300)
        p00, p01, p10, p11 = tables[kinds[i]]
        c, d = own0[i], own1[i]
        e = (a * p00 * c, a * p01 * d, b * p10 * c, b * p11 * d)
        total = sum(e)
        edges[i] = (e[0] / total, e[1] / total, e[2] / total, e[3] / total)
        belief1[i] = (e[1] + e[3]) / total
    return np.array(belief1), edges


@dataclass
class PageModel:
    weights: np.ndarray       # unary log odds of content
    pair: np.ndarray          # pair[kind of child, parent, child] potential

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        return sum_product(unary_features(nodes) @ self.weights, [n.parent for n in nodes], [n.plain for n in nodes],
                           self.pair)[0]

    def extract(self, html: str) -> str:
        nodes, pieces = parse(html)
        content = (self.marginals(nodes) >= 0.5).tolist()
        blocks: list[str] = []
        run: list[str] = []
        for node, text in pieces:
            if text is None:
                if run:
                    blocks.append(" ".join("".join(run).split()))
                    run = []
            elif content[node]:
                run.append(text)
        if run:
            blocks.append(" ".join("".join(run).split()))
        return "\n".join(b for b in blocks if b)


def train(pages: list[str] | None = None, rounds: int = 80, l2: float = 1e-4) -> PageModel:
    """Fit unary weights and parent-child potentials together on labelled pages
    (blocks of the article carry data-main): ascent on the log likelihood, whose
    gradient is the observed less the expected features under the messages."""
    parsed = [parse(p)[0] for p in (labelled_pages() if pages is None else pages)]
    xs = [unary_features(nodes) for nodes in parsed]
    ys = [np.array([node.label for node in nodes]) for nodes in parsed]
    parents = [[node.parent for node in nodes] for nodes in parsed]
    kinds = [np.array([node.plain for node in nodes]) for nodes in parsed]
    seen = np.zeros((2, 4))
    for y, up, kind in zip(ys, parents, kinds, strict=True):
        np.add.at(seen, (kind[1:], 2 * y[up[1:]] + y[1:]), 1)
    told = (seen[1] + 0.5).reshape(2, 2)
    told /= told.sum(axis=1, keepdims=True)
    w, theta = np.zeros(len(FEATURES)), np.zeros(4)
    step, past = np.full(len(w) + 4, 0.2), np.zeros(len(w) + 4)
    for _ in range(rounds):
        pair = np.stack([np.exp(theta).reshape(2, 2), told])
        grad_w, grad_t = -l2 * w * len(xs), seen[0] - l2 * theta * len(xs)
        for x, y, up, kind in zip(xs, ys, parents, kinds, strict=True):
            p, edges = sum_product(x @ w, up, kind.tolist(), pair)
            grad_w += (y - p) @ x
            grad_t = grad_t - edges[1:][kind[1:] == 0].sum(axis=0)
        # steps by the gradient's sign: longer while it stays, shorter where it turns
        grad = np.concatenate([grad_w, grad_t])
        turn = np.sign(grad) * np.sign(past)
        step = np.clip(step * np.where(turn > 0, 1.2, np.where(turn < 0, 0.5, 1.0)), 1e-3, 0.8)
        past = np.where(turn < 0, 0.0, grad)
        move = step * np.sign(past)
        w, theta = w + move[:len(w)], theta + move[len(w):]
    return PageModel(w, np.stack([np.exp(theta).reshape(2, 2), told]))


def extract_main_text(pages: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or train()

    def work(batches):
        for batch in batches:
            texts = [model.extract(h or "") for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return in_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"),
                      work, "page_id long, url string, text string, n_chars long")
