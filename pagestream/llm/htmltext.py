"""HTML extraction by a tree-structured graphical model.

Each page's DOM is a tree of binary variables: does the node hold main content?  A node's
own potential comes from its tag, the words of its class and id, and the text and link
densities of its subtree; each parent-child edge has a potential by kind of edge.  Sum-product
messages pass upward from the leaves and downward from the root and give exact marginals.
Text whose element has a marginal of at least one half is extracted.

The potentials are trained on labelled pages: node weights by logistic regression, edge
potentials by smoothed counts of label pairs.  ``labelled_pages`` makes the built-in
training pages from several layouts with every kind of boilerplate; a caller may train on
labelled pages of its own.

Parsing keeps the whole page, tolerates unclosed tags, and never looks into scripts,
styles, comments or other invisible elements.  Attributes are read as pairs of name and
value: only a quote right after ``=`` opens a value, and one that is never closed is part of
an unquoted value.  Pages are independent, so extraction is one narrow pass.

Defined results: a null or empty page gives an empty text; a page without markup is one
block of content; character references are decoded, white space inside a block becomes
one space, and blocks are joined by one space in page order; repeated pages are treated
alike.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; without an end tag they reach to the end of the page.
PLAIN = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Skipped to their own end tag; without one, only the start tag is.
SKIPPED = frozenset("noscript template svg object annotation annotation-xml mphantom".split())
#: Only svg and MathML elements can be written as empty ones.
SELF_CLOSED = SKIPPED - frozenset("noscript template object".split())
HIDDEN = frozenset("script style noscript iframe template svg object noembed noframes head title select option textarea button input canvas audio video datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= frozenset("math semantics mrow mi mn mo ms mtext mspace mstyle mpadded msup msub msubsup mfrac msqrt mroot mover munder munderover mmultiscripts menclose merror mtable mtr mtd".split())
#: An open element of the right is closed by the start of one of the left.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("tr",), "tbody": ("thead", "tr"), "option": ("option",),
}
BLOCKS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

# Words of class, id and role attributes, by what they tell.
HINTS = {
    "ad": "ad ads advert advertisement adverts banner sponsor sponsored promo promotion commercial adsense adbox adslot",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs topbar skip sitemap",
    "frame": "header masthead footer foot copyright colophon topbar bottom legal imprint head logo",
    "side": "sidebar side aside rail widget related recommended recommendations popular trending more teaser teasers links tags",
    "comment": "comment comments reply replies respond discussion disqus thread reader feedback commentlist",
    "notice": "cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter subscribe signup login paywall warning message dialog",
    "form": "form search searchbox contact input field",
    "share": "share sharing social follow twitter facebook buttons toolbar meta byline",
    "content": "content article post entry story body text main page-content articlebody prose copy",
}
_HINT = {w: k for k, ws in HINTS.items() for w in ws.split()}
_HINTS = tuple(HINTS)
TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "nav", "header", "footer", "aside", "form", "table", "blockquote", "pre", "figure", "a", "dialog", "address", "menu", "details")
EDGES = tuple(TAGS) + ("body", "inline", "other")

# Every quantifier is possessive: a match goes forward only, whatever the page holds.
_ATTRIBUTE = r"(=?[^\s/>=]++|=)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+"
_TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*+)(>?)")
_ATTR = re.compile(_ATTRIBUTE)
_COMMENT_END = re.compile(r"--!?>")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    hidden: bool = False
    texts: list = field(default_factory=list)  # (order, text)
    chars: int = 0
    links: int = 0
    kids: int = 0
    label: int = -1


def attributes(raw: str) -> tuple[dict[str, str], bool]:
    """Names and values of a tag's attributes, the first of a name counting, and whether the tag ends in a slash of its own."""
    found, last = {}, 0
    for m in _ATTR.finditer(raw):
        found.setdefault(m[1].lower(), next((v for v in m.group(2, 3, 4) if v is not None), ""))
        last = m.end()
    return found, raw.rstrip().endswith("/") and last < len(raw.rstrip())


def _told(found: dict[str, str]) -> tuple[tuple[str, ...], bool, str]:
    """(hints, hidden, label) of an element's attributes."""
    hints = {_HINT[w] for name in ("class", "id", "role") if name in found for w in _WORDS.findall(found[name].lower()) if w in _HINT}
    role = found.get("role", "").lower()
    if role in ("banner", "contentinfo"):
        hints.add("frame")
    if role == "complementary":
        hints.add("side")
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").lower().replace(" ", "")
    return tuple(sorted(hints)), hidden, found.get("data-label", "")


def next_tag(page: str, at: int) -> tuple[int, int, str, str, str]:
    """(from, to, "/" of an end tag, name, attributes) of the next piece of markup; a comment has no name.

    A ``<`` that starts no markup is text.  A tag that the page's end cuts off is markup if
    it has an attribute with a value, else the rest of the page is text.
    """
    n = len(page)
    while (start := page.find("<", at)) >= 0:
        first = page[start + 1 : start + 2]
        if first in ("!", "?") or first == "/" and not page[start + 2 : start + 3].isalpha() and start + 2 < n:
            if page.startswith("<!--", start):
                if page.startswith((">", "->"), start + 4):
                    return start, page.index(">", start) + 1, "", "", ""
                m = _COMMENT_END.search(page, start + 4)
                return start, m.end() if m else n, "", "", ""
            end = page.find(">", start)
            return start, end + 1 if end >= 0 else n, "", "", ""
        m = _TAG.match(page, start)
        if m is None:
            at = start + 1
        elif m[4]:
            return start, m.end(), m[1], m[2].lower(), m[3]
        elif "=" in m[3] and any(attributes(m[3])[0].values()):
            return start, n, "", "", ""
        else:
            break
    return n, n, "", "", ""


def _after_end_tag(page: str, tag: str, at: int) -> int:
    """Place after the end tag of ``tag``; the page's end where there is none."""
    m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
    end = page.find(">", m.end()) if m else -1
    return end + 1 if end >= 0 else len(page)


def _ends(page: str) -> dict[int, int]:
    """Place after the start tag of each closed skipped element: place after its own end tag."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    at = 0
    while at < len(page):
        _, at, slash, tag, raw = next_tag(page, at)
        if tag in SKIPPED:
            if not slash:
                if not (tag in SELF_CLOSED and attributes(raw)[1]):
                    opened.setdefault(tag, []).append(at)
            elif opened.get(tag):
                ends[opened[tag].pop()] = at
        elif tag in ("script", "style") and not slash:
            at = _after_end_tag(page, tag, at)
    return ends


_BARRIERS = ("ul", "ol", "dl", "table", "div", "article", "section", "nav")


def parse(page: str) -> list[Node]:
    """The nodes in page order; node 0 is the root, and every parent comes before its children.

    Inline elements do not become nodes: their text belongs to the block around them.
    Each node's texts carry the order of the piece in the page; a piece may be ``None``
    for the end of a block.  The page is read forward once (once more where it holds
    skipped elements), and open elements are found by name, so time follows its length.
    """
    nodes = [Node("body", -1)]
    stack = [0]
    places: dict[str, list[int]] = {}  # of open elements in the stack, by name
    anchors = 0
    order = 0
    at = 0
    ends: dict[int, int] | None = None
    head = False

    def text(piece: str):
        nonlocal order
        if piece:
            order += 1
            node = nodes[stack[-1]]
            node.texts.append((order, piece))
            n = len(piece.strip())
            node.chars += n
            if anchors:
                node.links += n

    def boundary():
        nonlocal order
        order += 1
        nodes[stack[-1]].texts.append((order, None))

    def close(tag: str) -> bool:
        nonlocal anchors
        if not places.get(tag):
            return False
        k = places[tag][-1]
        boundary()
        for i in stack[k:]:
            places[nodes[i].tag].pop()
        del stack[k:]
        anchors = 0
        boundary()
        return True

    while at < len(page):
        start, stop, slash, tag, raw = next_tag(page, at)
        text(page[at:start])
        at = stop
        if not tag:
            continue
        if tag in ("html", "body", "head", "meta", "link", "base"):
            if tag == "head" and not slash and not head:
                head = True
                if m := re.compile(r"</head(?=[\s/>])|<body(?=[\s/>])", re.I).search(page, at):
                    at = m.start()
            continue
        if slash:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag not in INLINE and not close(tag) and tag in BLOCKS:
                boundary()
            continue
        if tag in SKIPPED:
            if not (tag in SELF_CLOSED and attributes(raw)[1]):
                if ends is None:
                    ends = _ends(page)
                at = ends.get(at, at)
            continue
        if tag in PLAIN:
            at = _after_end_tag(page, tag, at)
            continue
        if tag in INLINE:
            if tag == "a" and not attributes(raw)[1]:
                anchors += 1
            continue
        if tag in ("br", "hr"):
            boundary()
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS and nodes[stack[-1]].tag == "p":
            close("p")
        nearest = max((places[t][-1] for t in CLOSES.get(tag, ()) if places.get(t)), default=-1)
        if nearest > max((places[t][-1] for t in _BARRIERS if places.get(t)), default=-1):
            close(nodes[stack[nearest]].tag)
        boundary()
        found, empty = attributes(raw) if raw else ({}, False)
        hints, hidden, mark = _told(found) if found else ((), False, "")
        nodes.append(Node(tag, stack[-1], hints, hidden or tag in HIDDEN, label=int(mark == "1") if mark else -1))
        nodes[stack[-1]].kids += 1
        places.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)
        anchors = 0
        if empty and tag not in BLOCKS:
            close(tag)
    return nodes


_TAG_AT = {t: i for i, t in enumerate(TAGS)}
_EDGE_AT = {t: i for i, t in enumerate(EDGES)}
#: Log odds of content for the root, which holds everything.
ROOT = -6.0
_AROUND = frozenset("nav header footer aside form dialog menu".split())
_ASIDE = frozenset(h for h in HINTS if h != "content")
WIDTH = len(TAGS) + len(_HINTS) + 13


def node_features(nodes: list[Node]) -> np.ndarray:
    """One row for each node."""
    n = len(nodes)
    chars, links, kids = [x.chars for x in nodes], [x.links for x in nodes], [x.kids for x in nodes]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
    total = max(chars[0], 1)
    out = np.zeros((n, WIDTH))
    base = len(TAGS) + len(_HINTS)
    for i, x in enumerate(nodes):
        if (t := _TAG_AT.get(x.tag)) is not None:
            out[i, t] = 1
        for h in x.hints:
            out[i, len(TAGS) + _HINTS.index(h)] = 1
    c, k = np.array(chars, dtype=float), np.array(kids, dtype=float)
    density = np.array(links) / np.maximum(c, 1)
    out[:, base] = 1
    out[:, base + 1] = np.log1p(np.minimum(c, 2000)) / 8
    out[:, base + 2] = c / total
    out[:, base + 3] = density
    out[:, base + 4] = (density > 0.5) & (c > 0)
    out[:, base + 5] = c == 0
    out[:, base + 6] = c < 25
    out[:, base + 7] = np.log1p(k) / 4
    # what stands above a node: boilerplate by tag or by name, an article or main element
    held = any(x.tag in ("article", "main") for x in nodes)
    for i, x in enumerate(nodes):
        if i:
            up = out[x.parent, base + 8 :]
            above = nodes[x.parent]
            out[i, base + 8] = up[0] or above.tag in _AROUND
            out[i, base + 9] = up[1] or bool(_ASIDE.intersection(above.hints))
            out[i, base + 10] = up[2] or above.tag in ("article", "main") or "content" in above.hints
            out[i, base + 11] = held and not out[i, base + 10] and x.tag not in ("article", "main")
            out[i, base + 12] = x.tag in _AROUND or bool(_ASIDE.intersection(x.hints))
    return out


@dataclass
class Model:
    """``unary``: weights of the node features; ``pair``: log potentials (edge kind, parent's label, child's label).

    ``prior``: log odds of content by edge kind; the edges carry it, so a node's own
    potential is what its features say beyond it.
    """

    unary: np.ndarray
    pair: np.ndarray
    prior: np.ndarray

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        """P(content) of each node by sum-product on the tree."""
        n = len(nodes)
        kind = [_EDGE_AT.get(x.tag, len(EDGES) - 1) for x in nodes]
        score = np.clip(node_features(nodes) @ self.unary - self.prior[kind], -5, 5)
        own = np.column_stack([np.zeros(n), score])
        own[0] = (0.0, ROOT)
        hidden = [i for i, x in enumerate(nodes) if x.hidden]
        own[hidden] = (0.0, -50.0)
        pair = self.pair[kind].tolist()
        parent = [x.parent for x in nodes]
        below = own.tolist()  # own potential and messages from children
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            (p00, p01), (p10, p11) = pair[i]
            a, b = below[i]
            m0, m1 = _add(p00 + a, p01 + b), _add(p10 + a, p11 + b)
            top = m0 if m0 > m1 else m1
            up[i] = (m0 - top, m1 - top)
            q = below[parent[i]]
            q[0] += m0 - top
            q[1] += m1 - top
        belief = [list(x) for x in below]
        for i in range(1, n):
            # the parent's belief without this child, through the edge
            a, b = belief[parent[i]][0] - up[i][0], belief[parent[i]][1] - up[i][1]
            (p00, p01), (p10, p11) = pair[i]
            m0, m1 = _add(a + p00, b + p10), _add(a + p01, b + p11)
            top = m0 if m0 > m1 else m1
            belief[i][0] += m0 - top
            belief[i][1] += m1 - top
        x = np.array(belief)
        return 1 / (1 + np.exp(np.clip(x[:, 0] - x[:, 1], -60, 60)))


def _add(a: float, b: float) -> float:
    """log(exp a + exp b)."""
    hi, lo = (a, b) if a > b else (b, a)
    d = lo - hi
    return hi + (math.log1p(math.exp(d)) if d > -30 else 0.0)


def extract(page: str | None, model: Model) -> str:
    """The main text of a page."""
    if not page:
        return ""
    nodes = parse(page)
    keep = model.marginals(nodes) >= 0.5 if len(nodes) > 1 else np.ones(1, dtype=bool)
    if len(nodes) > 1:
        keep[0] = keep[0] and not any(keep[i] for i in range(1, len(nodes)))  # loose text counts where no element does
    pieces = sorted(p for i, x in enumerate(nodes) if keep[i] for p in x.texts)
    blocks, now = [], []
    for _, piece in pieces:
        if piece is None:
            if now:
                blocks.append("".join(now))
                now = []
        else:
            now.append(piece)
    if now:
        blocks.append("".join(now))
    cleaned = (_SPACE.sub(" ", html.unescape(b)).strip() for b in blocks)
    return " ".join(b for b in cleaned if b)


# --- training


def fit(pages: Iterable[str], rounds: int = 15) -> Model:
    """Train on pages whose elements carry ``data-label`` (1: content, 0: not); unmarked elements inherit."""
    rows, labels = [], []
    counts = np.full((len(EDGES), 2, 2), 0.5)
    counts[:, 0, 0] += 1
    for page in pages:
        nodes = parse(page)
        for i, x in enumerate(nodes):
            if x.label < 0:
                x.label = nodes[x.parent].label if i else 0
            if i:
                counts[_EDGE_AT.get(x.tag, len(EDGES) - 1), nodes[x.parent].label, x.label] += 1
        rows.append(node_features(nodes)[1:])
        labels += [x.label for x in nodes[1:]]
    x, y = np.vstack(rows), np.array(labels, dtype=float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton's method with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 2.0 * np.eye(x.shape[1])
        w += np.linalg.solve(h, x.T @ (y - p) - 2.0 * w)
    by_label = counts.sum(axis=1)
    return Model(w, np.log(counts / counts.sum(axis=2, keepdims=True)), np.log(by_label[:, 1] / by_label[:, 0]))


def labelled_pages(n: int = 240, seed: int = 5) -> list[str]:
    """Built-in labelled pages: several layouts, each with a choice of boilerplate around, between and after the article."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("bcdfghlmnprstvw") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    link = lambda a=1, b=3: f'<a href="/{word()}">{words(a, b)}</a>'
    menu = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>"
    cls = lambda kind: r.choice(["class", "id"]) + '="' + r.choice(HINTS[kind].split()) + r.choice(["", "-box", f" {word()}"]) + '"'
    bare = lambda: r.choice(["", "", f' class="{word()}"'])

    def paragraph() -> str:
        body = words(300, 900) if r.random() < 0.05 else words(1, 90)
        if r.random() < 0.25:
            cut = body.find(" ")
            body = f"<b>{body[:cut]}</b>{body[cut:]}" if r.random() < 0.5 else f"{body} {link()} {words(1, 20)}"
        return f"<p>{body}" + r.choice(["</p>", "</p>", ""])

    def content() -> str:
        parts = [f"<h1>{words(2, 12)}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 12)):
            parts.append(r.choice([paragraph] * 9 + [lambda: f"<h2>{words(1, 6)}</h2>", lambda: "<ul>" + "".join(f"<li>{words(2, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>", lambda: f"<blockquote>{words(5, 40)}</blockquote>", lambda: f"<pre>{words(5, 30)}</pre>", lambda: f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>"])())
        return "".join(parts)

    def junk() -> list[str]:
        note = lambda: r.choice([f"<p>{words(3, 30)}</p>", words(3, 30), f"<span>{words(3, 12)}</span> {link()}"])
        return [
            f'<div {cls("ad")} data-label="0">{note()}</div>',
            f'<aside{bare()} data-label="0"><h3>{words(1, 3)}</h3>{r.choice([menu(), note()])}</aside>',
            f'<div {cls("side")} data-label="0">{r.choice([menu(), note()])}</div>',
            f'<div {cls("notice")} data-label="0">{note()}</div>',
            f'<form{bare()} data-label="0"><label>{words(1, 3)}</label><input name="q"><p>{words(2, 12)}</p></form>',
            f'<div {cls("share")} data-label="0">{link()} {link()}</div>',
            f'<div {cls("nav")} data-label="0">{menu()}</div>',
        ]

    def comments() -> str:
        inner = "".join(r.choice([f'<div {cls("comment")}><p>{words(3, 60)}</p></div>', f"<li><p>{words(3, 60)}</p></li>", f"<article><p>{words(3, 60)}</p></article>"]) for _ in range(r.randint(1, 5)))
        return f'<{(t := r.choice(["div", "section"]))} {cls("comment")} data-label="0"><h3>{words(1, 3)}</h3>{inner}</{t}>'

    pages = []
    for _ in range(n):
        holder = r.choice(["article", "article", "article", "main", "div", "section"])
        mark = f" {cls('content')}" if holder in ("div", "section") or r.random() < 0.3 else ""
        body = content()
        if r.random() < 0.5:
            cut = body.find("<p>", len(body) // 2)
            body = body[:cut] + r.choice(junk()) + body[cut:] if cut > 0 else body
        if r.random() < 0.35:
            body += comments()
        core = f'<{holder}{mark} data-label="1">{body}</{holder}>'
        if r.random() < 0.1:  # no holder at all
            core = re.sub(r"<(h1|h2|p|ul|blockquote|pre|table)>", r'<\1 data-label="1">', content())
        elif r.random() < 0.35:
            core = f'<{(t := r.choice(["main", "div"]))}{bare()} data-label="{r.randint(0, 1) if holder == "article" else 1}">{core}</{t}>'
        top = r.choice([f'<nav data-label="0">{menu()}</nav>', f'<header data-label="0"><p>{words(1, 6)}</p>{menu()}</header>', f'<header data-label="0"><h2>{words(1, 4)}</h2><nav>{menu()}</nav></header>', f'<div {cls("frame")} data-label="0">{words(1, 8)}</div>'])
        foot = r.choice([f'<footer data-label="0">&copy; {words(2, 20)}</footer>', f'<footer data-label="0"><p>{words(2, 20)}</p>{menu()}</footer>', f'<div {cls("frame")} data-label="0">{words(2, 20)}</div>'])
        before = "".join(r.sample(junk(), r.randint(0, 2)))
        after = "".join(r.sample(junk(), r.randint(0, 2))) + (comments() if r.random() < 0.4 else "")
        pages.append(f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title></head><body>{top}{before}{core}{after}{foot}</body></html>")
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fit(labelled_pages())


def extract_pages(pages: DataFrame, keep: list[str], model: Model | None = None, html_col: str = "html") -> DataFrame:
    """``keep`` columns of every page with ``text``, its main text."""
    model = model or default_model()
    keep = [c for c in keep if c != "text"]
    picked = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("__html"))
    schema = T.StructType([*(picked.schema[c] for c in keep), T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                texts = [extract(x, model) for x in some.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(some.column(k) for k in range(len(keep))), pa.array(texts, type=pa.string())], names=[*keep, "text"])

    return picked.mapInArrow(run, schema)
