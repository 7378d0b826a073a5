"""Functions that need Python, each in Arrow batches: references, JSON scan, whitelist, tokens."""

from __future__ import annotations

import codecs
import html
import json
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text of an Arrow batch that are Python objects at one time; a longer row is alone.
PIECE_BYTES = 1 << 20


def _pieces(columns: Sequence[pa.Array]) -> Iterator[list[list]]:
    """The rows of a batch in order, as lists of a column's values, PIECE_BYTES at a time."""
    texts = [c for c in columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    ends = np.cumsum(sum((pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype("int64") for c in texts), np.full(len(columns[0]), 8)))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right")))
        yield [c.slice(at, to - at).to_pylist() for c in columns]
        at = to


def _rowwise(f, returns):
    """Arrow UDF of a function of plain values. Not an iterator, so that all of a query share a worker."""

    @F.arrow_udf(returns)
    def run(*columns: pa.Array) -> pa.Array:
        kind = to_arrow_type(returns)
        return pa.concat_arrays([pa.array([], type=kind), *(pa.array(list(map(f, *piece)), type=kind) for piece in _pieces(columns))])

    return run


def _mapped(f, returns):
    return _rowwise(lambda x: None if x is None else f(x), returns)


def html_unescape(c: Column) -> Column:
    """Character references decoded; a text without ``&`` holds none and is not looked at in Python."""
    held = F.when(F.contains(c, F.lit("&")), c)
    return F.coalesce(_mapped(html.unescape, T.StringType())(held), c)


def balanced_json(text: Column) -> Column:
    """The first balanced ``{...}`` of a text, aware of strings and escapes; null where none is closed."""
    return _mapped(first_object, T.StringType())(text)


def json_objects(text: Column, marker: str = "") -> Column:
    """Every JSON object that parses, from each place after a marker (a brace without an object is passed over)."""
    return _mapped(lambda x: objects_after(x, marker), T.ArrayType(T.StringType()))(text)


_MARKS = re.compile(r"[{}\"\\]")


def first_object(text: str) -> str | None:
    """The outermost closed object that starts first; a brace that is never closed holds back none. One pass."""
    opened: list[int] = []
    best, quoted, skip = (len(text), 0), False, -1
    for m in _MARKS.finditer(text):
        mark, i = m[0], m.start()
        if i == skip:
            continue
        if quoted:
            skip, quoted = (i + 1 if mark == "\\" else skip), mark != '"'
        elif mark == '"':
            quoted = bool(opened)
        elif mark == "{":
            opened.append(i)
        elif mark == "}" and opened:
            best = min(best, (opened.pop(), i + 1))
            if not opened:
                break
    return text[best[0] : best[1]] if best[1] else None


def objects_after(text: str, marker: str = "") -> list[str]:
    decoder, found, at = json.JSONDecoder(), [], text.find(marker)
    while at >= 0 and (at := text.find("{", at + len(marker) if marker else at)) >= 0:
        try:
            _, end = decoder.raw_decode(text, at)
            found.append(text[at:end])
        except ValueError:
            end = at + 1
        at = text.find(marker, end) if marker else end
    return found


def valid_json(c: Column) -> Column:
    """Whether a text parses as JSON."""

    def ok(x: str) -> bool:
        try:
            json.loads(x)
        except ValueError:
            return False
        return True

    return F.coalesce(_mapped(ok, T.BooleanType())(c), F.lit(False))


def decode_escapes(c: Column) -> Column:
    """Text of a script attribute: references decoded twice, then backslash escapes."""

    def run(x: str) -> str:
        plain = html.unescape(html.unescape(x))
        if "\\" not in plain:
            return plain
        try:
            return codecs.decode(plain.encode("latin-1", "backslashreplace"), "unicode_escape")
        except UnicodeDecodeError:
            return plain

    return _mapped(run, T.StringType())(c)


def absolute_url(base: Column, ref: Column) -> Column:
    """``ref`` resolved against ``base``."""
    return _rowwise(lambda b, r: None if r is None else urljoin(b or "", r), T.StringType())(base, ref)


# What the whitelist keeps, unwraps into headings, and drops with its content.
KEPT_BLOCKS = frozenset("p ul ol li blockquote h2 h3 h4 table thead tbody tr th td figure figcaption".split())
KEPT_INLINE = frozenset("a strong b em i sup sub br img span code".split())
DROPPED = frozenset("script style noscript iframe form button svg nav header footer".split())
RENAMED = {"h1": "h2", "h5": "h4", "h6": "h4"}
_VOID = frozenset(("br", "img"))


class _Whitelist(HTMLParser):
    """Serialises what a whitelist keeps; unknown elements are unwrapped, empty paragraphs dropped."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.out, self.open, self.skip = base, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in DROPPED:
            self.skip += 1
        if self.skip:
            return
        tag = RENAMED.get(tag, tag)
        if tag not in KEPT_BLOCKS and tag not in KEPT_INLINE or tag == "span":
            return
        given = dict(attrs)
        shown = ""
        if tag == "a":
            href = (given.get("href") or "").strip()
            if not href or href.startswith("#"):
                return
            shown = f' href="{html.escape(urljoin(self.base, href))}"'
        elif tag == "img":
            src = given.get("src") or ""
            if not src or src.startswith("data:"):
                src = (given.get("srcset") or given.get("data-src") or "").split(",")[0].strip().split(" ")[0]
            if not src or src.startswith("data:"):
                return
            shown = f' src="{html.escape(urljoin(self.base, src))}" alt="{html.escape(given.get("alt") or "")}"'
        self.out.append(f"<{tag}{shown}>")
        if tag not in _VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in DROPPED:
            self.skip = max(0, self.skip - 1)
            return
        tag = RENAMED.get(tag, tag)
        if self.skip or tag not in self.open:
            return
        while self.open:
            last = self.open.pop()
            self.out.append(f"</{last}>")
            if last == tag:
                break

    def handle_data(self, data):
        if not self.skip:
            self.out.append(html.escape(data, quote=False))

    def text(self) -> str:
        while self.open:
            self.out.append(f"</{self.open.pop()}>")
        done = "".join(self.out)
        for tag in ("p", "li", "h2", "h3", "h4", "figure"):
            for gap in ("", " ", "\n"):
                done = done.replace(f"<{tag}>{gap}</{tag}>", "")
        return done.strip()


def whitelisted(markup: str, base: str = "") -> str:
    parser = _Whitelist(base)
    parser.feed(markup)
    parser.close()
    return parser.text()


def whitelist_html(markup: Column, base: Column) -> Column:
    """Markup reduced to the whitelist, links and images made absolute."""
    return _rowwise(lambda m, b: None if m is None else whitelisted(m, b or ""), T.StringType())(markup, base)


TOKENS = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("pos", T.IntegerType()), ("depth", T.IntegerType()), ("path", T.StringType()), ("tag", T.StringType()), ("attrs", T.MapType(T.StringType(), T.StringType())), ("text", T.StringType()))]))


class _Tokens(HTMLParser):
    """Elements in page order with depth, path of positions, attributes and own text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.stack = [], []

    def handle_starttag(self, tag, attrs):
        at = len(self.rows)
        path = (self.rows[self.stack[-1]]["path"] if self.stack else "") + f"/{at}"
        self.rows.append({"pos": at, "depth": len(self.stack), "path": path, "tag": tag, "attrs": [(k, v or "") for k, v in dict(attrs).items()], "text": ""})
        if tag not in ("br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"):
            self.stack.append(at)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.rows[self.stack[k]]["tag"] == tag:
                del self.stack[k:]
                break

    def handle_data(self, data):
        if self.stack and data.strip():
            row = self.rows[self.stack[-1]]
            row["text"] = f"{row['text']} {data.strip()}".strip()


def tokens(markup: str) -> list[dict]:
    parser = _Tokens()
    parser.feed(markup)
    parser.close()
    return parser.rows


def html_tokens(markup: Column) -> Column:
    """ARRAY of the page's elements (explode it for a component table; paths give ancestors)."""

    @F.arrow_udf(TOKENS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = to_arrow_type(TOKENS)
        for batch in batches:
            for (pages,) in _pieces([batch]):
                yield pa.array([None if x is None else tokens(x) for x in pages], type=kind)

    return run(markup)


def first_inside(elements: Column, path: Column, wanted) -> Column:
    """First element below ``path`` that the condition accepts (elements as of html_tokens)."""
    return F.get(F.filter(elements, lambda t: F.startswith(t["path"], F.concat(path, F.lit("/"))) & wanted(t)), F.lit(0))


def nearest_ancestor(elements: Column, path: Column, attr: str) -> Column:
    """Value of an attribute at the nearest ancestor that has it."""
    above = F.filter(elements, lambda t: F.startswith(path, F.concat(t["path"], F.lit("/"))) & F.map_contains_key(t["attrs"], F.lit(attr)))
    return F.try_element_at(F.try_element_at(above, F.lit(-1))["attrs"], F.lit(attr))


def following_siblings(elements: Column, path: Column, n: int, tags: Sequence[str]) -> Column:
    """The first n following siblings of some tags."""
    parent = lambda p: F.regexp_replace(p, r"/[0-9]+$", "")
    place = lambda p: F.regexp_extract(p, r"([0-9]+)$", 1).cast("int")
    after = F.filter(elements, lambda t: (parent(t["path"]) == parent(path)) & (place(t["path"]) > place(path)) & t["tag"].isin(list(tags)))
    return F.slice(after, 1, n)
