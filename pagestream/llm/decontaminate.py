"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``WINDOW`` consecutive words of the benchmark items
(an item of fewer words is one pattern).  Patterns of one length share a block shift
table (blocks of two words): a cursor skips ahead by the table's shift, a shift of zero
leads to the suffix-hash bucket of the block, and bytes are compared before an
occurrence counts.  The cursors of all segments of a slice move together, so the skip
loop runs on arrays.

The patterns are arrays: the items' words once as bytes, and for each window its place
there, its item and 32 bits of its hash, sorted by suffix block.  That is about three bytes
for each byte of benchmark, and they are built from slices of the items, so neither the
driver nor a task holds more.

The scan is one narrow pass over the documents without a shuffle.  Up to ``BLOCK_BYTES`` of
benchmark text go out at once; a larger benchmark takes more passes chained in one stage,
and the spans found add up.

Defined results: a null or wordless text has no words and no hits; an item with null
id marks words but is not listed; repeated ids count once; an empty benchmark hits
nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textscan import _WEIGHTS, ALNUM, Slice, Words, annotate, mix

WINDOW = 10
BLOCK_BYTES = 64 << 20
#: Bytes of items that are cut into windows at once.
ITEM_BYTES = 1 << 20
SEGMENT = 256
#: Bits of a block's hash that name its bucket, and most bits that place it in the shift table.
BUCKET_BITS, SHIFT_BITS = 16, 22

N_WORDS, SPANS, ITEMS = "n_words", "hit_spans", "hit_items"


def _blocks(h: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Hash of the block of ``width`` words that ends at each word."""
    b = h.copy()
    if width == 2 and len(h):
        b[1:] += h[:-1] * _WEIGHTS[1]
    return (b >> np.uint64(64 - bits)).astype(np.int64)


class _Group:
    """The windows of one length: shift table, suffix-hash buckets and the places of the bytes to compare."""

    def __init__(self, length: int):
        self.length, self.width = length, min(2, length)
        self.bits, self.shift = SHIFT_BITS, np.full(1 << SHIFT_BITS, length - self.width + 1, dtype=np.uint8)
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, hashes: np.ndarray, first: np.ndarray, place: np.ndarray, size: np.ndarray, item: np.ndarray) -> None:
        """Windows from the words ``first`` of ``hashes``; their bytes are at ``place``, ``size`` of them."""
        rows = hashes[first[:, None] + np.arange(self.length)]
        for j in range(self.width - 1, self.length):
            np.minimum.at(self.shift, self.block(rows[:, : j + 1], SHIFT_BITS), self.length - 1 - j)
        block, mark = self.key(rows)
        self.parts.append((block.astype(np.uint16), mark, place, size, item))

    def build(self) -> None:
        """Sort by bucket and mark; the shift table takes as many bits as the windows' blocks fill."""
        block, mark, place, size, item = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((item, mark, block))
        self.mark, self.place, self.size, self.item = mark[order], place[order], size[order], item[order]
        self.bucket = np.searchsorted(block[order], np.arange((1 << BUCKET_BITS) + 1)).astype(np.int64)
        self.bits = min(max((len(block) * self.length).bit_length(), BUCKET_BITS), SHIFT_BITS)
        self.shift = self.shift.reshape(1 << self.bits, -1).min(axis=1)
        del self.parts

    def block(self, rows: np.ndarray, bits: int) -> np.ndarray:
        """Hash of the last block of each row of words."""
        last = rows[:, -1].copy()
        if self.width == 2:
            last += rows[:, -2] * _WEIGHTS[1]
        return (last >> np.uint64(64 - bits)).astype(np.int64)

    def key(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix block (the bucket), and 32 bits of the hash of all words."""
        whole = np.zeros(len(rows), dtype=np.uint64)
        for j in range(self.length):
            whole += rows[:, j] * _WEIGHTS[j]
        return self.block(rows, BUCKET_BITS), (mix(whole) >> np.uint64(32)).astype(np.uint32)

    def find(self, w: Words, raw: bytes, bytes_of: np.ndarray) -> list[tuple[int, int]]:
        """(first word, item) of each occurrence."""
        n, length = len(w.hash), self.length
        if n < length:
            return []
        block = _blocks(w.hash, self.width, self.bits)
        # segments: window ends a..b-1 inside one text
        a, b = w.bound[:-1] + length - 1, w.bound[1:]
        some = b > a
        a, b = a[some], b[some]
        pieces = -(-(b - a) // SEGMENT)
        at = np.repeat(a, pieces) + SEGMENT * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        stop = np.minimum(at + SEGMENT, np.repeat(b, pieces))
        ends = []
        while len(at):
            step = self.shift[block[at]]
            ends.append(at[step == 0])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
        if not len(end):
            return []
        bucket, mark = self.key(w.hash[end[:, None] - np.arange(length - 1, -1, -1)])
        lo, end_of, found = self.bucket[bucket], self.bucket[bucket + 1], []
        hi = end_of.copy()
        while len(open_ := np.flatnonzero(lo < hi)):  # the first place of each mark in its bucket
            mid = (lo[open_] + hi[open_]) // 2
            less = self.mark[mid] < mark[open_]
            lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
        some = np.flatnonzero(lo < end_of)
        for k in some[self.mark[lo[some]] == mark[some]].tolist():
            first = int(end[k]) - length + 1
            seen = b" ".join(raw[s:e] for s, e in zip(w.start[first : first + length].tolist(), w.end[first : first + length].tolist(), strict=True))
            for p in range(int(lo[k]), int(end_of[k])):
                if self.mark[p] != mark[k]:
                    break
                place = int(self.place[p])
                if self.size[p] == len(seen) and bytes_of[place : place + len(seen)].tobytes() == seen:
                    found.append((first, int(self.item[p])))
        return found


class Patterns:
    """The windows of some items, grouped by length; ``items`` may be an iterator."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int):
        self.names: list[str | None] = []
        groups: dict[int, _Group] = {}
        texts, at = [], 0
        for some in _slices_of(items):
            part = Slice.of([t for _, t in some])
            w, raw = part.words(ALNUM, fold=True), part.folded()
            # the words with one space after each; a word's place there
            size = w.end - w.start
            place = np.cumsum(size + 1) - (size + 1)
            flat = np.full(int((size + 1).sum()), 0x20, dtype=np.uint8)
            flat[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = raw[np.repeat(w.start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            texts.append(flat)
            length = np.minimum(w.count, window)
            for n in np.unique(length[length > 0]).tolist():
                group = groups.setdefault(n, _Group(n))
                of = np.flatnonzero(length == n)
                each = w.count[of] - n + 1
                item = np.repeat(of, each)
                first = w.bound[item] + np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
                group.add(w.hash, first, (at + place[first]).astype(np.uint32), (place[first + n - 1] + size[first + n - 1] - place[first]).astype(np.uint32), (len(self.names) + item).astype(np.uint32))
            self.names += [i for i, _ in some]
            at += len(flat)
        self.text = np.concatenate(texts) if texts else np.zeros(0, dtype=np.uint8)
        self.groups = list(groups.values())
        for group in self.groups:
            group.build()


def _slices_of(items: Iterable[tuple[str | None, str | None]]):
    some, held = [], 0
    for item in items:
        some.append(item)
        held += len(item[1] or "")
        if held >= ITEM_BYTES:
            yield some
            some, held = [], 0
    if some:
        yield some


def _factory(patterns: Patterns):
    def start():
        def scan(part: Slice) -> dict:
            w, raw = part.words(ALNUM, fold=True), part.folded().tobytes()
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for group in patterns.groups:
                found = group.find(w, raw, patterns.text)
                docs = np.searchsorted(w.bound, [f for f, _ in found], side="right") - 1
                for (first, item), d in zip(found, docs.tolist(), strict=True):
                    spans.setdefault(d, []).append((first - int(w.bound[d]), first - int(w.bound[d]) + group.length))
                    items.setdefault(d, set()).add(patterns.names[item])
            return {
                N_WORDS: w.count.astype(np.int64),
                SPANS: _lists([_merged(spans[d]) if d in spans else () for d in range(part.n)], pa.int64()),
                ITEMS: _lists([sorted(items[d] - {None}) if d in items else () for d in range(part.n)], pa.string()),
            }

        return scan

    return start


def _lists(rows: list, of: pa.DataType) -> pa.Array:
    return pa.array(rows, type=pa.list_(of))


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted spans without overlap, flat: from, to, from, to..."""
    out: list[int] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _blocks_of(benchmark: DataFrame, item_col: str, text_col: str):
    """Number of blocks, and the items of each block of bounded size, read one by one."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // BLOCK_BYTES))
    parts = (items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n))
    return n, (((r["item"], r["text"]) for r in part.toLocalIterator()) for part in parts)


def find_contamination(documents: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``keep`` columns of every document with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` is flat (from, to, from, to ... in words, to exclusive, merged),
    ``hit_items`` the sorted ids of the items of which a window occurs.
    """
    out = None
    passes, blocks = _blocks_of(benchmark, item_col, item_text_col)
    again = [text_col] if passes > 1 and text_col not in keep else []
    for block in blocks:
        factory = _factory(Patterns(block, window))
        fields = [(N_WORDS, T.LongType()), (SPANS, T.ArrayType(T.LongType())), (ITEMS, T.ArrayType(T.StringType()))]
        if out is None:
            out = annotate(documents, text_col, [*keep, *again], fields, factory)
        else:
            more = annotate(out.withColumnsRenamed({SPANS: "__spans", ITEMS: "__items"}), text_col, [c for c in (*out.columns, "__spans", "__items") if c not in (SPANS, ITEMS, N_WORDS)], fields, factory)
            out = more.withColumns({SPANS: F.expr(f"concat(__spans, {SPANS})"), ITEMS: F.array_sort(F.array_union("__items", ITEMS))}).drop("__spans", "__items")
    return out.drop(*again)


def hit_words() -> F.Column:
    """Number of words inside ``hit_spans`` (spans of several passes may overlap)."""
    pairs = F.expr(f"array_sort(transform(sequence(0, size({SPANS}) - 2, 2), i -> struct({SPANS}[i] as a, {SPANS}[i + 1] as b)))")
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    step = lambda acc, p: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), p["b"] - F.greatest(acc["to"], p["a"]))).alias("n"), F.greatest(acc["to"], p["b"]).alias("to"))
    return F.when(F.size(SPANS) > 0, F.aggregate(pairs, start, step)["n"]).otherwise(F.lit(0).cast("long"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    columns = documents.columns
    own = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)]
    named = documents.select(*own)
    found = find_contamination(named, benchmark, named.columns, text_col=f"__c{columns.index(text_col)}")
    return found.where(F.size(SPANS) == 0).select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)])
