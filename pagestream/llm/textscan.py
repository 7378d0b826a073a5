"""Vectorised scanning of whole texts inside ``mapInArrow`` tasks.

A text column arrives as one Arrow byte buffer with offsets.  Everything here works
on that buffer with numpy: no per-word Python objects and no per-row Python calls.
A batch is cut into slices of about ``SLICE_BYTES`` of text (a longer text is a slice
of its own), so the scratch memory of a task does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

SLICE_BYTES = 1 << 20
SLICE_DOCS = 1 << 12
#: Bits of a shingle's hash that are kept; the others number the texts of a slice.
HASH_BITS = 52

TEXT = "__scan_text"

ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
    T.ArrayType(T.LongType()): pa.list_(pa.int64()),
    T.ArrayType(T.DoubleType()): pa.list_(pa.float64()),
}

_RNG = np.random.default_rng(20_240_117)
_BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_WEIGHTS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def byte_class(is_word: Callable[[int], bool]) -> np.ndarray:
    """256 booleans: which bytes of UTF-8 belong to a word."""
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Words between ASCII white space.
SPACED = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Runs of digits, ASCII letters and everything beyond ASCII.
ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isascii() and chr(b).isalnum())
#: Lines.
LINES = byte_class(lambda b: b != 0x0A)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES + 4096)
            for name, base in (("up", _BASE), ("down", _UNBASE)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                setattr(cls, name, np.cumprod(p, dtype=np.uint64))
        return cls.up, cls.down


class Slice:
    """Some consecutive texts: ``data`` (bytes, as they are) and ``off`` (bounds of the texts in it)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1

    @classmethod
    def of(cls, texts: Sequence[str | None]) -> Slice:
        raw = [(t or "").encode() for t in texts]
        off = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) for r in raw], out=off[1:])
        return cls(np.frombuffer(b"".join(raw), dtype=np.uint8), off)

    def folded(self) -> np.ndarray:
        """The bytes with A-Z lower-cased."""
        return _FOLD[self.data]

    def words(self, word_bytes: np.ndarray, fold: bool = False, hashed: bool = True) -> Words:
        return Words(self, word_bytes, fold, hashed)


class Words:
    """The words of a slice: ``start`` and ``end`` (bytes), ``hash``, and ``bound``: the words of text i are bound[i]..bound[i+1]."""

    def __init__(self, of: Slice, word_bytes: np.ndarray, fold: bool, hashed: bool):
        data, off = of.data, of.off
        self.slice, self.n = of, of.n
        inside = word_bytes[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            at = off[:-1][off[:-1] < off[1:]]
            first[at] = inside[at]
            at = off[1:][off[:-1] < off[1:]] - 1
            last[at] = inside[at]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bound = np.searchsorted(self.start, off)
        self.count = np.diff(self.bound)
        self.hash = self._hashes(of, fold) if hashed else None

    def _hashes(self, of: Slice, fold: bool) -> np.ndarray:
        n = len(of.data)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        up, down = _Powers.of(n)
        code = _BYTE_CODE[_FOLD] if fold else _BYTE_CODE
        sums = code[of.data]
        sums *= up[:n]
        np.cumsum(sums, out=sums)
        self._sums, self._down = sums, down
        return self._hash_to(np.arange(len(self.start)), self.end)

    def _hash_to(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = self.start[words]
        h = self._sums[end - 1]
        h -= np.where(start > 0, self._sums[start - 1], np.uint64(0))
        h *= self._down[start]
        return mix(h)

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash of its first n bytes) of the words of more than n bytes."""
        words = np.flatnonzero(self.end - self.start > n)
        return words, self._hash_to(words, self.start[words] + n) if len(words) else np.zeros(0, dtype=np.uint64)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.n), self.count)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(np.repeat(self.bound[1:], self.count)[:n] - np.arange(n) >= k)
        h = self.hash[:n] * _WEIGHTS[0]
        for j in range(1, k):
            h += self.hash[j : n + j] * _WEIGHTS[j]
        return at, mix(h[at])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash of HASH_BITS bits) of the distinct k-word shingles, sorted by text and hash.

        A text of fewer than k words has its whole word sequence as one shingle, a
        text without words has none.
        """
        at, h = self.windows(k)
        doc = np.searchsorted(self.bound, at, side="right") - 1
        few = np.flatnonzero((self.count > 0) & (self.count < k))
        if len(few):
            whole = self.count[few].astype(np.uint64) * _SHORT
            for j in range(k - 1):
                has = self.count[few] > j
                whole[has] += self.hash[self.bound[few[has]] + j] * _WEIGHTS[j]
            doc, h = np.concatenate([doc, few]), np.concatenate([h, mix(whole)])
        key = (doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS))
        key.sort()
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & np.uint64((1 << HASH_BITS) - 1)


def slices(column: pa.Array) -> Iterator[tuple[int, int, Slice]]:
    """(from, to, slice) over an Arrow string column; null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1
        j = min(max(j, i + 1), i + SLICE_DOCS, len(column))
        yield i, j, Slice(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def annotate(df: DataFrame, text_col: str, keep: Sequence[str], fields: Sequence[tuple[str, T.DataType]], factory: Callable[[], Callable[[Slice], dict]]) -> DataFrame:
    """``keep`` columns of every row plus computed ``fields``; one narrow Arrow pass, no shuffle.

    ``factory()`` is called once in each task and gives a function from a slice to one
    array for each field.  A kept column with the name of a field gives way to it.
    """
    small_batches(df.sparkSession)
    names = {n for n, _ in fields}
    keep = [c for c in keep if c not in names]
    picked = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(TEXT))
    schema = T.StructType([*(picked.schema[c] for c in keep), *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = factory()
        for batch in batches:
            for i, j, part in slices(batch.column(len(keep))):
                got = scan(part)
                arrays = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                arrays += [x if isinstance(x := got[n], pa.Array) else pa.array(x, type=ARROW[t]) for n, t in fields]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(n for n, _ in fields)])

    return picked.mapInArrow(run, schema)
