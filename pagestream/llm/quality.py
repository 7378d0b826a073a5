"""Quality rules with adaptive thresholds.

Base counts of every whole text come from one narrow Arrow pass.  The rules then work on
ratios of these counts.  Their cutoffs are not fixed: for each language and source a
quantile sketch of every ratio is kept (relative-error buckets with counts, so sketches
merge by adding counts, in any order and with the same result), and the cutoff is an outer
fence, upper quartile plus ``SPREAD`` interquartile ranges plus the ratio's ``slack``.
The slack keeps a group whose ratios are all alike from rejecting ordinary documents.
A group of fewer than ``LEAST`` documents takes the sketch of its language, and a
language of fewer that of the corpus.  The cutoffs are joined back to the documents.

Defined results: null or wordless texts have zero counts and fail the base rule; null
language and null source are groups of their own; copies count as documents of their
own; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, small
from .textscan import HASH_BITS, LINES, SPACED, Slice, Words, annotate, byte_class

#: Relative error of the sketch is (GAMMA - 1) / (GAMMA + 1).
GAMMA = 1.02
SPREAD = 3.0
LEAST = 64
#: Slack of each ratio.
SLACK = {"symbol_ratio": 0.1, "mark_ratio": 0.25, "upper_ratio": 0.3, "repeat_ratio": 0.2, "dup_line_ratio": 0.5, "word_length": 3.0}

SYMBOLS = byte_class(lambda b: chr(b) in "#*$%&|<>")
MARKS = byte_class(lambda b: chr(b) in "!?#*$%&|<>=+~^_{}[]\\/@")
_UPPER = byte_class(lambda b: 0x41 <= b <= 0x5A)
_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_marks", "n_upper", "n_letters")


def _per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def _keyed(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS))


def _repeated(w: Words, k: int) -> np.ndarray:
    """Words of each text in k-word windows that it has twice or more."""
    at, h = w.windows(k)
    doc = np.searchsorted(w.bound, at, side="right") - 1
    keys = _keyed(doc, h)
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(w.n, dtype=np.int64)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    at = at[twice[place] == keys]
    marks = np.zeros(len(w.hash) + 1, dtype=np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + k, -1)
    return _per_text(np.cumsum(marks[:-1]) > 0, w.bound)


def _count(part: Slice) -> dict:
    w, lines = part.words(SPACED), part.words(LINES)
    inside = np.concatenate([[0], np.cumsum(SPACED[part.data], dtype=np.int64)])
    real = inside[lines.end] > inside[lines.start]
    keys = np.sort(_keyed(lines.doc()[real], lines.hash[real]))
    again = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(HASH_BITS)
    starts = (part.data & 0xC0) != 0x80
    return {
        "n_words": w.count.astype(np.int64),
        "word_chars": _per_text(starts & SPACED[part.data], part.off),
        "n_symbols": _per_text(SYMBOLS[part.data], part.off),
        "n_dup_lines": np.bincount(again.astype(np.int64), minlength=part.n),
        "n_repeat_words": _repeated(w, 5),
        "n_lines": _per_text(real, lines.bound),
        "n_marks": _per_text(MARKS[part.data], part.off),
        "n_upper": _per_text(_UPPER[part.data], part.off),
        "n_letters": _per_text(_LETTER[part.data], part.off),
    }


def text_counts(documents: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every document with its counts."""
    return annotate(documents, text_col, keep, [(n, T.LongType()) for n in (*BASE, *_MORE)], lambda: _count)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    of = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbol_ratio": of("n_symbols", "n_words"),
        "mark_ratio": of("n_marks", "n_words"),
        "upper_ratio": of("n_upper", "n_letters"),
        "repeat_ratio": of("n_repeat_words", "n_words"),
        "dup_line_ratio": of("n_dup_lines", "n_lines"),
        "word_length": of("word_chars", "n_words"),
    }


def sketches(ratios: DataFrame) -> DataFrame:
    """lang, source, ratio, bucket, n: the quantile sketches; adding up n over groups merges them."""
    bucket = F.when(F.col("value") > 1e-6, F.ceil(F.log("value") / F.lit(math.log(GAMMA)))).otherwise(F.lit(-(10**6))).cast("int")
    long = ratios.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(n).alias("ratio"), F.col(n).alias("value")) for n in SLACK])).alias("x"))
    return long.select("lang", "source", "x.ratio", "x.value").groupBy("lang", "source", "ratio", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The outer fence of each ratio in each group, and the group's number of documents."""
    merged = sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "ratio")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    value = F.when(F.col("bucket") > -(10**6), F.pow(F.lit(GAMMA), F.col("bucket")) * (2 / (1 + GAMMA))).otherwise(F.lit(0.0))
    ranked = merged.withColumns({"upto": upto, "of": F.sum("n").over(group), "value": value})
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("of"), F.col("value")))
    found = ranked.groupBy(*by, "ratio").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"), F.max("of").alias("docs"))
    slack = F.element_at(F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv]), F.col("ratio"))
    return found.withColumn("fence", F.col("q3") + SPREAD * (F.col("q3") - F.col("q1")) + slack)


def thresholds(ratios: DataFrame) -> DataFrame:
    """lang, source and one cutoff for each ratio; small groups take their language's or the corpus's."""
    sketch = kept(sketches(ratios))
    own = _fences(sketch, ["lang", "source"])
    lang = _fences(sketch, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("ratio").alias("l_ratio"), F.col("fence").alias("l_fence"), F.col("docs").alias("l_docs"))
    whole = _fences(sketch, []).select(F.col("ratio").alias("w_ratio"), F.col("fence").alias("w_fence"))
    joined = own.join(lang, own["lang"].eqNullSafe(lang["l_lang"]) & (own["ratio"] == lang["l_ratio"])).join(whole, F.col("ratio") == F.col("w_ratio"))
    fence = F.when(F.col("docs") >= LEAST, F.col("fence")).when(F.col("l_docs") >= LEAST, F.col("l_fence")).otherwise(F.col("w_fence"))
    return joined.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(*[F.max(F.when(F.col("ratio") == n, fence)).alias(f"t_{n}") for n in SLACK])


def judge(documents: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, lang, source, the counts, each ratio with its cutoff, ``base_failed`` and ``kept``."""
    named = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("__text"))
    counted = kept(text_counts(named, ["doc_id", "lang", "source"], "__text")).withColumns(_ratios())
    limits = kept(thresholds(counted))
    limits = small(limits, limits.count(), 8 * len(SLACK) + 64)
    joined = counted.join(limits, counted["lang"].eqNullSafe(limits["t_lang"]) & counted["source"].eqNullSafe(limits["t_source"]), "left").drop("t_lang", "t_source")
    failed = base_failed()
    inside = F.lit(True)
    for n in SLACK:
        inside &= F.col(n) <= F.coalesce(F.col(f"t_{n}"), F.lit(float("inf")))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & inside})
