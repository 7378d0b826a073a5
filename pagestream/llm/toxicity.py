"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a fixed and of a learned lexicon (words and word
stems), the nearness of lexicon words to second-person pronouns, and rates of capitals,
punctuation and obfuscation.  The learned lexicon comes from one part of a bounded sample
of labelled rows (``TRAIN_ROWS`` expected rows), by log odds of document frequency; the
trees learn from the other part, so they see lexicon features as they are on new texts.
Isotonic regression on out-of-fold tree scores gives the calibrated probability.

Scoring is one narrow pass over the whole texts.

Defined results: null and empty texts have zero features and get the score of such a
text; labels of unknown documents or without a value are ignored; a document with several
labels counts as toxic if one says so; without labels every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, small, unkept
from .textscan import ALNUM, HASH_BITS, TEXT, Slice, Words, annotate, byte_class, mix, slices

#: Bound on the expected number of labelled rows that training reads.
TRAIN_ROWS = 16_384
LEXICON = 2048
STEMS = (3, 4, 5, 6)
THRESHOLD = 0.7
NEAR = 6

# Words of abuse and pronouns of the second person.
ABUSE = "idiot idiots moron morons stupid dumb loser losers trash scum clown clowns pathetic worthless disgusting fool fools jerk imbecile garbage filth ugly vermin hate shut".split()
SECOND_PERSON = "you your yours yourself u ur tu te toi ton tes vous votre vos du dich dir dein deine ihr euch tú ti usted ustedes vosotros".split()

FEATURES = ("log_words", "abuse_density", "abuse_hits", "learned_density", "learned_max", "learned_hits", "near_second_person", "second_person", "upper_ratio", "shouted_words", "exclamations", "questions", "symbols", "mixed_words", "stretched")

_UPPER = byte_class(lambda b: 0x41 <= b <= 0x5A)
_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_DIGIT = byte_class(lambda b: 0x30 <= b <= 0x39)
_SYMBOL = byte_class(lambda b: chr(b) in "#*$%&|<>@^~")
_BANG = byte_class(lambda b: b == 0x21)
_ASK = byte_class(lambda b: b == 0x3F)


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(Slice.of([" ".join(words)]).words(ALNUM, fold=True).hash)


_ABUSE, _SECOND = _word_hashes(ABUSE), _word_hashes(SECOND_PERSON)


def _isin(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(h), dtype=bool)
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h


def _kinds(w: Words):
    """(word, key) of whole words and stems; keys of different kinds differ."""
    yield np.arange(len(w.hash)), mix(w.hash + np.uint64(1))
    for n in STEMS:
        words, h = w.prefixes(n)
        yield words, mix(h + np.uint64(n << 8))


class Lexicon:
    """Keys of words and stems (their highest HASH_BITS bits) with their weights."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(keys >> np.uint64(HASH_BITS - 16)).astype(np.int64)] = True

    def weigh(self, w: Words) -> np.ndarray:
        """The highest weight of each word's keys, 0 without."""
        out = np.zeros(len(w.hash))
        for words, keys in _kinds(w):
            keys = keys >> np.uint64(64 - HASH_BITS)
            some = np.flatnonzero(self.maybe[(keys >> np.uint64(HASH_BITS - 16)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, keys[some]), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == keys[some] if len(self.keys) else np.zeros(len(some), dtype=bool)
            word = words[some[hit]]  # a word once in each kind
            out[word] = np.maximum(out[word], self.weights[at[hit]])
        return out


def _per(mask: np.ndarray, bound: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(mask, dtype=np.float64)])
    return sums[bound[1:]] - sums[bound[:-1]]


def features(part: Slice, lexicon: Lexicon) -> np.ndarray:
    """One row of FEATURES for each text."""
    w = part.words(ALNUM, fold=True)
    n = np.maximum(w.count, 1)
    size = np.maximum(np.diff(part.off), 1)
    abuse, second, learned = _isin(w.hash, _ABUSE), _isin(w.hash, _SECOND), lexicon.weigh(w)
    strong = (learned > 0) | abuse
    near = np.zeros(len(strong), dtype=bool)
    if second.any():
        doc, at = w.doc(), np.flatnonzero(second)
        hits = np.flatnonzero(strong)
        right = np.minimum(np.searchsorted(at, hits), len(at) - 1)
        left = np.maximum(right - 1, 0)
        for side in (left, right):
            near[hits] |= (np.abs(at[side] - hits) <= NEAR) & (doc[at[side]] == doc[hits])
    length = w.end - w.start
    ups, digits, letters = (np.concatenate([[0], np.cumsum(c[part.data], dtype=np.int64)]) for c in (_UPPER, _DIGIT, _LETTER))
    inside = lambda sums: sums[w.end] - sums[w.start]
    shouted = (inside(ups) == length) & (length > 2)
    mixed = (inside(digits) > 0) & (inside(letters) > 1)
    b = part.data
    run = np.zeros(len(b), dtype=bool)
    if len(b) > 2:
        run[2:] = (b[2:] == b[1:-1]) & (b[1:-1] == b[:-2]) & _LETTER[b[2:]]
    upper, letter = _per(_UPPER[b], part.off), np.maximum(_per(_LETTER[b], part.off), 1)
    top = np.zeros(w.n)
    np.maximum.at(top, w.doc()[learned > 0], learned[learned > 0])
    columns = (
        np.log1p(w.count), _per(abuse, w.bound) / n, np.log1p(_per(abuse, w.bound)), _per(learned, w.bound) / n, top, np.log1p(_per(learned > 0, w.bound)),
        _per(near, w.bound) / np.maximum(_per(strong, w.bound), 1), _per(second, w.bound) / n, upper / letter, _per(shouted, w.bound) / n,
        _per(_BANG[b], part.off) / size, _per(_ASK[b], part.off) / size, _per(_SYMBOL[b], part.off) / size, _per(mixed, w.bound) / n, _per(run, part.off) / size,
    )
    return np.column_stack(columns)


class Trees:
    """Gradient-boosted trees for the logistic loss on histograms of at most 32 bins a feature."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, least: int = 5):
        self.trees, self.depth, self.rate, self.least = trees, depth, rate, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)[1:-1])) for k in range(x.shape[1])]
        bins = np.column_stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)])
        score, self.nodes = np.full(len(y), self.start), []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, cut_at = np.zeros(2**self.depth - 1, dtype=int), np.full(2**self.depth - 1, np.inf)
            where = np.zeros(len(y), dtype=int)
            for node in range(2**self.depth - 1):
                rows = np.flatnonzero(where == node)
                best = (1e-6, 0, np.inf, 0)
                for k, c in enumerate(cuts):
                    if not len(c) or len(rows) < 2 * self.least:
                        continue
                    b = bins[rows, k]
                    sg, sh, sn = (np.cumsum(np.bincount(b, weights=v, minlength=len(c) + 1))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
                    tg, th = g[rows].sum(), h[rows].sum()
                    gain = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                    gain[(sn < self.least) | (len(rows) - sn < self.least)] = -1
                    if gain.max() > best[0]:
                        best = (float(gain.max()), k, float(c[gain.argmax()]), int(gain.argmax()))
                feature[node], cut_at[node] = best[1], best[2]
                right = bins[rows, best[1]] > best[3] if np.isfinite(best[2]) else np.zeros(len(rows), dtype=bool)
                where[rows] = 2 * node + 1 + right
            leaf = where - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, weights=g, minlength=2**self.depth) / (np.bincount(leaf, weights=h, minlength=2**self.depth) + 1)
            score = score + value[leaf]
            self.nodes.append((feature, cut_at, value))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut_at, value in self.nodes:
            at = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut_at[at])
            out += value[at - (2**self.depth - 1)]
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing (score, probability) knots."""
    at, inverse, count = np.unique(score, return_inverse=True, return_counts=True)  # equal scores are one block
    blocks: list[list[float]] = []  # sum of y, weight, sum of scores
    for s, v, n in zip(at.tolist(), np.bincount(inverse, weights=y).tolist(), count.tolist(), strict=True):
        blocks.append([v, float(n), s * n])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.01) / (b[1] + 0.02) for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def probability(self, x: np.ndarray) -> np.ndarray:
        raw = self.trees.score(x)
        # between equal knots a slope keeps the order of the trees' scores
        return np.clip(0.999 * np.interp(raw, *self.knots) + 0.001 / (1 + np.exp(-raw)), 0, 1)


def _doc_frequencies(batches):
    """(key, toxic documents, other documents) of each batch."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        keys, marks = [], []
        for i, j, part in slices(batch.column(0)):
            w = part.words(ALNUM, fold=True)
            doc = w.doc()
            pair = np.concatenate([(doc[words].astype(np.uint64) << np.uint64(HASH_BITS)) | (key >> np.uint64(64 - HASH_BITS)) for words, key in _kinds(w)])
            pair = np.unique(pair)
            keys.append(pair & np.uint64((1 << HASH_BITS) - 1))
            marks.append(toxic[i:j][(pair >> np.uint64(HASH_BITS)).astype(np.int64)])
        if not keys:
            continue
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        mark = np.concatenate(marks)
        a, b = np.bincount(at, weights=mark, minlength=len(key)), np.bincount(at, weights=1 - mark, minlength=len(key))
        yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], names=["key", "a", "b"])


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on about ``rows`` rows of ``labels`` (all of them where there are fewer)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = kept(known)
    total = known.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "id"), F.lit(1_000_003)) / 1_000_003.0
    picked = known.where(draw < min(1.0, rows / total)).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(10)))
    texts = documents.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    picked = kept(picked)
    sample = kept(texts.join(small(picked, picked.count(), 32), F.col("doc") == F.col("id")).select(F.coalesce("text", F.lit("")).alias(TEXT), F.col("label").cast("double").alias("label"), "part"))
    seen = sample.where("part < 5").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).first()
    a, b = seen["a"] or 0.0, seen["b"] or 0.0
    counts = sample.where("part < 5").select(TEXT, "label").mapInArrow(_doc_frequencies, "key long, a long, b long").groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (a + 1)) - F.log((F.col("b") + 0.5) / (b + 1))
    top = counts.where(F.col("a") >= 3).withColumn("odds", odds).where("odds > 2").orderBy(F.desc(F.col("odds") * F.log1p("a")), "key").limit(LEXICON).toArrow()
    lexicon = Lexicon(top["key"].to_numpy().astype(np.uint64), top["odds"].to_numpy())

    def rows_of(batches):
        for batch in batches:
            for i, j, part in slices(batch.column(0)):
                x = features(part, lexicon)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), pa.array(list(x), type=pa.list_(pa.float64()))], names=["label", "x"])

    fit = sample.where("part >= 5").select(TEXT, "label").mapInArrow(rows_of, "label double, x array<double>").toArrow()
    unkept(sample, picked, known)
    if not len(fit):
        return None
    x, y = np.array(fit["x"].to_pylist()), fit["label"].to_numpy()
    order = np.lexsort(np.column_stack([x, y]).T)  # the same model whatever the order of the tasks
    x, y = x[order], y[order]
    fold = np.random.default_rng(7).permutation(len(y)) % 5
    raw = np.zeros(len(y))
    for k in range(5):
        if (fold == k).any() and (fold != k).any():
            raw[fold == k] = Trees().fit(x[fold != k], y[fold != k]).score(x[fold == k])
    return Model(lexicon, Trees().fit(x, y), isotonic(raw, y))


def score(documents: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns with ``score`` (0 to 1) and ``predicted`` (score >= THRESHOLD)."""
    if model is None:
        return documents.select(*keep).withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    def start():
        return lambda part: {"score": (p := model.probability(features(part, model.lexicon))), "predicted": (p >= THRESHOLD).astype(np.int32)}

    return annotate(documents, text_col, keep, [("score", T.DoubleType()), ("predicted", T.IntegerType())], start)
