"""Language identification by multilingual mixture inference.

Training counts hashed byte trigrams per language on a bounded sample of labelled rows
(``TRAIN_ROWS`` expected rows, drawn by a hash of the id; whole texts).  Trigrams with
like likelihoods over the languages share a code (weighted k-means on the log
likelihoods), so a document is a histogram over a few hundred codes.

Inference treats a document as a mixture of languages: expectation-maximisation
estimates the proportions from the codes' likelihoods.  The language set starts with the
best single language and grows by the language that raises the likelihood most, as long
as the gain exceeds the penalty; the proportions come from the set chosen.  A last
expectation-maximisation sets that mixture against text of no language, in which every
trigram is equally likely: ``background`` is the part of the text that no learned language
explains.  ``explained`` turns both into a decision on documents.

Every value of the language column is learned, however many there are.  Counts are kept
for the pairs of language and trigram that occur, so what training holds is bounded by the
sampled text; the dense tables are of the model itself.

Defined results: a null text or a text without a letter is ``und`` with score 0 and
background 1; texts of unseen trigrams get the most frequent language of the training
rows; without training rows everything is ``und``; copies and repeated rows count by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, small, unkept
from .textscan import _FOLD, TEXT, Slice, annotate, slices

#: Bound on the expected number of labelled rows that training reads as text; a language has one row at least.
TRAIN_ROWS = 8192
GRAM_BITS = 15
#: Codes of trigrams: at least so many, and so many for each language.
CODES, CODES_EACH = 192, 4
ROUNDS = 12
#: A trigram shares its bytes with its neighbours, so likelihoods count a third.
OVERLAP = 3.0
PENALTY = 6.0
LEAST_SHARE = 0.08
UNKNOWN = "und"


def _grams(part: Slice) -> np.ndarray:
    """Hashed trigram at each byte; 2^GRAM_BITS at the last two bytes of a text."""
    b = _FOLD[part.data].astype(np.uint32)
    n = len(b)
    out = np.full(n, 1 << GRAM_BITS, dtype=np.int64)
    if n >= 3:
        g = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        g *= np.uint32(2654435761)
        out[:-2] = g >> np.uint32(32 - GRAM_BITS)
    for back in (1, 2):
        at = part.off[1:][np.diff(part.off) >= back] - back
        out[at] = 1 << GRAM_BITS
    return out


@dataclass
class Model:
    """``code``: the code of each hashed trigram; ``p``: likelihood of each code in each language.

    ``unseen``: likelihood of all trigrams that training did not see, by language; ``plain``:
    likelihood of each code (unseen ones first) where every trigram is equally likely.
    """

    languages: list[str]
    code: np.ndarray
    p: np.ndarray
    prior: np.ndarray
    unseen: np.ndarray
    plain: np.ndarray


def held_out(id_col: Column, of: int, left: int) -> Column:
    """crc32 of the id as text leaves ``left``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(of)) == left, F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on a sample of ``rows`` expected rows of ``labelled`` with a language and a text."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    draw = F.pmod(F.xxhash64(F.lit("train"), "id", F.length("text")), F.lit(1_000_003)) / 1_000_003.0
    counts = kept(usable.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("rows"), F.min(draw).alias("first")))
    per = counts.orderBy(F.desc("rows"), "l").collect()
    if not per:
        return None
    languages = [r["l"] for r in per]
    # rare languages are drawn at a higher rate, each up to its even part of the bound, and none is left out
    even = max(1, rows // len(languages))
    rates = counts.select("l", F.greatest("first", F.lit(float(even)) / F.col("rows")).alias("rate"))
    sample = usable.join(small(rates, len(languages), 64), F.col("lang") == F.col("l")).where(draw <= F.col("rate")).select("lang", F.col("text").alias(TEXT))
    place = {x: i for i, x in enumerate(languages)}

    def count(batches):
        keys, sums, held = [], [], 0
        for batch in batches:
            for i, j, part in slices(batch.column(1)):
                gram = _grams(part)
                lang = np.repeat(np.array([place[x] for x in batch.column(0).slice(i, j - i).to_pylist()], dtype=np.int64), np.diff(part.off))
                key, n = np.unique((lang << GRAM_BITS | gram)[gram < 1 << GRAM_BITS], return_counts=True)
                keys, sums, held = [*keys, key], [*sums, n], held + len(key)
                if held > 4_000_000:
                    key, n = _summed(keys, sums)
                    keys, sums, held = [key], [n], len(key) // 2
        if keys:
            key, n = _summed(keys, sums)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counted = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    unkept(counts)
    return _coded(languages, counted["key"].to_numpy(), counted["n"].to_numpy(), np.array([r["rows"] for r in per], dtype=float))


def _summed(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate(sums), minlength=len(key)).astype(np.int64)


class _Likelihoods:
    """P(trigram | language) from counts of the pairs that occur (key: language, trigram), dense for some trigrams at a time."""

    def __init__(self, languages: int, key: np.ndarray, n: np.ndarray):
        order = np.lexsort((key >> GRAM_BITS, key & ((1 << GRAM_BITS) - 1)))
        gram, self.lang, n = (key & ((1 << GRAM_BITS) - 1))[order], (key >> GRAM_BITS)[order], n[order]
        self.total = np.bincount(self.lang, weights=n, minlength=languages) + 0.1 * (1 << GRAM_BITS)
        self.base, self.p = 0.1 / self.total, (n + 0.1) / self.total[self.lang]
        self.seen, first = np.unique(gram, return_index=True)
        self.bound = np.append(first, len(gram))
        self.step = max(64, (1 << 21) // languages)

    def blocks(self):
        """(from, to, table of the trigrams seen in that range by language)."""
        for i in range(0, len(self.seen), self.step):
            j = min(i + self.step, len(self.seen))
            table = np.tile(self.base, (j - i, 1))
            lo, hi = self.bound[i], self.bound[j]
            table[np.repeat(np.arange(j - i), np.diff(self.bound[i : j + 1])), self.lang[lo:hi]] = self.p[lo:hi]
            yield i, j, table


def _by_code(near: np.ndarray, rows: np.ndarray, codes: int) -> np.ndarray:
    """Sum of the rows of each code."""
    out = np.zeros((codes, rows.shape[1]))
    order = np.argsort(near, kind="stable")
    used, first = np.unique(near[order], return_index=True)
    out[used] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _coded(languages: list[str], key: np.ndarray, n: np.ndarray, weight: np.ndarray) -> Model:
    known = _Likelihoods(len(languages), key, n)
    seen = len(known.seen)
    mass = np.concatenate([t.sum(axis=1) for _, _, t in known.blocks()]) if seen else np.zeros(0)
    centred = lambda t: (x := np.log(t)) - x.mean(axis=1, keepdims=True)
    codes = min(max(CODES, CODES_EACH * len(languages)), seen)
    first = np.zeros(seen, dtype=bool)
    first[np.argsort(-mass, kind="stable")[:codes]] = True
    centres = np.concatenate([centred(t[first[i:j]]) for i, j, t in known.blocks()]) if seen else np.zeros((0, len(languages)))
    near = np.zeros(seen, dtype=np.int64)
    for _ in range(8):
        moved, total = np.zeros_like(centres), np.zeros(codes)
        length = (centres**2).sum(axis=1)
        for i, j, t in known.blocks():
            x = centred(t)
            near[i:j] = (length - 2 * x @ centres.T).argmin(axis=1)
            moved += _by_code(near[i:j], x * mass[i:j, None], codes)
            total += np.bincount(near[i:j], weights=mass[i:j], minlength=codes)
        centres = np.where(total[:, None] > 0, moved / np.maximum(total, 1e-300)[:, None], centres)
    code = np.zeros((1 << GRAM_BITS) + 1, dtype=np.int64)
    code[known.seen] = near + 1  # code 0: unseen, without information on the language
    q = np.ones((codes + 1, len(languages)))
    q[1:] = 1e-12 + sum((_by_code(near[i:j], t, codes) for i, j, t in known.blocks()), np.zeros((codes, len(languages))))
    unseen = (1 << GRAM_BITS) - seen
    plain = np.concatenate([[unseen], np.bincount(near, minlength=codes)]) / (1 << GRAM_BITS)
    return Model(languages, code, q, weight / weight.sum(), unseen * known.base, plain)


def _em(counts: np.ndarray, p: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood; p is (codes, sets) or one such table per document."""
    share = np.full((len(counts), p.shape[-1]), 1.0 / p.shape[-1])
    n = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    for _ in range(rounds):
        mixed = share @ p.T if p.ndim == 2 else np.einsum("dk,dck->dc", share, p)
        r = counts / np.maximum(mixed, 1e-300)
        share = share * (r @ p if p.ndim == 2 else np.einsum("dc,dck->dk", r, p)) / n
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    mixed = share @ p.T if p.ndim == 2 else np.einsum("dk,dck->dc", share, p)
    return share, (counts * np.log(np.maximum(mixed, 1e-300))).sum(axis=1) / OVERLAP


def infer(counts: np.ndarray, model: Model) -> tuple[list[list[int]], list[list[float]], np.ndarray]:
    """For each document: the languages of the set chosen (main first), their proportions, the main one's posterior."""
    single = counts @ np.log(model.p) / OVERLAP
    best = (single + 1e-9 * np.log(model.prior)).argmax(axis=1)
    odds = np.exp(single - single.max(axis=1, keepdims=True))
    sure = (odds / odds.sum(axis=1, keepdims=True))[np.arange(len(counts)), best]
    sets, shares = [[int(b)] for b in best], [[1.0] for _ in best]
    if len(model.languages) < 2:
        return sets, shares, sure
    share, _ = _em(counts, model.p)
    for d in np.flatnonzero((share > LEAST_SHARE).sum(axis=1) > 1):
        row, chosen, now = counts[d : d + 1], [int(best[d])], single[d, best[d]]
        others = [k for k in np.argsort(-share[d]).tolist() if share[d, k] > LEAST_SHARE and k not in chosen]
        while others:
            tried = [(_em(row, model.p[:, [*chosen, k]]), k) for k in others]
            (s, ll), k = max(tried, key=lambda x: x[0][1][0])
            if ll[0] - now <= PENALTY + 0.5 * np.log(max(row.sum(), 1)) or s[0].min() < LEAST_SHARE:
                break
            chosen, now = [*chosen, k], ll[0]
            order = np.argsort(-s[0], kind="stable")
            sets[d], shares[d] = [chosen[i] for i in order], s[0][order].tolist()
            others.remove(k)
    return sets, shares, sure


def background(counts: np.ndarray, sets: list[list[int]], shares: list[list[float]], model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Part of each document that text of no language explains better than its mixture."""
    own = np.vstack([model.unseen, model.p[1:]])
    mixed = own[:, [s[0] for s in sets]].T.copy()
    for d, (s, share) in enumerate(zip(sets, shares, strict=True)):
        if len(s) > 1:
            mixed[d] = own[:, s] @ np.array(share)
    part, n = np.full(len(counts), 0.5), np.maximum(counts.sum(axis=1), 1)
    for _ in range(rounds):
        of_plain = part[:, None] * model.plain
        part = (counts * of_plain / np.maximum(of_plain + (1 - part)[:, None] * mixed, 1e-300)).sum(axis=1) / n
    return np.where(counts.sum(axis=1) > 0, part, 0.0)


def identify(documents: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns with ``languages`` (main first), ``proportions``, ``background``, ``lang_pred`` and ``score``."""
    if model is None:
        none = {"languages": F.array().cast("array<string>"), "proportions": F.array().cast("array<double>"), "background": F.lit(1.0), "lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}
        return documents.select(*keep).withColumns(none)
    width = len(model.p)

    def start():
        def scan(part: Slice) -> dict:
            gram = _grams(part)
            inside = gram < 1 << GRAM_BITS
            doc, code = np.repeat(np.arange(part.n), np.diff(part.off))[inside], model.code[gram[inside]]
            names, proportions, left, main, score = [], [], [], [], []
            step = max(1, (1 << 21) // width)  # documents whose dense histograms are held at once
            for i in range(0, part.n, step):
                n = min(step, part.n - i)
                lo, hi = np.searchsorted(doc, (i, i + n))
                counts = np.bincount((doc[lo:hi] - i) * width + code[lo:hi], minlength=n * width).reshape(n, width).astype(float)
                every = counts.copy()
                counts[:, 0] = 0
                sets, shares, sure = infer(counts, model)
                names += [[model.languages[k] for k in s] for s in sets]
                proportions += shares
                left += background(every, sets, shares, model).tolist()
                main += [model.languages[s[0]] for s in sets]
                score += (np.array([s[0] for s in shares]) * sure).tolist()
            return {"languages": names, "proportions": proportions, "background": left, "lang_pred": main, "score": score}

        return scan

    letter = "__letter"
    fields = [("languages", T.ArrayType(T.StringType())), ("proportions", T.ArrayType(T.DoubleType())), ("background", T.DoubleType()), ("lang_pred", T.StringType()), ("score", T.DoubleType())]
    found = annotate(documents.withColumn(letter, F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))), text_col, [*keep, letter], fields, start)
    has = F.col(letter)
    return found.withColumns(
        {
            "languages": F.when(has, F.col("languages")).otherwise(F.array().cast("array<string>")),
            "proportions": F.when(has, F.col("proportions")).otherwise(F.array().cast("array<double>")),
            "background": F.when(has, F.col("background")).otherwise(F.lit(1.0)),
            "lang_pred": F.when(has, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)),
            "score": F.when(has, F.least(F.lit(1.0), F.col("score"))).otherwise(F.lit(0.0)),
        }
    ).drop(letter)


def explained(languages: Sequence[str] | None = None) -> Column:
    """Part of a text, as identified, that some languages (null: all learned ones) explain: 0 to 1."""
    wanted = F.lit(True) if languages is None else None
    parts = F.zip_with("languages", "proportions", lambda k, share: F.when(wanted if wanted is not None else k.isin(list(languages)), share).otherwise(F.lit(0.0)))
    return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) * (1 - F.col("background"))
