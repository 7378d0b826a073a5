"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection.

1. One Arrow pass turns every whole text into its set of distinct shingles (52-bit
   hashes), a 64-bit identity of the set (equal sets are one *class*, so copies never meet
   again) and the set's tile signatures.
   Sets are banded by size so that linked sets lie in the same or in adjacent bands; a set
   signs for its own band's key and the next.
   Sets that link at threshold t differ in at most d shingles, d known for each key; the
   shingle universe is dealt into d + 1 + e pieces, so linked sets agree in e + 1 pieces at
   least.  Each agreed piece is a shared signature.  The e pieces that tell least are left
   out, as they would be shared by chance: pieces are ranked by how many shingles they hold
   that are not frequent (a bounded list from a sample), then by a hash.  Agreed pieces rank
   alike in both sets, so one of them at least is left in both: no link is lost, whatever
   the list.
2. Signatures are packed into tiles.  What a task holds of one signature is combined
   before the exchange into one representative and edges to it, so a signature that a third
   of all texts share costs a row for each task.  Each tile adds edges between the
   representatives of a signature: candidates, as stars, never all pairs.
3. Candidates are verified before components form.  Every class goes to the smallest class
   that it shares a signature with (its centre); centres with many classes are cut into
   chunks, each with the centre's text, so a family of thousands of near copies is dealt
   to many tasks.  Inside a chunk all links are found: size ratio, then hashed bitmaps (bits
   of one set missing in the other bound the overlap from above), then exact intersection
   of sorted arrays.  Sets meet there only if they share one of their rarest shingles (a
   linked pair must share one of the size - ceil(t * size) + 1 rarest in any common order),
   so sets that share a signature without linking cost their own size, not their square.
4. The verified links' components are the groups, except in a candidate component that
   holds several groups and several chunks.  There each group but the largest is compared
   with all of the component, in pairs of blocks of bounded and compatible sizes.  Where
   the smaller groups are more than a block, the component is first divided by the rarest
   shingles of its sets (counted in the component), which are dealt as units of their own,
   so this work too follows the sets and not their pairs.

Shingles are compared by 52 bits of their hashes: ``n_shingles`` and the test of a link
are exact up to collisions, about one pair of shingles in 4.5e15.

Defined results: texts without words have no shingles and are linked with nothing; equal
sets always link; null ids take part in links but cannot be the smallest id of a group
(a group of null ids only has a null component); an empty table gives no rows.  Ids that
are not whole numbers are an error.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import types as T
from pyspark.sql import functions as F

from .common import _kept, kept, settled, small, small_batches, unkept
from .components import connected_components
from .textscan import HASH_BITS, SPACED, TEXT, Slice, mix, slices

#: Shingles (8 bytes each) of two blocks, which one task holds.
COMPONENT_SHINGLES = 6_000_000
#: Classes and shingles of a chunk of a centre, and classes of a block of a largest group and of other groups.
CHUNK_SETS, CHUNK_SHINGLES = 256, 1_000_000
MAIN_SETS, REST_SETS = 512, 512
#: Signatures that a task gathers before it combines and packs them.
FLUSH = 800_000
#: Signatures of a tile, about.
TILE = 1_000_000
BITMAP_BITS = 2048
#: Bound on the expected number of texts that the list of frequent shingles is drawn from, and how many of them make a shingle frequent.
SAMPLE_TEXTS = 8192
FREQUENT = 3


@lru_cache(maxsize=8)
def _bands(num: int, den: int, top: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest size of each band; for each key k (sets of bands k-1 and k): pieces, and how many of them may be left out."""
    low = [1]
    while low[-1] < top:
        low.append(low[-1] * den // num + 1)
    upper = np.array(low[1:], dtype=np.int64) - 1
    both = upper + np.concatenate([[0], upper[:-1]])
    d = both * (den - num) // (den + num)
    spare = np.where(d > 0, np.maximum(2, -(-d // 2)), 0)
    return np.array(low, dtype=np.int64), np.where(d > 0, d + 1 + spare, 0), spare


def _classes(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, identity) of each text's set."""
    size = np.bincount(doc, minlength=n)
    total = np.zeros(n, dtype=np.uint64)
    np.add.at(total, doc, mix(h + np.uint64(0x5851F42D4C957F2D)))
    return size, mix(total + size.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


class Frequent:
    """A sorted list of frequent shingles."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(HASH_BITS - 16)).astype(np.int64)] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        out = self.maybe[(h >> np.uint64(HASH_BITS - 16)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            out[some] = self.hashes[np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)] == h[some]
        return out


def _signatures(doc: np.ndarray, h: np.ndarray, size: np.ndarray, num: int, den: int, frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, text, key) of the pieces of each text's set, for both keys of its band."""
    low, pieces, spare = _bands(num, den)
    band = np.searchsorted(low, size, side="right") - 1
    code = mix(h + np.uint64(0x2545F4914F6CDD1D))
    part = h >> np.uint64(HASH_BITS - 32)
    rare = ~frequent.among(h)
    out = []
    for key in (band, band + 1):
        m = np.where(size > 0, pieces[key], 0)
        base = np.cumsum(m) - m
        some = m[doc] > 0
        at = base[doc[some]] + ((part[some] * m[doc[some]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = int(m.sum())
        if not total:
            continue
        sums = np.zeros(total, dtype=np.uint64)
        np.add.at(sums, at, code[some])
        tells = np.minimum(np.bincount(at, weights=rare[some], minlength=total), 15).astype(np.uint64)
        owner = np.repeat(np.arange(len(m)), m)
        content = mix(sums.copy())
        rank = (owner.astype(np.uint64) << np.uint64(52)) | (tells << np.uint64(48)) | (content >> np.uint64(16))
        order = np.argsort(rank, kind="stable")  # ties, such as empty pieces, go by piece number in every set
        left = order[np.arange(total) - base[owner[order]] >= spare[key][owner[order]]]
        salt = mix(key[owner[left]].astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + (left - base[owner[left]]).astype(np.uint64))
        out.append((mix(sums[left] + salt), owner[left], key[owner[left]]))
    if not out:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sampled(docs: DataFrame, k: int, num: int, den: int, texts: int, tiles: int) -> tuple[Frequent, np.ndarray]:
    """From a sample of about SAMPLE_TEXTS: the shingles of FREQUENT or more different texts, and the first tile of each key.

    A key gets tiles by its part of all shingles, one at least, so the signatures of a pair
    of sets meet in few tiles.
    """
    low = _bands(num, den)[0]
    rate = min(1.0, SAMPLE_TEXTS / max(texts, 1))
    sample = docs.where(F.pmod("text_key", F.lit(1_000_003)) < rate * 1_000_003).dropDuplicates(["text_key"]).select(TEXT)

    def count(batches):
        for batch in batches:
            found, held = [], np.zeros(len(low) + 1)
            for _, _, part in slices(batch.column(0)):
                doc, h = part.words(SPACED, fold=True).shingles(k)
                found.append(h)
                size = np.bincount(doc, minlength=part.n)
                band = np.searchsorted(low, size, side="right") - 1
                held += np.bincount(np.concatenate([band, band + 1])[np.concatenate([size, size]) > 0], weights=np.concatenate([size, size])[np.concatenate([size, size]) > 0], minlength=len(held))
            h, n = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.uint64), return_counts=True)
            used = np.flatnonzero(held)
            kind = np.repeat([0, 1], [len(h), len(used)])
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int64()), pa.array(np.concatenate([h.astype(np.int64), used])), pa.array(np.concatenate([n, held[used].astype(np.int64)]))], names=["kind", "x", "n"])

    counts = sample.mapInArrow(count, "kind long, x long, n long").groupBy("kind", "x").agg(F.sum("n").alias("n")).where((F.col("kind") == 1) | (F.col("n") >= FREQUENT)).toArrow()
    kind, x, n = (counts[c].to_numpy() for c in ("kind", "x", "n"))
    volume = np.zeros(len(low) + 1)
    volume[x[kind == 1]] = n[kind == 1]
    each = np.maximum(1, np.ceil(tiles * volume / max(volume.sum(), 1))).astype(np.int64)
    return Frequent(x[kind == 0].astype(np.uint64)), np.concatenate([[0], np.cumsum(each)])


def _stars(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the smallest class of each signature, and edges (class, smallest) of the others."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, dtype=bool)
    head = cls[first][np.cumsum(first) - 1] if len(sig) else cls
    edge = cls != head
    pairs = np.unique(np.column_stack([cls[edge], head[edge]]), axis=0) if edge.any() else np.zeros((0, 2), dtype=cls.dtype)
    return order[first], pairs[:, 0], pairs[:, 1]


_SCANNED = "kind int, id_key long, n long, cls long, text_key long, tile long, body binary"


def _scan(k: int, num: int, den: int, frequent: Frequent, first_tile: np.ndarray):
    """Rows of kind 0 (documents), 1 (packed signatures of a tile) and 2 (packed edges)."""

    def rows(kind: int, count: int, **columns) -> pa.RecordBatch:
        names = ("id_key", "n", "cls", "text_key", "tile")
        made = [pa.array(np.full(count, kind, dtype=np.int32))] + [columns.get(x) if isinstance(columns.get(x), pa.Array) else pa.array(columns[x]) if x in columns else pa.nulls(count, pa.int64()) for x in names]
        return pa.RecordBatch.from_arrays([*made, columns.get("body", pa.nulls(count, pa.binary()))], names=["kind", *names, "body"])

    def packed(sigs: list, owners: list, keys: list):
        sig, cls, key = np.concatenate(sigs), np.concatenate(owners), np.concatenate(keys)
        at, a, b = _stars(sig, cls)
        sig, cls, key = sig[at], cls[at], key[at].astype(np.int64)
        if len(a):
            yield rows(2, 1, body=pa.array([np.concatenate([a, b]).tobytes()], type=pa.binary()))
        tile = first_tile[key] + (sig % (first_tile[key + 1] - first_tile[key]).astype(np.uint64)).astype(np.int64)
        order = np.argsort(tile, kind="stable")
        tile, sig, cls = tile[order], (sig[order] >> np.uint64(32)).astype(np.uint32), cls[order]
        bounds = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]])) if len(tile) else []
        for i in range(0, len(bounds) - 1, 64):
            some = bounds[i : i + 65]
            body = [sig[x:y].tobytes() + cls[x:y].tobytes() for x, y in zip(some[:-1], some[1:], strict=True)]
            yield rows(1, len(body), tile=tile[some[:-1]], body=pa.array(body, type=pa.binary()))

    def run(batches):
        sigs, owners, keys, held = [], [], [], 0
        for batch in batches:
            for i, j, part in slices(batch.column(2)):
                doc, h = part.words(SPACED, fold=True).shingles(k)
                size, cls = _classes(doc, h, part.n)
                yield rows(0, j - i, id_key=batch.column(0).slice(i, j - i), n=size.astype(np.int64), cls=cls.view(np.int64), text_key=batch.column(1).slice(i, j - i))
                sig, owner, key = _signatures(doc, h, size, num, den, frequent)
                sigs.append(sig)
                owners.append(cls[owner])
                keys.append(key.astype(np.int16))
                held += len(sig)
                if held >= FLUSH:
                    yield from packed(sigs, owners, keys)
                    sigs, owners, keys, held = [], [], [], 0
        if held:
            yield from packed(sigs, owners, keys)

    return run


def _tile_edges(table: pa.Table) -> pa.Table:
    """Candidate edges of one tile."""
    sigs, cls = [], []
    for body in table["body"].to_pylist():
        n = len(body) // 12
        sigs.append(np.frombuffer(body, dtype=np.uint32, count=n))
        cls.append(np.frombuffer(body, dtype=np.uint64, offset=4 * n))
    _, a, b = _stars(np.concatenate(sigs), np.concatenate(cls))
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def _edge_rows(batches):
    for batch in batches:
        for body in batch.column(0).to_pylist():
            both = np.frombuffer(body, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[: len(both) // 2]), pa.array(both[len(both) // 2 :])], names=["a", "b"])


class _Sets:
    """The shingle sets of some texts: sorted arrays, sizes and bitmaps."""

    def __init__(self, texts: pa.Array, k: int):
        sets = []
        for _, _, part in slices(texts):
            doc, h = part.words(SPACED, fold=True).shingles(k)
            sets += np.split(h, np.searchsorted(doc, np.arange(1, part.n)))
        self.sets = sets
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.bits = np.zeros((len(sets), BITMAP_BITS // 64), dtype=np.uint64)
        for i, s in enumerate(sets):
            flags = np.zeros(BITMAP_BITS, dtype=np.uint8)
            flags[(s % np.uint64(BITMAP_BITS)).astype(np.int64)] = 1
            self.bits[i] = np.packbits(flags).view(np.uint64)

    def linked(self, i: int, others: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which of ``others`` link with text i."""
        a, b = self.size[i], self.size[others]
        need = -(-num * (a + b) // (den + num))  # overlap of a link at least
        fits = np.minimum(a, b) >= need
        others, b, need = others[fits], b[fits], need[fits]
        if not len(others):
            return others
        mine, theirs = self.bits[i], self.bits[others]
        bound = np.minimum(a - np.bitwise_count(mine & ~theirs).sum(axis=1), b - np.bitwise_count(theirs & ~mine).sum(axis=1))
        others, b, need = others[bound >= need], b[bound >= need], need[bound >= need]
        if not len(others):
            return others
        found = []
        for at in np.array_split(np.arange(len(others)), max(1, int(b.sum()) // 4_000_000)):
            every = np.concatenate([self.sets[o] for o in others[at]])
            place = np.minimum(np.searchsorted(self.sets[i], every), a - 1)
            same = np.add.reduceat(self.sets[i][place] == every, np.cumsum(b[at]) - b[at], dtype=np.int64)
            found.append(same >= need[at])
        return others[np.concatenate(found)]


def _prefixes(sets: _Sets, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rarest shingles of each set that other sets have among theirs: (shingles, bounds by set, sets, bounds by shingle)."""
    n, size = len(sets.sets), sets.size
    every = np.concatenate(sets.sets) if n else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(n), size)
    _, token, count = np.unique(every, return_inverse=True, return_counts=True)
    token = token[np.lexsort((token, count[token], owner))]
    need = np.where(size > 0, size + 1 - -(-num * size // den), 0)
    few = np.arange(len(every)) - np.repeat(np.cumsum(size) - size, size) < need[owner]
    token, owner = token[few], owner[few]
    shared = np.bincount(token, minlength=len(count))[token] > 1
    token, owner = token[shared], owner[shared]
    _, token = np.unique(token, return_inverse=True)
    order = np.argsort(token, kind="stable")
    bound = np.searchsorted(token[order], np.arange(token.max() + 2 if len(token) else 1))
    return token, np.searchsorted(owner, np.arange(n + 1)), owner[order], bound


def _linked_groups(sets: _Sets, num: int, den: int, left: np.ndarray | None = None) -> np.ndarray:
    """Component of each text (the smallest index in it). With ``left``, only links between left and other texts matter."""
    token, of_set, holders, of_token = _prefixes(sets, num, den)
    comp, new = np.full(len(sets.sets), -1), np.ones(len(sets.sets), dtype=bool)
    shrunk: dict[int, np.ndarray] = {}  # holders that are in no component yet
    for seed in range(len(comp)):
        if comp[seed] >= 0:
            continue
        comp[seed], new[seed], todo = seed, False, [seed]
        while todo:
            i = todo.pop()
            among = []
            for t in token[of_set[i] : of_set[i + 1]].tolist():
                held = shrunk.get(t)
                if held is None:
                    held = holders[of_token[t] : of_token[t + 1]]
                if len(held):
                    shrunk[t] = held = held[new[held]]
                    among.append(held)
            others = np.unique(np.concatenate(among)) if among else holders[:0]
            if left is not None:
                others = others[left[others] != left[i]]
            if len(others):
                found = sets.linked(i, others, num, den)
                comp[found], new[found] = seed, False
                todo += found.tolist()
    return comp


def _verified(k: int, num: int, den: int):
    """Star edges of the verified links within the texts of a group."""

    def run(table: pa.Table) -> pa.Table:
        cls = table["cls"].to_numpy()
        order = np.argsort(cls, kind="stable")
        keep = order[np.concatenate([[True], cls[order][1:] != cls[order][:-1]])]
        sets = _Sets(table[TEXT].take(pa.array(keep)).combine_chunks(), k)
        side = table["side"].to_numpy()[keep] if "side" in table.column_names and len(set(table["side"].to_pylist())) > 1 else None
        comp = _linked_groups(sets, num, den, side)
        edge = comp != np.arange(len(comp))
        return pa.table({"a": pa.array(cls[keep][edge]), "b": pa.array(cls[keep][comp[edge]])})

    return run


def jaccard_groups(documents: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text", component_shingles: int = COMPONENT_SHINGLES) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (smallest linked doc_id), text_key, first.

    Two documents link when ``den * intersection >= num * union`` of their sets of distinct
    k-word shingles.  ``text_key`` is xxhash64 of the text; (``first_id``, ``first_key``)
    name the group's first row by id and text key.  Ids are whole numbers.
    """
    small_batches(documents.sparkSession)
    if not isinstance(documents.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must hold whole numbers")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = documents.select(F.col(f"`{id_col}`").cast("long").alias("id_key"), F.xxhash64(text).alias("text_key"), text.alias(TEXT))
    size, rows = documents.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string"))), F.count(F.lit(1))).first()
    tiles = max(8, int((size or 0) * 0.5 * (den - num) / den // TILE))
    scanned = kept(docs.mapInArrow(_scan(k, num, den, *_sampled(docs, k, num, den, rows, tiles)), _SCANNED))
    members = scanned.where("kind = 0").select("id_key", "n", "cls", "text_key")

    packed = scanned.where("kind = 1").select("tile", "body")
    near = packed.groupBy("tile").applyInArrow(_tile_edges, "a long, b long").unionAll(scanned.where("kind = 2").select("body").mapInArrow(_edge_rows, "a long, b long"))
    near, _ = settled(near.distinct())
    candidates = kept(connected_components(near))

    # one row for each class from here on: copies are combined before any shuffle
    firsts = kept(members.where("n > 0").groupBy("cls", "n").agg(F.min(F.struct(F.col("id_key").isNull().alias("none"), "id_key", "text_key")).alias("first")))
    few = candidates.count()
    reps = firsts.join(small(candidates, few, 16), F.col("cls") == F.col("v"))
    reps, _ = settled(reps.select("cls", "root", "n", F.col("first.id_key").alias("r_id"), F.col("first.text_key").alias("r_key")))
    search = _Search(docs, reps, few, k, num, den, component_shingles)
    sure, chunks = search.in_chunks(near)
    sure, _ = settled(sure)
    groups, _ = settled(connected_components(sure))
    more = search.across(groups, chunks)
    if more is not None:
        groups, _ = settled(connected_components(sure.unionAll(more)))
    unkept(candidates, *search.held)
    groups = groups.select(F.col("v").alias("g_cls"), F.col("root").alias("g_root"))

    placed = firsts.join(small(groups, few, 16), F.col("cls") == F.col("g_cls"), "left").select("cls", F.coalesce("g_root", "cls").alias("group"), "first")
    # of classes alone in their group the first is known; only linked classes meet again
    linked = placed.join(small(groups.select(F.col("g_root").alias("group")).distinct(), few, 8), "group", "left_semi").groupBy("group").agg(F.min("first").alias("least"))
    placed = kept(placed.join(small(linked, few, 40), "group", "left").select(F.col("cls").alias("p_cls"), F.coalesce("least", "first").alias("first")))
    found = members.join(placed, (F.col("cls") == F.col("p_cls")) & (F.col("n") > 0), "left")
    alone = F.col("p_cls").isNull()
    return found.select(
        F.col("id_key").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id_key")).otherwise(F.col("first.id_key")).alias("component_id"),
        "text_key",
        F.when(alone, F.col("text_key")).otherwise(F.col("first.text_key")).alias("first_key"),
    )


class _Search:
    """Exact links among candidate classes: first in chunks around centres, then across what is left open."""

    def __init__(self, docs: DataFrame, reps: DataFrame, few: int, k: int, num: int, den: int, shingles: int):
        self.docs, self.reps, self.few, self.k, self.num, self.den, self.shingles = docs, reps, few, k, num, den, shingles
        self.held: list[DataFrame] = []

    def _held(self, df: DataFrame) -> DataFrame:
        self.held.append(kept(df))
        return self.held[-1]

    def _texts(self, assigned: DataFrame, rows: int) -> DataFrame:
        """``assigned`` (cls, n and others; so many rows) with the classes' texts."""
        found = assigned.join(small(self.reps.select("cls", "r_id", "r_key"), self.few, 24), "cls")
        return self.docs.join(small(found, rows, 64), (F.col("text_key") == F.col("r_key")) & F.col("id_key").eqNullSafe(F.col("r_id"))).drop("id_key", "text_key", "r_id", "r_key")

    def in_chunks(self, near: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Verified links of each chunk, and the chunks of each candidate component (root, centre, chunk)."""
        sized = self.reps.select("cls", "root", "n")
        stars = near.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("centre"))
        # a class that is the smallest of its signatures goes with those it shares them with, unless it is their centre
        heads = near.join(small(stars.select(F.col("cls").alias("a"), "centre"), self.few, 16), "a").groupBy(F.col("b").alias("cls")).agg(F.min("centre").alias("centre"))
        heads = heads.where("cls <> centre").join(small(stars.select("cls"), self.few, 8), "cls", "left_anti")
        stars = stars.unionByName(heads).join(small(sized, self.few, 24), "cls")
        stars = self._held(stars.select("cls", "root", "n", "centre"))
        cells = stars.groupBy("centre", "root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK_SETS)), F.ceil(F.sum("n") / F.lit(min(CHUNK_SHINGLES, self.shingles)))).alias("chunks"))
        cells = self._held(cells)
        dealt = stars.join(small(cells.select("centre", "chunks"), self.few, 16), "centre").select("cls", "centre", F.pmod(F.xxhash64("cls"), "chunks").alias("chunk"))
        centres = cells.select(F.col("centre").alias("cls"), "centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
        texts = self._texts(dealt.unionAll(centres), 2 * self.few)
        links = texts.groupBy("centre", "chunk").applyInArrow(_verified(self.k, self.num, self.den), "a long, b long")
        return links, cells.select("root", "centre", "chunks")

    def across(self, groups: DataFrame, chunks: DataFrame) -> DataFrame | None:
        """Links between different groups of candidate components that several chunks hold; null where all is settled."""
        many = chunks.groupBy("root").agg(F.sum("chunks").alias("chunks")).where("chunks > 1").select("root")
        if many.isEmpty():
            return None
        inside = self.reps.join(small(many, self.few, 8), "root").select("root", "cls", "n")
        named = inside.join(groups.select(F.col("v").alias("cls"), F.col("root").alias("g")), "cls", "left").withColumn("g", F.coalesce("g", "cls"))
        unsettled = named.groupBy("root").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("root")
        unsettled, sets = settled(named.join(small(unsettled, self.few, 8), "root"))
        if not sets:
            return None
        main = unsettled.groupBy("root", "g").count().groupBy("root").agg(F.max_by("g", F.struct("count", "g")).alias("main"))
        marked = unsettled.join(small(main, self.few, 16), "root").select("root", "cls", "n", "g", (F.col("g") != F.col("main")).alias("rest"))
        wide = marked.where("rest").groupBy("root").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sets")).where((F.col("n") > self.shingles // 2) | (F.col("sets") > REST_SETS)).select("root")
        wide, found = settled(wide)
        whole = marked.join(small(wide, self.few, 8), "root", "left_anti").withColumn("unit", F.struct("root", F.lit(0).cast("long").alias("token"))).drop("root")
        if found:
            whole = whole.unionByName(self._by_token(unsettled.join(small(wide, self.few, 8), "root")))
        return self._in_blocks(settled(whole)[0])

    def _by_token(self, sets: DataFrame) -> DataFrame:
        """Units of the sets (root, cls, n, g) that have a shingle among their rarest, where more than one group does."""
        k = self.k

        def shingles(batches):
            for batch in batches:
                for i, j, part in slices(batch.column(batch.num_columns - 1)):
                    text, h = part.words(SPACED, fold=True).shingles(k)
                    rows = pa.array(i + text)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in range(4)), pa.array(h.astype(np.int64))], names=["root", "cls", "n", "g", "token"])

        # repeated rows of a text give a shingle twice, which changes the order only
        tokens = self._held(self._texts(sets, self.few).dropDuplicates(["root", "cls"]).select("root", "cls", "n", "g", TEXT).mapInArrow(shingles, "root long, cls long, n long, g long, token long"))
        counts = tokens.groupBy("root", "token").agg(F.count(F.lit(1)).alias("held"), F.min("g").alias("lo"), F.max("g").alias("hi")).where("held > 1")
        named = tokens.join(counts, ["root", "token"], "left")
        rank = F.row_number().over(Window.partitionBy("root", "cls").orderBy(F.coalesce("held", F.lit(1).cast("long")), "token"))
        prefix = F.col("n") + 1 - F.ceil(F.col("n") * self.num / self.den)
        units = named.withColumn("rank", rank).where((F.col("rank") <= prefix) & (F.col("lo") < F.col("hi")))
        units, _ = settled(units.select(F.struct("root", "token").alias("unit"), "cls", "n", "g"))
        main = units.groupBy("unit", "g").count().groupBy("unit").agg(F.max_by("g", F.struct("count", "g")).alias("main"))
        return units.join(main, "unit").select("cls", "n", "g", (F.col("g") != F.col("main")).alias("rest"), "unit")

    def _in_blocks(self, marked: DataFrame) -> DataFrame:
        """Links of each unit's rest (cls, n, g, rest, unit) with all of the unit."""
        marked = marked.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(self.den / self.num))))
        sets = F.when(F.col("rest"), F.lit(REST_SETS)).otherwise(F.lit(MAIN_SETS))
        parts = F.greatest(F.ceil(F.sum("n") / F.lit(max(1, self.shingles // 2))), F.ceil(F.count(F.lit(1)) / sets))
        cells = marked.groupBy("unit", "rest", "band").agg(parts.alias("parts"))
        part = F.pmod(F.xxhash64("cls"), F.col("parts"))
        blocks = self._held(marked.join(cells, ["unit", "rest", "band"]).select("unit", "cls", "n", F.struct("rest", "band", part.alias("part")).alias("block")))
        spans = blocks.groupBy("unit", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        a, b = spans.where("block.rest").selectExpr("unit", "block as one", "lo as a_lo", "hi as a_hi"), spans.selectExpr("unit", "block as two", "lo as b_lo", "hi as b_hi")
        fits = (F.col("a_hi") * self.den >= F.col("b_lo") * self.num) & (F.col("b_hi") * self.den >= F.col("a_lo") * self.num)
        pairs = self._held(a.join(b, "unit").where(fits & (~F.col("two.rest") | (F.col("one") <= F.col("two")))).select("unit", "one", "two"))
        ends = pairs.select("unit", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
        sided, rows = settled(blocks.join(ends, ["unit", "block"]).select("unit", "one", "two", "cls", (F.col("block") == F.col("one")).alias("side")))
        texts = self._texts(sided, rows)
        return texts.groupBy("unit", "one", "two").applyInArrow(_verified(self.k, self.num, self.den), "a long, b long")


def keep_first(documents: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of linked documents: that of the smallest id.

    Documents without words stay, rows that are equal in id and text leave one row.
    """
    before = list(_kept)
    found = jaccard_groups(documents, k, num, den, id_col, text_col)
    linked = kept(found.where("n_shingles > 0"))
    copy = (F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    gone, n = settled(linked.where(~(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("first_key")))).select(*copy).distinct())
    again, repeated = settled(linked.groupBy(*copy).count().where("count > 1").select("__id", "__key"))
    unkept(*[x for x in _kept if all(x is not y for y in before)])
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    left = documents.join(small(gone, n, 16), same, "left_anti")
    if repeated == 0:
        return left
    again = small(again, repeated, 16)
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
