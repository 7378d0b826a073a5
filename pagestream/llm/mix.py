"""Mixing sources to target weights with native DataFrame operations.

Each source gets its target by weight; a target that would pass ``max_repeats`` times
its source stops there and the excess goes to the others by weight (water-filling, in
closed form over the sources ordered by their cap per weight).

Inside a source every document gets a hash-random key.  Keys are uniform, so equal
ranges of the key space are equal shares of the source: a source of n documents is cut
into about sqrt(n) ranges, each sorted by key with its own running sum, and the ranges'
sums form a second running sum per source.  No task sees more than about the square
root of a source, however large the source is.  The budget then cuts exactly: whole
epochs first, then the prefix in key order, the last document in part.

Defined results: a null text has size 0 and takes nothing; a null source is a source of
its own and sorts last; copies and repeated rows count as rows of their own; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, small, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix-1"


def random_key(id_col: Column, size: Column, seed: str = SEED) -> Column:
    """A hash-random key in 0..2^52, the same in every run."""
    text = F.concat_ws("|", F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """source, n_docs, source_size, target: one row per source; ``weights`` repeat over the sources by code point, null last."""
    stats = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    weighed = stats.withColumn("weight", weight).withColumn("cap", max_repeats * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = weighed.withColumns(
        {
            "level": (F.sum("source_size").over(everything) * F.lit(float(share)) - (F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    # the water level: of the first source, by cap per weight, that the level does not fill
    level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return filled.select("source", "n_docs", "source_size", target.alias("target"))


def _placed(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """doc_id, source, size, key, source_size, target, whole epochs and the words taken of the last one."""
    size = word_count(F.col(f"`{text_col}`"))
    sized = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"))
    sized = kept(sized.withColumn("key", random_key(F.col("doc_id"), F.col("size"), seed)))
    targets = kept(source_targets(sized, weights, share, max_repeats).withColumns({"budget": F.round("target").cast("long"), "ranges": F.ceil(F.sqrt("n_docs")).cast("long")}))
    t = small(targets.withColumnRenamed("source", "t_source"), targets.count(), 128)
    ranged = sized.join(t, sized["source"].eqNullSafe(t["t_source"])).drop("t_source").withColumn("range", F.floor(F.col("key") / F.lit(float(1 << 52)) * F.col("ranges")))
    inner = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumn("upto", F.sum("size").over(inner))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    outer = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sums.select(F.col("source").alias("o_source"), F.col("range").alias("o_range"), (F.sum("range_size").over(outer) - F.col("range_size")).alias("before"))
    placed = running.join(offsets, running["source"].eqNullSafe(offsets["o_source"]) & (running["range"] == offsets["o_range"]))
    whole = F.expr("case when source_size > 0 then budget div source_size else 0 end")
    rest = F.col("budget") - whole * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - (F.col("before") + F.col("upto") - F.col("size"))))
    return placed.select("doc_id", "source", "size", "key", "source_size", "target", whole.alias("whole"), part.alias("part"))


def mix_sources(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken``: the words of each document that the mix takes."""
    placed = _placed(documents, weights, share, max_repeats, id_col, source_col, text_col, seed)
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def repeat_taken(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """The mix itself: each row as often as the mix takes it, with its own columns.

    The document at a source's cut stays whole, as texts are not split.  The cut is a key
    for each source, so the rows meet a small table only and their texts do not move.
    """
    placed = _placed(documents, weights, share, max_repeats, id_col, source_col, text_col, seed)
    cuts = kept(placed.groupBy(F.col("source").alias("__source")).agg(F.max("whole").alias("__whole"), F.max(F.when(F.col("part") > 0, F.col("key"))).alias("__cutoff")))
    columns = documents.columns
    own = documents.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)])
    name = lambda c: F.col(f"__c{columns.index(c)}")
    joined = own.join(small(cuts, cuts.count(), 64), name(source_col).eqNullSafe(F.col("__source")))
    key = random_key(name(id_col), word_count(name(text_col)), seed)
    times = (F.col("__whole") + F.coalesce(key <= F.col("__cutoff"), F.lit(False)).cast("long")).cast("int")
    taken = joined.withColumn("__times", times).where("__times > 0")
    return taken.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__turn")).drop("__turn")
