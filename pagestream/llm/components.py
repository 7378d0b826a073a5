"""Connected components of an edge table by alternating large-star and small-star rounds.

Edges stay in Spark throughout; each round is cut by a checkpoint, and only a count and a
checksum come to the driver.  Minima are aggregated before they are joined back, so a
vertex with very many edges is one pre-aggregated row on one side of each join, and the
other side can be split.

A graph of at most ``ONE_TASK_EDGES`` counted edges is solved in one task of bounded
memory instead, by the same minimum labels; rounds are for what does not fit there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, kept, unkept


#: Edges that one task holds (32 bytes each, about).
ONE_TASK_EDGES = 2_000_000


def labelled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex of each one's component)."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _one_task(batches):
    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
    if a:
        v, root = labelled(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(root)], names=["v", "root"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def connected_components(edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(v, root) for every vertex of an edge (long columns a and b, not equal); root is the smallest vertex of its component."""
    start = kept(edges.where("a <> b"))
    n = start.count()
    if n <= one_task:
        # an exchange, not a coalesce: a lost executor's part of the edges is made again by many tasks
        return start.select("a", "b").repartition(1).mapInArrow(_one_task, "v long, root long")
    edges = cut(start.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), n)
    unkept(start)
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a <> b").distinct(), 2 * now[0])
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
