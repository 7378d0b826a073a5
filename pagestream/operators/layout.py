"""Reading order and regions of laid-out pages from their boxes.

Rows are boxes of ``schema.BOX`` with a document column; everything is relational and
bounded by a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import bounding_boxes
from .joins import not_covered
from .sequence import merge_overlapping

PAGE = ["doc", "page"]


def column_of(width: Column) -> Column:
    """left, right or full, by where a box lies about the middle of the page."""
    mid = width / 2
    full = (F.col("x0") < mid * 0.9) & (F.col("x1") > mid * 1.1) & ((F.col("x1") - F.col("x0")) > 0.6 * width)
    return F.when(full, "full").when((F.col("x0") + F.col("x1")) / 2 < mid, "left").otherwise("right")


def with_page_kind(boxes: DataFrame, width: float) -> DataFrame:
    """Adds ``two_column``: at least four narrow boxes, of which a quarter at most cross the middle."""
    narrow = (F.col("x1") - F.col("x0")) < 0.6 * width
    crosses = narrow & (F.col("x0") < width / 2) & (F.col("x1") > width / 2)
    # ordered as reading_order needs it next, so one sort serves both
    w = Window.partitionBy(*PAGE).orderBy("y0").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, c = F.sum(narrow.cast("int")).over(w), F.sum(crosses.cast("int")).over(w)
    return boxes.withColumn("two_column", (n >= 4) & (c <= 0.25 * n))


#: Bytes, as stored, of the tables that are read for each partition of boxes.
PART_BYTES = 8 << 20


def by_page(boxes: DataFrame) -> DataFrame:
    """Boxes dealt out by page. Partitions follow the size of the tables read, so what a task sorts stays the same; where Spark knows no size, it chooses."""
    seq = lambda x: [x.apply(i) for i in range(x.size())]
    plan = boxes.select(*PAGE)._jdf.queryExecution().optimizedPlan()
    stored = sum(int(str(leaf.stats().sizeInBytes())) for leaf in seq(plan.collectLeaves()))
    if stored >= 1 << 50:
        return boxes
    # Spark takes a constant out of a window's keys; dealt out by it, rows would be shuffled again
    named = seq(plan.projectList()) if plan.nodeName() == "Project" else []
    constant = {e.name() for e in named if any(c.foldable() for c in seq(e.children()))}
    return boxes.repartition(max(boxes.sparkSession.sparkContext.defaultParallelism, -(-stored // PART_BYTES)), *([c for c in PAGE if c not in constant] or PAGE))


def reading_order(boxes: DataFrame, width: float, ties: list[str] | None = None) -> DataFrame:
    """``nth`` of each box: bands between full-width boxes, then columns, then downwards."""
    kind = column_of(F.lit(width))
    marked = with_page_kind(by_page(boxes), width).withColumn("col", F.when(F.col("two_column"), kind).otherwise("full"))
    divider = F.col("two_column") & (F.col("col") == "full")
    w = Window.partitionBy(*PAGE).orderBy("y0").rangeBetween(Window.unboundedPreceding, 1)
    banded = marked.withColumn("band", F.sum(divider.cast("int")).over(w))
    side = F.when(F.col("col") == "full", 0).when(F.col("col") == "left", 1).otherwise(2)
    order = [F.col("band"), F.when(F.col("two_column"), side).otherwise(F.lit(0)), F.round("y0"), F.col("x0"), *(ties or [])]
    return banded.withColumn("nth", F.row_number().over(Window.partitionBy(*PAGE).orderBy(*order)))


def figure_regions(rects: DataFrame, height: float) -> DataFrame:
    """Clusters of drawings of each page: rectangles within 5 % of the height of the ones above."""
    clustered = merge_overlapping(rects, "y0", "y1", F.lit(0.05 * height), PAGE, ["y0", "x0"], "cluster")
    return bounding_boxes(clustered, [*PAGE, "cluster"])


def body_text(boxes: DataFrame, figures: DataFrame, share: float = 0.6) -> DataFrame:
    """Boxes that no figure covers."""
    return not_covered(boxes, figures, PAGE, share)


def caption_regions(captions: DataFrame, bounds: DataFrame, bottom: float) -> DataFrame:
    """Each caption's region ends at the next bound below it in its column, else at the bottom."""
    b = bounds.select(*PAGE, F.col("col").alias("col"), F.col("y0").alias("bound"))
    joined = captions.join(b, [*PAGE, "col"], "left")
    below = F.min(F.when(F.col("bound") > F.col("y0"), F.col("bound")))
    return joined.groupBy(*[F.col(c) for c in captions.columns]).agg(F.coalesce(below, F.lit(bottom)).alias("until"))
