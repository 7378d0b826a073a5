"""Joins of a page pipeline, spelled out: anti, carry-forward, lookups, positional, theta."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import none_if_empty
from .sequence import ordinals


def new_rows(current: DataFrame, previous: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of which the previous snapshot has no such key."""
    return current.join(previous.select(*([key] if isinstance(key, str) else key)), key, "left_anti")


def nothing_new(current: DataFrame, previous: DataFrame, key: str) -> bool:
    """Whether every current key is in the previous snapshot (stops at the first that is not)."""
    return new_rows(current, previous, key).isEmpty()


def carry_forward(current: DataFrame, previous: DataFrame, key: str, value: str, fresh: Column, otherwise: Column) -> DataFrame:
    """A known row keeps its previous value (an empty one as null); a new row takes the fresh one, else ``otherwise``."""
    prev = previous.select(F.col(key).alias("__key"), F.col(value).alias("__value"), F.lit(True).alias("__known"))
    joined = current.join(prev, F.col(key) == F.col("__key"), "left")
    kept = F.when(F.col("__known"), none_if_empty(F.col("__value"))).otherwise(F.coalesce(fresh, otherwise))
    return joined.withColumn(value, kept).drop("__key", "__value", "__known")


def lookup(current: DataFrame, table: DataFrame, key: str, columns: Sequence[str], prefix: str = "old_") -> DataFrame:
    """Left join that adds the table's columns under a prefix."""
    return current.join(table.select(F.col(key).alias("__key"), *[F.col(c).alias(prefix + c) for c in columns]), F.col(key) == F.col("__key"), "left").drop("__key")


def two_key_lookup(current: DataFrame, table: DataFrame, first: str, second: str, columns: Sequence[str], prefix: str = "old_") -> DataFrame:
    """Lookup by one key, and where that finds nothing by another."""
    row = F.struct(*columns)
    a = table.where(F.col(first).isNotNull()).groupBy(F.col(first).alias("__a")).agg(F.max(row).alias("__by_a"))
    b = table.where(F.col(second).isNotNull()).groupBy(F.col(second).alias("__b")).agg(F.max(row).alias("__by_b"))
    joined = current.join(a, F.col(first) == F.col("__a"), "left").join(b, F.col(second) == F.col("__b"), "left")
    found = F.coalesce("__by_a", "__by_b")
    return joined.select(*[F.col(c) for c in current.columns], *[found[c].alias(prefix + c) for c in columns])


def precedence(*choices: tuple[Column, Column]) -> Column:
    """Value of the first (condition, value) whose condition holds and whose value is not null."""
    return F.coalesce(*[F.when(c, v) for c, v in choices])


def positional(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: Sequence[str], right_order: Sequence[str], how: str = "inner") -> DataFrame:
    """The k-th row of one side with the k-th of the other, within ``by``."""
    a, b = ordinals(left, by, left_order, name="nth"), ordinals(right, by, right_order, name="nth")
    return a.join(b, [*by, "nth"], how)


def full_outer_leftovers(slots: DataFrame, found: DataFrame, key: str, order: str) -> DataFrame:
    """Slots with what was found for them; what has no slot is appended in key order."""
    s, f = slots.withColumn("__slot", F.lit(1)), found.withColumn("__found", F.lit(1))
    joined = s.join(f, key, "full_outer")
    state = F.when(F.col("__slot").isNull(), "leftover").when(F.col("__found").isNull(), "unfilled").otherwise("filled")
    return joined.withColumns({"state": state, "rank": F.struct(F.col("__slot").isNull().alias("late"), F.col(order).alias("o"), F.col(key).alias("k"))}).drop("__slot", "__found")


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def overlap_area(a: str, b: str) -> Column:
    """Area shared by two rectangles with columns a_x0 ... and b_x0 ..."""
    c = lambda p, k: F.col(f"{p}_{k}")
    return area(F.greatest(c(a, "x0"), c(b, "x0")), F.greatest(c(a, "y0"), c(b, "y0")), F.least(c(a, "x1"), c(b, "x1")), F.least(c(a, "y1"), c(b, "y1")))


def not_covered(boxes: DataFrame, covers: DataFrame, by: Sequence[str], share: float) -> DataFrame:
    """Boxes of which no cover of the same page holds at least ``share`` of the area (theta anti join inside a page)."""
    prefixed = lambda df, p: df.select(*[F.col(k).alias(f"{p}_{k}") for k in (*by, "x0", "y0", "x1", "y1")])
    named = boxes.withColumns({f"t_{k}": F.col(k) for k in (*by, "x0", "y0", "x1", "y1")})
    same = [F.col(f"t_{k}") == F.col(f"c_{k}") for k in by]
    own = area(F.col("t_x0"), F.col("t_y0"), F.col("t_x1"), F.col("t_y1"))
    cond = (own > 0) & (overlap_area("t", "c") >= share * own)
    for s in same:
        cond = s & cond
    return named.join(prefixed(covers, "c"), cond, "left_anti").select(*boxes.columns)


def next_bound(rows: DataFrame, bounds: DataFrame, by: Sequence[str], at: str, name: str) -> DataFrame:
    """The smallest bound beyond each row: one sort of both sides together instead of an inequality join."""
    both = rows.withColumn("__bound", F.lit(False)).unionByName(bounds.select(*by, at).withColumn("__bound", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.col(at)).rangeBetween(1, Window.unboundedFollowing)
    return both.withColumn(name, F.min(F.when(F.col("__bound"), F.col(at))).over(w)).where("NOT __bound").drop("__bound")


def has_near(df: DataFrame, others: DataFrame, by: Sequence[str], at: str, within: int) -> DataFrame:
    """Rows with one of ``others`` of the same group less than ``within`` away (range semi join).

    Places are cut into cells of that width, and the others stand in three cells each, so
    the join is an equi-join on group and cell and no group is compared with itself whole.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(within))
    keys = [F.col(k).alias(f"__{k}") for k in by]
    spread = others.select(*keys, F.col(at).alias("__at"), F.explode(F.array(cell(at) - 1, cell(at), cell(at) + 1)).alias("__cell"))
    cond = (cell(at) == F.col("__cell")) & (F.abs(F.col(at) - F.col("__at")) < within)
    for k in by:
        cond = (F.col(k) == F.col(f"__{k}")) & cond
    return df.join(spread, cond, "left_semi")


def missing_outputs(items: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Items without a stored page: they are to be healed."""
    return items.join(stored.select(*key), key, "left_anti")
