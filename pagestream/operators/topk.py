"""Orders and limits: null dates first or last, limits before or after filters, budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(ts: Column, undated: str, run_ts: Column | None = None) -> Column:
    """Sort key by date, newest first; undated rows ``first`` (as of the run) or ``last``."""
    return F.coalesce(ts, run_ts).desc() if undated == "first" and run_ts is not None else ts.desc_nulls_first() if undated == "first" else ts.desc_nulls_last()


def limit_by(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int | Column) -> DataFrame:
    """The first n rows of each group (the optimizer keeps only so many for each task)."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__nth", nth).where(F.col("__nth") <= n).drop("__nth")


def two_stage(df: DataFrame, by: Sequence[str], found_order: Sequence[Column | str], candidates: int, keep: Column, final_order: Sequence[Column | str], items: int) -> DataFrame:
    """Candidates in found order, filtered, then the best of them."""
    return limit_by(limit_by(df, by, found_order, candidates).where(keep), by, final_order, items)


def within_budget(df: DataFrame, by: Sequence[str], is_new: Column, order: Sequence[Column | str], budget: int) -> DataFrame:
    """``deferred`` marks new rows beyond the budget of a run; known rows are free."""
    nth = F.row_number().over(Window.partitionBy(*by, is_new).orderBy(*order))
    return df.withColumn("deferred", is_new & (nth > budget))


def first_run_limit(known: Column, first: int, later: int) -> Column:
    """Limit that depends on whether there is any history."""
    return F.when(known == 0, F.lit(first)).otherwise(F.lit(later))
