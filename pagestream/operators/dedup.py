"""First-wins and last-wins dedup in an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_wins(df: DataFrame, key: Column | Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in ascending order (nulls first); an aggregation, so rows are combined before the shuffle."""
    keys = [key] if isinstance(key, (Column, str)) else list(key)
    named = [c.alias(f"__key{i}") for i, c in enumerate(_cols(keys))]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*named).agg(F.min_by(row, F.struct(*_cols(order))).alias("__row")).select("__row.*")


def last_wins(df: DataFrame, key: str, order: Column, columns: Sequence[str]) -> DataFrame:
    """The last row of each key; an aggregation, so rows are combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("__row")).select(key, "__row.*")


def first_wins_if(df: DataFrame, key: Column, order: Sequence[Column | str], applies: Column) -> DataFrame:
    """First row of each key; rows to which the rule does not apply stay, and do not count."""
    nth = F.row_number().over(Window.partitionBy(key, applies).orderBy(*_cols(order)))
    return df.withColumns({"__nth": nth, "__applies": applies}).where("__nth = 1 OR NOT coalesce(__applies, false)").drop("__nth", "__applies")


def first_wins_or_forced(df: DataFrame, key: Column, order: Sequence[Column | str], forced: Column, within: Sequence[Column | str] = ()) -> DataFrame:
    """First row of each key; forced rows stay always, and their keys count as seen."""
    nth = F.row_number().over(Window.partitionBy(*_cols(within), key).orderBy(*_cols(order)))
    return df.withColumns({"__nth": nth, "__forced": forced}).where("__nth = 1 OR __forced").drop("__nth", "__forced")


def two_key_first_wins(df: DataFrame, first: Column, second: Column, order: Sequence[Column | str], second_applies: Column) -> DataFrame:
    """Dedup by one key, then by another among the rows that it applies to."""
    return first_wins_if(first_wins(df, first, order), second, order, second_applies)


def short_first_wins(df: DataFrame, text: Column, order: Sequence[Column | str], within: Sequence[Column | str] = (), below: int = 80) -> DataFrame:
    """Short texts once; long texts stay as they are."""
    short = F.length(text) < below
    nth = F.row_number().over(Window.partitionBy(*_cols(within), F.when(short, text), short).orderBy(*_cols(order)))
    return df.withColumns({"__nth": nth, "__short": short}).where("__nth = 1 OR NOT coalesce(__short, false)").drop("__nth", "__short")
