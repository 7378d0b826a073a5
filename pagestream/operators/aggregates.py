"""Aggregations: boilerplate by document frequency, argmax choice, signatures, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def boilerplate_lines(lines: DataFrame, group: str, page: str, line: str, share: float = 0.4, least: int = 3, below: int = 120) -> DataFrame:
    """Lines that stand on max(least, floor(share * pages)) pages of a group or more.

    Each line counts once for a page: distinct (group, line, page) first, then a count, both
    with partial aggregation, so a very common line is a few rows for each task.
    """
    pages = lines.select(group, page).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("pages"))
    seen = lines.where(F.length(line) < below).select(group, page, F.lower(line).alias("line")).distinct().groupBy(group, "line").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(pages, group).where(F.col("n") >= F.greatest(F.lit(least), F.floor(share * F.col("pages")).cast("int"))).select(group, "line", "n", "pages")


def without_boilerplate(lines: DataFrame, found: DataFrame, group: str, line: str) -> DataFrame:
    return lines.withColumn("__low", F.lower(line)).join(found.select(group, F.col("line").alias("__low")), [group, "__low"], "left_anti").drop("__low")


def best_candidate(df: DataFrame, by: Sequence[str], score: Sequence[Column], columns: Sequence[str], tie: str) -> DataFrame:
    """Row of the highest score; on ties the smallest ``tie``."""
    key = F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)], (-F.col(tie)).alias("t"))
    return df.groupBy(*by).agg(F.max_by(F.struct(*columns), key).alias("__best")).select(*by, "__best.*")


def page_style(df: DataFrame, by: Sequence[str], size: str, bold: Column, text: str, order: str) -> DataFrame:
    """Median size (10.0 without any), largest size, majority bold, text joined in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return df.groupBy(*by).agg(
        F.coalesce(F.median(size), F.lit(10.0)).alias("median_size"),
        F.max(size).alias("max_size"),
        (F.sum(bold.cast("int")) >= F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / 2))).alias("bold"),
        F.array_join(lines, " ").alias("text"),
    )


def feed_signature(items: DataFrame, feed: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One hash of a feed's ordered, normalised items.

    Each item's digest holds its place, and digests add up: partial sums merge, so no task
    holds a feed, and two feeds agree only if the same items stand in the same places.
    """
    row = F.concat_ws("\t", F.col(order).cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    part = lambda at: F.sum(F.conv(F.substring(F.md5(row), at, 13), 16, 10).cast("decimal(20,0)")).cast("string")
    summed = items.groupBy(feed).agg(F.count(F.lit(1)).alias("items"), part(1).alias("__a"), part(14).alias("__b"))
    return summed.select(feed, "items", F.md5(F.concat_ws("|", F.col("items").cast("string"), "__a", "__b")).alias("signature"))


def ordered_join(df: DataFrame, by: Sequence[str], order: str, text: str, sep: str = "\n") -> DataFrame:
    """Texts of a group joined in order."""
    return df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), sep).alias("joined"))


def counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows unchanged, with counters that are filled as they pass."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def bounding_boxes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union rectangle of each group."""
    return df.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
