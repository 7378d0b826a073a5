"""Operators over rows in page order: spans, latches, islands, nearest preceding, assembly.

Each takes the columns that part the rows into sequences (``by``) and that order them
(``order``).  A sequence is one page or document, so windows are bounded by a page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .dedup import _cols


def window(by: Sequence[Column | str], order: Sequence[Column | str]) -> WindowSpec:
    return Window.partitionBy(*_cols(by)).orderBy(*_cols(order))


def so_far(by, order) -> WindowSpec:
    return window(by, order).rowsBetween(Window.unboundedPreceding, 0)


def before(by, order) -> WindowSpec:
    return window(by, order).rowsBetween(Window.unboundedPreceding, -1)


def explode_pieces(df: DataFrame, text: Column, by: str, pos: str = "pos", piece: str = "piece") -> DataFrame:
    """One row for each piece of a text, in order, from 0."""
    return df.select("*", F.posexplode(F.split(text, by)).alias(pos, piece))


def match_spans(df: DataFrame, page: Column, regex: str, groups: int) -> DataFrame:
    """One row for each match of a regex: pos, groups, full, start and end (from 1, end exclusive).

    Matches are found once; a match's place is where its text occurs after the end of the
    one before, which the page's pieces between matches give.
    """
    full = F.regexp_extract_all(page, F.lit(regex), F.lit(0))
    parts = F.arrays_zip(full.alias("full"), *[F.regexp_extract_all(page, F.lit(regex), F.lit(g)).alias(f"g{g}") for g in range(1, groups + 1)])
    gaps = F.transform(F.split(page, regex), lambda x: F.length(x))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), F.transform(full, lambda x: F.length(x)).alias("len")),
        start,
        lambda acc, x: F.struct((acc["at"] + F.coalesce(x["gap"], F.lit(0)) + F.coalesce(x["len"], F.lit(0))).alias("at"), F.array_append(acc["starts"], acc["at"] + F.coalesce(x["gap"], F.lit(0))).alias("starts")),
    )["starts"]
    out = df.withColumns({"__starts": starts}).select("*", F.posexplode(parts).alias("pos", "__m"))
    begin = F.get(F.col("__starts"), F.col("pos"))
    return out.select("*", F.array(*[F.col(f"__m.g{g}") for g in range(1, groups + 1)]).alias("groups"), F.col("__m.full").alias("full"), begin.alias("start"), (begin + F.length("__m.full")).alias("end")).drop("__starts", "__m")


def lead_span(df: DataFrame, page: Column, by, start: str = "start", end: str = "end", body: str = "body") -> DataFrame:
    """Text from each match's end to the next match's start (the last: to the end of the page)."""
    until = F.lead(start).over(window(by, [start]))
    until = F.coalesce(until, F.length(page) + 1)
    return df.withColumn(body, F.substring(page, F.col(end), F.greatest(until - F.col(end), F.lit(0))))


def until_stop(df: DataFrame, stop: Column, by, order, at_least: int = 0) -> DataFrame:
    """Rows before the first stop row; stop rows among the first ``at_least`` rows are only skipped."""
    nth = F.row_number().over(window(by, order))
    marked = df.withColumns({"__stop": stop, "__nth": nth})
    latch = F.max((F.col("__stop") & (F.col("__nth") > at_least)).cast("int")).over(so_far(by, order))
    return marked.withColumn("__latch", latch).where("__latch = 0 AND NOT __stop").drop("__stop", "__nth", "__latch")


def from_start(df: DataFrame, start: Column, by, order) -> DataFrame:
    """Rows from the first start row on."""
    return df.withColumn("__on", F.max(start.cast("int")).over(so_far(by, order))).where("__on = 1").drop("__on")


def while_on(df: DataFrame, switch_on: Column, switch_off: Column, by, order) -> DataFrame:
    """Rows under a latch that marks switch on and off again (the switching rows excluded)."""
    state = F.last(F.when(switch_on, F.lit(True)).when(switch_off, F.lit(False)), ignorenulls=True).over(so_far(by, order))
    return df.withColumns({"__on": state, "__mark": switch_on | switch_off}).where("__on AND NOT __mark").drop("__on", "__mark")


def cut_at_first(text: Column, markers: Sequence[str]) -> Column:
    """The text before the first of some markers."""
    places = [F.nullif(F.instr(text, m), F.lit(0)) for m in markers]
    at = F.least(*places) if len(places) > 1 else places[0]
    return F.when(at.isNull(), text).otherwise(F.substring(text, F.lit(1), at - 1))


def nearest_preceding(df: DataFrame, value: Column, by, order, name: str) -> DataFrame:
    """The last non-null value before each row (as-of)."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(before(by, order)))


def islands(df: DataFrame, starts: Column, by, order, name: str = "island") -> DataFrame:
    """Number of the island of each row; a row that starts opens one."""
    return df.withColumn(name, F.sum(starts.cast("int")).over(so_far(by, order)))


def assemble(df: DataFrame, text: Column, breaks: Column, by: Sequence[str], order: Sequence[str], sep: str = " ", keep_breaks: bool = False) -> DataFrame:
    """Paragraphs: lines between break rows, joined; ``keep_breaks``: a break row opens its paragraph."""
    grouped = islands(df.withColumns({"__text": text, "__break": breaks}), breaks, by, order)
    rows = grouped if keep_breaks else grouped.where("NOT __break")
    lines = F.array_sort(F.collect_list(F.struct(*order, F.col("__text").alias("t"))))
    return rows.groupBy(*by, "island").agg(F.array_join(F.transform(lines, lambda x: x["t"]), sep).alias("text"), F.min(order[0]).alias("first_pos"))


def merge_continuations(df: DataFrame, text: Column, opens: Column, by: Sequence[str], order: Sequence[str], sep: str = " ") -> DataFrame:
    """Items: an opening row and the rows up to the next opening row (bullets; author lines with their titles)."""
    return assemble(df, text, opens, by, order, sep, keep_breaks=True)


def merge_overlapping(df: DataFrame, lo: str, hi: str, slack: Column, by: Sequence[str], order: Sequence[str], name: str = "island") -> DataFrame:
    """Gap-and-island by a running maximum: an interval that starts beyond the largest end so far plus slack opens an island (from 0)."""
    reach = F.max(hi).over(before(by, order))
    opens = F.coalesce(F.col(lo) > reach + slack, F.lit(False))
    return df.withColumn("__opens", opens).withColumn(name, F.sum(F.col("__opens").cast("int")).over(so_far(by, order))).drop("__opens")


def band_rank(df: DataFrame, divider: Column, y: str, by: Sequence[str], slack: int = 1, name: str = "band") -> DataFrame:
    """Number of dividers at or above each row (``slack`` below included)."""
    w = Window.partitionBy(*by).orderBy(y).rangeBetween(Window.unboundedPreceding, slack)
    return df.withColumn(name, F.sum(divider.cast("int")).over(w))


def ordinals(df: DataFrame, by, order, negative: Column | None = None, name: str = "ordinal") -> DataFrame:
    """Numbers from 1; rows marked negative count down from -1 among themselves."""
    if negative is None:
        return df.withColumn(name, F.row_number().over(window(by, order)))
    nth = F.row_number().over(window([*by, negative], order))
    return df.withColumn(name, F.when(negative, -nth).otherwise(nth))


def runs(df: DataFrame, member: Column, by, order, name: str = "run") -> DataFrame:
    """Number of each run of consecutive member rows (null for others): difference of two row numbers."""
    nth, among = F.row_number().over(window(by, order)), F.row_number().over(window([*by, member], order))
    return df.withColumn(name, F.when(member, nth - among))


def first_fitting(df: DataFrame, fits: Column, order: Column, text: str, by: Sequence[str], among: int, name: str) -> DataFrame:
    """For each sequence the first fitting text among its first rows."""
    return df.where(order < among).where(fits).groupBy(*by).agg(F.min_by(text, order).alias(name))
