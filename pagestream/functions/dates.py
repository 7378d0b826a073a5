"""Parsing and printing of the date forms found on pages and in feeds.

Nothing here asks for the current time: what a missing date becomes is the caller's
``run_ts``.  Every parse is a ``try_`` parse, as ANSI mode is on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats, tried in order.
LISTING_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "MMM. d, yyyy", "MMM. yyyy", "MMMM yyyy")
PLAIN_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "MMM. yyyy", "MMMM yyyy")
ARCHIVE_FORMATS = ("dd-MMM-yy", "yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy")
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def parse_first(c: Column, formats: Sequence[str] = LISTING_FORMATS) -> Column:
    """Timestamp by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats])


def parse_iso(c: Column) -> Column:
    """ISO 8601, with or without zone (session zone)."""
    return F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}"), F.trim(c).try_cast("timestamp"))


def parse_rfc822(c: Column) -> Column:
    """RFC 822 with zone as offset or GMT; the weekday is not checked."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(c), r"^[A-Za-z]{3}, *", ""), r" (GMT|UTC|UT|Z)$", " +0000")
    return F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss xx"))


def parse_any(c: Column) -> Column:
    """ISO 8601, else RFC 822."""
    return F.coalesce(parse_iso(c), parse_rfc822(c))


def format_rfc822(ts: Column) -> Column:
    return F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def human_date(ts: Column) -> Column:
    return F.date_format(ts, "MMMM dd, yyyy")


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def not_a_plain_day(c: Column) -> Column:
    """A date text that does not parse or that has a time of day (it is to be fetched again)."""
    ts = parse_any(c)
    return ts.isNull() | (ts != F.date_trunc("day", ts))


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` anywhere in a name."""
    return F.try_to_timestamp(none_if_blank(F.regexp_extract(c, r"((?:19|20)\d{6})", 1)), F.lit("yyyyMMdd"))


def date_in_text(c: Column, lead: str = "") -> Column:
    """``Month d, yyyy`` in a text, after an optional lead such as ``Posted on``."""
    return F.try_to_timestamp(none_if_blank(F.regexp_extract(c, rf"{lead}\s*((?:{MONTHS}) \d{{1,2}}, \d{{4}})", 1)), F.lit("MMMM d, yyyy"))


def none_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_run(ts: Column, run_ts: Column) -> Column:
    """A missing date is the run's."""
    return F.coalesce(ts, run_ts)


def build_date(changed: Column, run_ts: Column, previous: Column) -> Column:
    """The run's time where something changed, else the previous build's."""
    return F.when(changed, run_ts).otherwise(F.coalesce(previous, run_ts))
