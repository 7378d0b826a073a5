"""Data-quality rules: violations as rows, and a gate that fails the run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """Rows that break a rule."""


def violations(df: DataFrame, key: Column, rules: Mapping[str, Column]) -> DataFrame:
    """(key, rule) of each broken rule; one pass, whatever the number of rules."""
    # a projection of their own: compiled, and what several rules read is computed once
    held = df.select(key.alias("key"), *[F.coalesce(ok, F.lit(False)).alias(f"__{i}") for i, ok in enumerate(rules.values())])
    broken = F.array(*[F.when(~F.col(f"__{i}"), F.lit(name)) for i, name in enumerate(rules)])
    return held.select("key", F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("rule"))


def require_none(found: DataFrame, show: int = 5) -> None:
    """Fail with the first few violations."""
    if rows := found.limit(show).collect():
        raise QualityError("; ".join(f"{r['rule']}: {r['key']}" for r in rows))


def asserted(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """The rows; a row that is not ok fails the job when it is computed."""
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


# What a footer of syndication says.
FOOTERS = ("appeared first on",)


def item_rules(min_description: int = 80, min_page: int = 800, domain: str = "", footers: tuple[str, ...] = FOOTERS) -> dict[str, Column]:
    """Rules of published items (columns title, link, description, content_html, page, source_url); a page's source, if any, is on the domain."""
    published = F.lower(F.concat_ws(" ", "description", "content_html"))
    return {
        "title": F.length(F.trim("title")) > 0,
        "link": (F.length(F.trim("link")) > 0) & F.startswith("link", F.lit(domain)),
        "no_body": F.coalesce(F.length("content_html"), F.lit(0)) == 0,
        "description": F.length("description") >= min_description,
        "page": F.length("page") >= min_page,
        "source": (F.coalesce("source_url", F.lit("")) == "") | F.startswith("source_url", F.lit(domain)),
        "footer": ~F.exists(F.array(*[F.lit(f) for f in footers]), lambda f: F.contains(published, f)),
    }


def page_rules(text: Column, markers: tuple[str, ...], min_chars: int = 500, least: int = 2) -> dict[str, Column]:
    """Rules of a stored page: long enough, and so many of the markers."""
    hits = sum((F.contains(F.lower(text), F.lit(m)).cast("int") for m in markers), F.lit(0))
    return {"length": F.length(text) >= min_chars, "markers": hits >= least}


def has_title(html: Column) -> Column:
    """``<h1[^>]*>.*[^ ].*</h1>`` in any case and over lines: from the first h1 to the last end tag there is more than spaces. Scans only, so a page costs its length."""
    low = F.lower(html)
    begun = F.substr(low, F.length(F.substring_index(low, "<h1", 1)) + 4)
    rest = F.when(F.contains(begun, F.lit(">")), F.substr(begun, F.instr(begun, ">") + 1)).otherwise("")
    held = F.length(rest) - F.length(F.substring_index(rest, "</h1>", -1)) - 5
    return F.when(html.isNotNull(), F.trim(F.substr(rest, F.lit(1), held)) != "")


def structure_rules(html: Column, paragraphs: int = 3, marker: str = "") -> dict[str, Column]:
    """Rules of an article's markup: a title, so many paragraphs, a marker."""
    return {"heading": has_title(html), "paragraphs": F.regexp_count(html, F.lit("(?i)<p[ >]")) >= paragraphs, "marker": F.contains(html, F.lit(marker))}
