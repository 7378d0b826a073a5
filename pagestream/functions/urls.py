"""URL columns: canonical form, parts, references, local paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import none_if_empty


def canonical_url(c: Column) -> Column:
    """Without query, fragment and trailing slashes."""
    return F.rtrim(F.regexp_replace(c, r"[?#].*$", ""), F.lit("/"))


def url_host(c: Column) -> Column:
    return F.lower(none_if_empty(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(F.rtrim(url_path(c), F.lit("/")), "/"), -1)


def is_pdf_url(c: Column) -> Column:
    return F.endswith(F.lower(url_path(c)), F.lit(".pdf"))


def proxy_urls(c: Column, proxy: str) -> Column:
    """The two forms in which a text proxy takes a URL (with either scheme)."""
    bare = F.regexp_replace(c, r"^https?://", "")
    return F.array(F.concat(F.lit(f"{proxy}/http://"), bare), F.concat(F.lit(f"{proxy}/https://"), bare))


def links(html: Column) -> Column:
    """Targets of the page's links, in page order."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a [^>]*href="([^"]*)"'), F.lit(1))


def asset_refs(html: Column) -> Column:
    """Relative references of src, href and data attributes, first occurrence first."""
    every = F.regexp_extract_all(html, F.lit(r'(?i)(?:src|href|data)="([^"]+)"'), F.lit(1))
    return F.array_distinct(F.filter(every, lambda x: ~x.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|//|/|#)")))


def asset_urls(html: Column) -> Column:
    """References of src and of every srcset candidate, united."""
    src = F.regexp_extract_all(html, F.lit(r'(?i)\ssrc="([^"]+)"'), F.lit(1))
    sets = F.regexp_extract_all(html, F.lit(r'(?i)\ssrcset="([^"]+)"'), F.lit(1))
    each = F.flatten(F.transform(sets, lambda s: F.transform(F.split(s, ","), lambda x: F.split_part(F.trim(x), F.lit(" "), F.lit(1)))))
    return F.array_union(src, F.filter(each, lambda x: x != ""))


def root_relative_to(html: Column, base: str) -> Column:
    """Root-relative src, href and srcset references made absolute."""
    out = F.regexp_replace(html, r'(?i)(\s(?:src|href)=")/(?!/)', f"$1{base}/")
    return F.regexp_replace(out, r'(?i)(\ssrcset="|,\s*)/(?!/)', f"$1{base}/")


def item_page_url(base: str, feed: Column, slug: Column) -> Column:
    return F.concat(F.lit(f"{base}/item/"), feed, F.lit("/"), slug, F.lit("/"))


def item_of_path(path: Column) -> Column:
    """struct<feed, slug> of an item page's path or URL; nulls where it is none."""
    part = lambda k: none_if_empty(F.regexp_extract(path, r"/item/([^/?#]+)/([^/?#]+)", k))
    return F.struct(part(1).alias("feed"), part(2).alias("slug"))


def is_localized(link: Column, base: str, feed: Column) -> Column:
    """Whether a link points at the feed's own item pages (absolute under ``base``, or root-relative)."""
    own = F.concat(F.lit("/item/"), feed, F.lit("/"))
    absolute = link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    return F.when(absolute, F.startswith(link, F.concat(F.lit(base), own))).otherwise(F.startswith(link, own))


def external_source(canonical: Column, anchors: Column, own: str) -> Column:
    """The page's source: its canonical link unless that is our own, else the first external link."""
    outside = F.filter(anchors, lambda a: a.rlike(r"^https?://") & ~F.contains(a, F.lit(own)))
    return F.coalesce(F.when(~F.contains(canonical, F.lit(own)), none_if_empty(canonical)), F.get(outside, F.lit(0)))
