"""Readers: feeds, sitemaps, stored pages, JSON listings, configuration, page cache, binaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text

_RSS = "title STRING, link STRING, guid STRUCT<_VALUE: STRING, _isPermaLink: BOOLEAN>, pubDate STRING, author STRING, description STRING, `content:encoded` STRING, _corrupt_record STRING"


def read_feed(spark: SparkSession, path: str | Sequence[str], item_tag: str = "item") -> DataFrame:
    """Items of RSS files, tolerant of malformed items (``is_broken``)."""
    raw = spark.read.format("xml").option("rowTag", item_tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(_RSS).load(list(path) if not isinstance(path, str) else path)
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.xml$", 1).alias("feed"),
        "title", "link", F.col("guid._VALUE").alias("guid"), F.coalesce("guid._isPermaLink", F.lit(True)).alias("is_permalink"),
        dates.parse_any(F.col("pubDate")).alias("pub_ts"), F.col("pubDate").alias("pub_date_raw"), "author", "description", F.col("content:encoded").alias("content_html"),
        F.col("_corrupt_record").isNotNull().alias("is_broken"),
    )


def read_previous(spark: SparkSession, path: str) -> DataFrame:
    """Items of the previous snapshot with their slugs; an empty table where there is none."""
    try:
        items = read_feed(spark, path)
        items.schema  # noqa: B018
    except Exception as e:  # a missing path is an empty history, anything else is an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        items = spark.createDataFrame([], "feed string, title string, link string, guid string, is_permalink boolean, pub_ts timestamp, pub_date_raw string, author string, description string, content_html string, is_broken boolean")
    return items.withColumn("slug", text.slug_of(F.col("link"), F.col("title")))


def read_channel(spark: SparkSession, path: str) -> DataFrame:
    """Title, link and last build time of feeds."""
    schema = "title STRING, link STRING, description STRING, language STRING, lastBuildDate STRING, generator STRING"
    raw = spark.read.format("xml").option("rowTag", "channel").schema(schema).load(path)
    return raw.withColumn("last_build", dates.parse_any(F.col("lastBuildDate"))).drop("lastBuildDate")


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """url and time of sitemap entries, with or without the sitemap namespace."""
    raw = spark.read.format("xml").option("rowTag", "url").option("ignoreNamespace", "true").schema("loc STRING, lastmod STRING").load(path)
    return raw.select(F.trim("loc").alias("url"), dates.parse_any(F.col("lastmod")).alias("modified"))


def read_pages(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Stored pages: path, feed, slug and html, one row for each file."""
    raw = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    at = F.col("_metadata.file_path")
    return raw.select(at.alias("path"), F.regexp_extract(at, r"/item/([^/]+)/([^/]+)/", 1).alias("feed"), F.regexp_extract(at, r"/item/([^/]+)/([^/]+)/", 2).alias("slug"), F.col("value").alias("html"))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Proxy pages: title, published time and markdown body of the text after their header lines."""
    raw = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(path)
    v = F.col("value")
    field = lambda k: text.none_if_empty(F.trim(F.regexp_extract(v, rf"(?m)^{k}: *(.*)$", 1)))
    body = F.when(F.contains(v, F.lit("Markdown Content:")), F.regexp_extract(v, r"(?s)Markdown Content:\s*(.*)$", 1)).otherwise(v)
    return raw.select(F.col("_metadata.file_path").alias("path"), field("Title").alias("title"), dates.parse_any(field("Published Time")).alias("published"), body.alias("markdown"))


def read_listing_json(spark: SparkSession, path: str, limit: int | None = None, base: str = "") -> DataFrame:
    """Records of a listing: the limit counts before records without title or url go."""
    raw = spark.read.option("multiLine", "true").schema("url STRING, title STRING, description STRING, formattedPublishedDate STRING, formattedArticleDate STRING, image STRING").json(path)
    numbered = raw.withColumn("pos", F.monotonically_increasing_id())
    first = numbered.orderBy("pos").limit(limit) if limit else numbered
    link = F.when(F.startswith("url", F.lit("/")), F.concat(F.lit(base), F.col("url"))).otherwise(F.col("url"))
    return first.where((F.coalesce("title", F.lit("")) != "") & (F.coalesce("url", F.lit("")) != "")).select("pos", link.alias("link"), "title", "description", text.first_of(F.col("formattedPublishedDate"), F.col("formattedArticleDate")).alias("pub_date_raw"), "image")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits of a search answer, in order."""
    raw = spark.read.option("multiLine", "true").schema("insights STRUCT<hits: ARRAY<STRUCT<title: STRING, summaryTitle: STRING, pagePath: STRING, slug: STRING, publishDate: STRING, summaryDescription: STRING>>>").json(path)
    hits = raw.select(F.posexplode("insights.hits").alias("pos", "h"))
    return hits.select("pos", text.first_of(F.col("h.summaryTitle"), F.col("h.title")).alias("title"), text.first_of(F.col("h.pagePath"), F.col("h.slug")).alias("path"), dates.parse_iso(F.col("h.publishDate")).alias("pub_ts"), F.col("h.summaryDescription").alias("description"))


def read_posts(spark: SparkSession, listing: str, detail: str) -> DataFrame:
    """REST posts: the narrow listing joined by id with the detail that has the body."""
    part = "id LONG, link STRING, date STRING, date_gmt STRING, title STRUCT<rendered: STRING>, excerpt STRUCT<rendered: STRING>"
    posts = spark.read.option("multiLine", "true").schema(part).json(listing)
    bodies = spark.read.option("multiLine", "true").schema("id LONG, content STRUCT<rendered: STRING>").json(detail)
    ts = F.coalesce(dates.parse_iso(F.concat("date_gmt", F.lit("Z"))), dates.parse_iso(F.col("date")))
    return posts.join(bodies, "id", "left").select("id", "link", ts.alias("pub_ts"), F.col("title.rendered").alias("title"), F.col("excerpt.rendered").alias("description"), F.col("content.rendered").alias("content_html"))


def read_binaries(spark: SparkSession, path: str, magic: bytes, least: int) -> DataFrame:
    """Files with the right first bytes and a least length."""
    from ..functions.predicates import is_valid_binary

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(is_valid_binary(F.col("content"), magic, least))


def merged(defaults: Mapping[str, Any], own: Mapping[str, Any]) -> dict[str, Any]:
    """Settings over defaults: maps merge by key at every depth, anything else replaces."""
    out = dict(defaults)
    for k, v in own.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def load_config(own: str, defaults: str = "") -> dict[str, Any]:
    """Settings of a feed from YAML text over default YAML text."""
    parsed = [yaml.safe_load(x) if x.strip() else {} for x in (defaults, own)]
    for p in parsed:
        if not isinstance(p, Mapping):
            raise ValueError("configuration must be a mapping")
    return merged(*parsed)


def first_source(*sources: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the first source that has any (for each group ``by``)."""
    from pyspark.sql import Window

    every = None
    for k, s in enumerate(sources):
        s = s.withColumn("__priority", F.lit(k))
        every = s if every is None else every.unionByName(s, allowMissingColumns=True)
    if by:
        return every.withColumn("__best", F.min("__priority").over(Window.partitionBy(*by))).where("__priority = __best").drop("__priority", "__best")
    best = every.agg(F.min("__priority").alias("__best"))
    return every.join(F.broadcast(best), F.col("__priority") == F.col("__best")).drop("__priority", "__best")


def cache_key(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 12)


def not_cached(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """URLs that the page cache does not hold."""
    return wanted.withColumn("key", cache_key(F.col("url"))).join(cache.select("key"), "key", "left_anti")


def save_cache(fetched: DataFrame, path: str) -> None:
    """Append fetched pages (url and others) to the page cache under their keys."""
    fetched.withColumn("key", cache_key(F.col("url"))).write.mode("append").parquet(path)


def with_aliases(items: DataFrame, stored: DataFrame, aliases: Sequence[Column], key: str, value: str) -> DataFrame:
    """The stored value under the first alias that has one."""
    out, names = items, []
    for k, a in enumerate(aliases):
        side = stored.select(F.col(key).alias(f"__k{k}"), F.col(value).alias(f"__v{k}"))
        out = out.join(side, a == F.col(f"__k{k}"), "left").drop(f"__k{k}")
        names.append(f"__v{k}")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)
