"""Writers: feeds as XML, item pages, keyed JSON, run logs, rehosted assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, urls

VERSION_MARK = "item-render-version"


def item_xml(indent: str = "    ") -> Column:
    """One well-formed ``<item>`` of the item columns; empty elements are left out."""
    tag = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{indent}  <{name}>"), text.escape_html(c), F.lit(f"</{name}>")))
    link = F.coalesce(F.col("is_permalink"), F.lit(False)).cast("string")
    guid = F.concat(F.lit(f'{indent}  <guid isPermaLink="'), link, F.lit('">'), text.escape_html(F.col("guid")), F.lit("</guid>"))
    date = F.when(F.col("pub_ts").isNotNull(), F.concat(F.lit(f"{indent}  <pubDate>"), dates.format_rfc822(F.col("pub_ts")), F.lit("</pubDate>")))
    body = tag("content:encoded", F.col("content_html"))
    return F.concat_ws("\n", F.lit(f"{indent}<item>"), tag("title", F.col("title")), tag("link", F.col("link")), guid, date, tag("author", F.col("author")), tag("description", F.col("description")), body, F.lit(f"{indent}</item>"))


def feed_xml(items: DataFrame, channels: DataFrame) -> DataFrame:
    """feed, xml: one document for each channel, items in order."""
    rows = items.select("feed", "pos", item_xml().alias("x")).groupBy("feed").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda r: r["x"]), "\n").alias("body"))
    esc = lambda c: text.escape_html(F.coalesce(F.col(c), F.lit("")))
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/">\n  <channel>\n    <title>'), esc("title"), F.lit("</title>\n    <link>"), esc("link"), F.lit("</link>\n    <description>"), esc("description"), F.lit("</description>\n"),
        F.when(F.coalesce("language", F.lit("")) != "", F.concat(F.lit("    <language>"), esc("language"), F.lit("</language>\n"))).otherwise(F.lit("")),
        F.lit("    <lastBuildDate>"), dates.format_rfc822(F.col("last_build")), F.lit("</lastBuildDate>\n"),
    )
    xml = F.concat(head, F.coalesce(F.col("body"), F.lit("")), F.lit("\n  </channel>\n</rss>\n"))
    return channels.join(rows, "feed", "left").select("feed", xml.alias("xml"))


def write_feeds(items: DataFrame, channels: DataFrame, path: str) -> None:
    """One text file for each feed under ``path/feed=<name>``."""
    feed_xml(items, channels).repartition("feed").write.mode("overwrite").partitionBy("feed").text(path)


def item_page(title: Column, body: Column, source: Column, version: int | None = None, lang: str = "en") -> Column:
    """HTML page of an item: title, source line, body, canonical link, render version."""
    t, s = text.escape_html(F.coalesce(title, F.lit(""))), text.escape_html(F.coalesce(source, F.lit("")))
    meta = F.lit(f'<meta name="{VERSION_MARK}" content="{version}">\n') if version is not None else F.lit("")
    canonical = F.when(s != "", F.concat(F.lit('<link rel="canonical" href="'), s, F.lit('">\n'))).otherwise(F.lit(""))
    line = F.when(s != "", F.concat(F.lit('<p class="source"><a href="'), s, F.lit('" rel="noopener">'), s, F.lit("</a></p>\n"))).otherwise(F.lit(""))
    return F.concat(F.lit(f'<!DOCTYPE html>\n<html lang="{lang}"><head><meta charset="utf-8">\n'), meta, canonical, F.lit("<title>"), t, F.lit("</title></head>\n<body>\n<h1>"), t, F.lit("</h1>\n"), line, F.coalesce(body, F.lit("")), F.lit("\n</body></html>\n"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages as a table by feed (feed, slug, html)."""
    pages.write.mode("overwrite").partitionBy("feed").parquet(path)


def keyed_json(items: DataFrame) -> DataFrame:
    """feed, json: slug to title, description and source link of each feed."""
    entry = F.struct("slug", F.struct("title", "description", F.col("source_url").alias("source_link")).alias("v"))
    return items.groupBy("feed").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["slug"] < b["slug"], -1).when(a["slug"] > b["slug"], 1).otherwise(0)))).alias("json"))


def pages_of_json(keyed: DataFrame) -> DataFrame:
    """feed, slug, html of such JSON."""
    parsed = F.from_json("json", "map<string,struct<title:string,description:string,source_link:string>>")
    rows = keyed.select("feed", F.explode(parsed).alias("slug", "v"))
    body = F.concat(F.lit("<p>"), text.escape_html(F.col("v.description")), F.lit("</p>"))
    return rows.select("feed", "slug", item_page(F.col("v.title"), body, F.col("v.source_link")).alias("html"))


def log_run(df: DataFrame, path: str) -> None:
    """Append status rows to the run log."""
    df.write.mode("append").parquet(path)


def rehosted(pages: DataFrame, assets: DataFrame, html: str = "html") -> DataFrame:
    """Pages with asset URLs replaced by local names (assets: url, local); others stay."""
    used = pages.select("*", urls.asset_urls(F.col(html)).alias("__urls"))
    pairs = used.select("feed", "slug", F.explode(F.array_distinct("__urls")).alias("url")).join(assets, "url")
    maps = pairs.groupBy("feed", "slug").agg(F.array_sort(F.collect_list(F.struct(F.col("url").alias("k"), F.col("local").alias("v")))).alias("__map"))
    joined = used.join(maps, ["feed", "slug"], "left").drop("__urls")
    return joined.withColumn(html, F.when(F.col("__map").isNull(), F.col(html)).otherwise(text.apply_map(F.col(html), F.col("__map")))).drop("__map")


def mirror(files: DataFrame, path: str) -> None:
    """Files unchanged, as rows of path and content."""
    files.select("path", "content").write.mode("overwrite").parquet(path)
