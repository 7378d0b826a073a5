"""One run of a builder: listing, reuse of what is stored, budget of new pages, publication.

State has one row for each published item, under ``key`` (feed and slug).  Nothing is
fetched here: ``details`` holds the articles that a crawl has stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, html, text
from ..operators import dedup, joins, quality, topk
from ..sources import sinks
from ..streaming import incremental

STATE = "key STRING, feed STRING, slug STRING, title STRING, link STRING, description STRING, pub_date_raw STRING, print STRING, version INT, html STRING"
COLUMNS = [c.split(" ")[0] for c in STATE.split(", ")]


def rendered(items: DataFrame, details: DataFrame, version: int) -> DataFrame:
    """``html`` of items (title, link) by their articles (link, content_html): whitelisted bodies in item pages; null without an article."""
    bodies = dedup.first_wins(details.select(F.col("link").alias("__link"), "content_html"), "__link", ["content_html"])
    joined = items.join(bodies, F.col("link") == F.col("__link"), "left")
    clean = F.when(F.col("content_html").isNotNull(), html.whitelist_html(F.col("content_html"), F.col("link")))
    page = F.when(clean.isNotNull(), sinks.item_page(F.col("title"), clean, F.col("link"), version))
    return joined.withColumn("html", page).drop("__link", "content_html")


def planned(listing: DataFrame, details: DataFrame, stored: DataFrame, run_ts: Column, version: int, first: int = 10, later: int = 40, budget: int = 5) -> DataFrame:
    """The next state, with ``action`` and ``deferred``.

    ``listing``: feed, pos, title, link, description, pub_date_raw.  A link counts once; each
    feed keeps its newest items, ``first`` of them while it has no history, ``later`` after.
    Unchanged items keep their stored rows.  Others are rendered, ``budget`` of them for each
    feed and run; those beyond it, and those without an article, keep what is stored, and wait
    where nothing is.  Known items keep their dates; new ones take the listing's or the run's.
    """
    slug = text.slug_of(F.col("link"), F.col("title"))
    once = dedup.first_wins(listing, ["feed", "link"], ["pos"])
    keyed = once.withColumns({"slug": slug, "print": text.short_hash(F.col("title"), F.col("description")), "ts": F.coalesce(dates.parse_any(F.col("pub_date_raw")), dates.parse_first(F.col("pub_date_raw")))})
    keyed = keyed.withColumn("key", F.concat_ws("/", "feed", "slug"))
    keyed = dedup.first_wins(keyed, "key", ["pos"])
    history = stored.select("feed").distinct().withColumn("__known", F.lit(1))
    newest = [topk.newest_first(F.col("ts"), "last"), F.col("pos")]
    limit = topk.first_run_limit(F.coalesce("__known", F.lit(0)), first, later)
    listed = topk.limit_by(keyed.join(history, "feed", "left"), ["feed"], newest, limit).drop("__known")

    actions = incremental.plan_upsert(listed, stored, "key", "print", version)
    due = topk.within_budget(actions, ["feed"], F.col("action") != "kept", newest, budget)
    due = joins.carry_forward(due, stored, "key", "pub_date_raw", dates.format_rfc822(F.col("ts")), dates.format_rfc822(run_ts))
    building = (F.col("action") != "kept") & ~F.col("deferred")
    made = rendered(due.where(building), details, version)
    fresh = made.where(F.col("html").isNotNull()).select(*[c for c in COLUMNS if c != "version"], F.lit(version).alias("version"), "action", "deferred")
    waiting = due.where(~building).select("key", "action", "deferred").unionByName(made.where(F.col("html").isNull()).select("key", "action", F.lit(True).alias("deferred")))
    kept = stored.select(*COLUMNS).join(waiting, "key")
    return fresh.unionByName(kept)


def run(snapshots: incremental.Snapshots, listing: DataFrame, details: DataFrame, run_ts: Column, version: int, rules: dict[str, Column] | None = None, **limits: int) -> str | None:
    """Plan, check and publish a run; with nothing changed or a broken rule the last version stays (a broken rule is an error)."""
    spark = listing.sparkSession
    stored = snapshots.load(schema=spark.createDataFrame([], STATE).schema)
    out = planned(listing, details, stored, run_ts, version, **limits).persist()
    try:
        if rules:
            quality.require_none(quality.violations(out, F.col("key"), rules))
        done = out.where((F.col("action") != "kept") & ~F.col("deferred"))
        changed = not done.isEmpty() or not joins.nothing_new(stored, out, "key")
        return snapshots.publish_if(changed, out.select(*COLUMNS))
    finally:
        out.unpersist()
