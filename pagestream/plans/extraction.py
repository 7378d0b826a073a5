"""Named pipelines: generic extraction by configuration, feed rewriting, listings, articles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, html, json, predicates, text, urls
from ..operators import aggregates, dedup, joins, layout, sequence, topk


# Lines that are a date, markup that descriptions lose, dates of cards ({tail}: the link text), and how descriptions of cards begin.
DATE_LINES = (r"^[A-Z][a-z]+ +\d{1,2}, +\d{4}$", r"^[A-Z][a-z]+\.? +\d{4}$")
DESCRIPTION_MARKUP = (r"!\[[^\]]*\]\([^)]+\)", r"(?i)\[Read more(?: about[^\]]*)?\]\([^)]+\)")
CARD_DATES = (r"\|([A-Za-z]+ +\d{1,2}, +\d{4})", r"([A-Za-z]+ +\d{1,2}, +\d{4}) +{tail}")
DESCRIPTION_STARTS = ("The", "This", "These")


def up_to_line(body: Column, stops: Sequence[str] = DATE_LINES, drop: Sequence[str] = DESCRIPTION_MARKUP, limit: int = 500) -> Column:
    """struct<description, date>: the lines up to the first that a stop pattern fits, cleaned and cut, and that line."""
    nothing = F.struct(F.lit("").alias("text"), F.lit(None).cast("string").alias("stop"))

    def add(seen: Column, raw: Column) -> Column:
        line = text.trim_ws(raw)
        stop = F.when(line.rlike("|".join(f"(?:{p})" for p in stops)), line)
        grown = F.struct(F.when(stop.isNull(), F.concat(seen["text"], F.lit(" "), line)).otherwise(seen["text"]).alias("text"), stop.alias("stop"))
        return F.when(seen["stop"].isNull(), grown).otherwise(seen)

    read = F.aggregate(F.split(body, "\n"), nothing, add)
    clean = text.collapse(read["text"])
    for pattern in drop:
        clean = F.regexp_replace(clean, pattern, "")
    return F.struct(text.truncate_hard(F.trim(clean), limit).alias("description"), read["stop"].alias("date"))


def card_fields(raw: Column, tail: str = "Learn more", found_dates: Sequence[str] = CARD_DATES, starts: Sequence[str] = DESCRIPTION_STARTS) -> Column:
    """struct<title, description, date> of a card's text: the description begins at the first of the words in ``starts`` that occurs."""
    date = text.first_of(*[F.regexp_extract(raw, p.replace("{tail}", tail), 1) for p in found_dates])
    core = F.trim(F.regexp_replace(raw, rf"(?i)(\|[^L]*| +){tail}.*$", ""))
    halves = lambda word: F.split(core, f" {word} ", 2)
    divided = [F.when(F.size(halves(w)) == 2, F.struct(F.trim(halves(w)[0]).alias("title"), F.concat(F.lit(f"{w} "), halves(w)[1]).alias("description"))) for w in starts]
    both = F.coalesce(*divided, F.struct(core.alias("title"), core.alias("description")))
    return F.struct(both["title"].alias("title"), both["description"].alias("description"), date.alias("date"))


def extract_items(pages: DataFrame, config: Mapping[str, Any], previous: DataFrame, run_ts: Column, undated_new: str = "run") -> DataFrame:
    """Items of the pages of one feed by its configuration.

    Spans by pattern, title and link by template, link filter, text up to the next span,
    description and date, identity, first-wins dedup, known dates carried forward, limit.
    ``pages`` has url and html; ``previous`` has guid and pub_date_raw.  ``undated_new``:
    a new item without a date takes the run's time, or none.
    """
    ex, out, settings = config.get("extraction", {}), config.get("output", {}), config.get("settings", {})
    pattern = text.template_regex(ex["pattern"])
    link_group = int(ex.get("link_group", 2))
    n = int(ex.get("groups", max(link_group, 2)))
    spans = sequence.lead_span(sequence.match_spans(pages.select("url", "html"), F.col("html"), pattern, n), F.col("html"), ["url"])
    link_raw = F.get("groups", F.lit(link_group - 1))
    if ex.get("link_filter"):
        spans = spans.where(link_raw.rlike(ex["link_filter"]))
    item = out.get("item") or {}
    filled = spans.select(
        "url", "pos", "body",
        text.collapse(text.fill_template(item.get("title", "{0}"), F.col("groups"), link_raw)).alias("title"),
        F.trim(text.fill_template(item.get("link", "{" + str(link_group - 1) + "}"), F.col("groups"), link_raw)).alias("link"),
        up_to_line(F.col("body")).alias("d"),
    )
    items = filled.select("url", "pos", "title", "link", F.col("d.description").alias("description"), F.col("d.date").alias("date_text"), text.guid(F.col("title"), F.col("link")).alias("guid"))
    if settings.get("dedup", True):
        items = dedup.first_wins(items, [F.col("url"), F.col("guid")], ["pos"])
    parsed = dates.parse_first(F.col("date_text"))
    fresh = dates.format_rfc822(parsed)
    items = joins.carry_forward(items, previous, "guid", "pub_date_raw", fresh, dates.format_rfc822(run_ts) if undated_new == "run" else F.lit(None).cast("string"))
    items = topk.limit_by(items, ["url"], [F.col("pos")], int(settings.get("max_items", 200)))
    return items.withColumns({"pub_ts": dates.parse_any(F.col("pub_date_raw")), "slug": text.slug_of(F.col("link"), F.col("title"))}).drop("date_text")


def rewrite_feed(items: DataFrame, pages: DataFrame, base: str, localized: list[str]) -> DataFrame:
    """Published form of a feed: the page's text replaces a shorter description; localized feeds link to their own pages.

    ``items``: feed, slug, title, link, guid, description, content_html; ``pages``: feed, slug, html.
    The body is not published.
    """
    stored = pages.select("feed", "slug", text.plain_page_text(F.col("html")).alias("__full"))
    joined = items.join(stored, ["feed", "slug"], "left")
    full = F.coalesce("__full", text.plain_page_text(F.col("content_html")), F.lit(""))
    shown = F.when(F.length(full) > F.length(F.coalesce("description", F.lit(""))), text.truncate_words(full)).otherwise(F.col("description"))
    local = F.col("feed").isin(localized)
    url = urls.item_page_url(base, F.col("feed"), F.col("slug"))
    return joined.withColumns({"description": shown, "link": F.when(local, url).otherwise(F.col("link")), "source_guid": F.col("guid"), "guid": F.when(local, url).otherwise(F.col("guid")), "is_permalink": local, "content_html": F.lit(None).cast("string")}).drop("__full")


def markdown_links(pages: DataFrame, text_col: str, least: int = 3) -> DataFrame:
    """Links of markdown listings: url, pos, title, link; titles of bare links come from their slugs."""
    found = F.arrays_zip(F.regexp_extract_all(text_col, F.lit(r"\[([^\]]*)\]\((https?://[^)\s]+)\)"), F.lit(1)).alias("label"), F.regexp_extract_all(text_col, F.lit(r"\[([^\]]*)\]\((https?://[^)\s]+)\)"), F.lit(2)).alias("link"))
    rows = pages.select("url", F.posexplode(found).alias("pos", "m")).select("url", "pos", F.col("m.label").alias("label"), F.col("m.link").alias("link"))
    title = F.when(F.length("label") >= least, F.col("label")).otherwise(text.title_from_slug(urls.last_segment(F.col("link"))))
    return dedup.first_wins(rows.withColumn("title", title).drop("label"), [F.col("url"), F.col("link")], ["pos"])


def parse_article(pages: DataFrame, min_chars: int = 280) -> DataFrame:
    """Articles of markdown pages (url, title, markdown): cleaned, as HTML and text, blocked and short ones gone."""
    body = text.clean_article_markdown(F.col("markdown"), F.coalesce("title", F.lit("")))
    good = pages.where(~predicates.looks_blocked(F.col("markdown")) & ~predicates.is_shell(F.col("markdown")))
    made = good.withColumn("__body", body).withColumns({"content_html": text.block_markdown(F.col("__body")), "plain": text.strip_markdown_links(F.col("__body"))})
    return made.where(F.length("plain") >= min_chars).withColumn("description", text.truncate_words(F.col("plain"))).drop("__body")


def article_paragraphs(lines: DataFrame, by: list[str], order: str, line: str, title: str, stops: Sequence[str] = predicates.ARTICLE_ENDS, description: str | None = None) -> DataFrame:
    """Paragraphs of noisy text: junk lines go, lines join into paragraphs, text after a stop mark, junk and repeats go."""
    clean = lines.where(~predicates.is_junk_line(F.col(line)) | (F.trim(line) == ""))
    paragraphs = sequence.assemble(clean, F.trim(line), F.trim(line) == "", by, [order])
    known = [title, description] if description else [title]
    titled = paragraphs.join(lines.select(*by, *known).distinct(), by)
    stop = predicates.count_hits(F.lower("text"), list(stops)) > 0
    kept = sequence.until_stop(titled, stop, by, ["first_pos"], at_least=3)
    good = kept.where(~predicates.is_junk_paragraph(F.col("text"), F.col(title), F.col(description) if description else None))
    return dedup.first_wins(good, [*by, F.lower("text")], ["first_pos"])


# How siblings of the tabbed layout end the article, and how paragraphs that it loses begin.
TAB_STOPS = (r"^read our past weekly market commentaries", r"big calls|tactical granular views")
TAB_SKIPPED = ("Source:", "Sources:", "Past performance", "Read our past")


def tabbed_article(siblings: DataFrame, by: list[str], base: str, stops: Sequence[str] = TAB_STOPS, skipped: Sequence[str] = TAB_SKIPPED) -> DataFrame:
    """by, content_html: the article of a tabbed layout.

    ``siblings``: one row for each element of the blocks beside the tabs: ``by``, block, block_text,
    component (paragraph, image or another), tabs (how many tabs there are), pos, tag (h2, p, img),
    text and src.  As many paragraph and image blocks count as there are tabs, up to a stop block.
    Headings stay always, other texts once; images become absolute.
    """
    used = siblings.where(F.col("component").isin("paragraph", "image"))
    nth = F.dense_rank().over(sequence.window(by, ["block"]))
    # the rows of a block share its text, so a block that stops is out as a whole, and so is all after it
    shown = sequence.until_stop(used.withColumn("__nth", nth).where("__nth <= tabs"), F.lower(text.collapse(F.col("block_text"))).rlike("|".join(f"(?:{p})" for p in stops)), by, ["block", "pos"])
    body, is_image = text.collapse(F.coalesce("text", F.lit(""))), F.col("tag") == "img"
    src = F.when(F.startswith("src", F.lit("/")), F.concat(F.lit(base), F.col("src"))).otherwise(F.coalesce("src", F.lit("")))
    loses = F.exists(F.array(*[F.lit(s.lower()) for s in skipped]), lambda s: F.startswith(F.lower(body), s))
    rows = shown.where((is_image & (src != "")) | (~is_image & (body != "") & ~loses & (F.col("component") == "paragraph")))
    once = dedup.first_wins_or_forced(rows, F.when(is_image, src).otherwise(F.lower(body)), ["block", "pos"], F.col("tag") == "h2", by)
    escaped = text.escape_html(body)
    markup = F.when(is_image, F.concat(F.lit('<p><img src="'), text.escape_html(src), F.lit('" alt="" /></p>'))).when(F.col("tag") == "h2", F.concat(F.lit("<p><strong>"), escaped, F.lit("</strong></p>"))).otherwise(F.concat(F.lit("<p>"), escaped, F.lit("</p>")))
    made = once.select(*by, F.struct("block", "pos").alias("at"), markup.alias("markup"))
    return aggregates.ordered_join(made, by, "at", "markup", "").withColumnRenamed("joined", "content_html")


# Words that begin the description of a report card, and titles of cards that are sections.
REPORT_STARTS = "The|Our|This|These|A|An"
REPORT_SECTIONS = (
    "Private Market Benchmarks Reports", "Venture Monitor Reports", "Private Equity Reports", "M&A Reports", "Fundraising Reports", "Fund Performance Reports", "Credit Reports",
    "Private Debt Reports",
)


def report_cards(pages: DataFrame, text_col: str, mark: str = "Research ###", starts: str = REPORT_STARTS, sections: Sequence[str] = REPORT_SECTIONS) -> DataFrame:
    """Cards of markdown listings, ``[... mark Title The ... date](link)``: url, pos, title, description, date_text and link; undated cards and sections go, links count once."""
    pattern = F.lit(rf"\[((?:!\[[^\]]*\]\([^)]*\)|[^\[\]])*{mark}[^\[\]]*)\]\((https?://[^)\s]+)\)")
    found = F.arrays_zip(F.regexp_extract_all(text_col, pattern, F.lit(1)).alias("raw"), F.regexp_extract_all(text_col, pattern, F.lit(2)).alias("link"))
    rows = pages.select("url", F.posexplode(found).alias("pos", "m")).select("url", "pos", F.col("m.raw").alias("raw"), F.col("m.link").alias("link"))
    plain = text.collapse(F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", r"!\[[^\]]*\]\([^)]+\)", ""), rf"^\s*{mark}\s+", ""), r"(?s)\s+Learn more.*$", ""))
    date = text.none_if_empty(F.regexp_extract(plain, r"([A-Z][a-z]+\.? +[0-9]{1,2}, +[0-9]{4})$", 1))
    head = F.trim(F.regexp_replace(plain, r"([A-Z][a-z]+\.? +[0-9]{1,2}, +[0-9]{4})$", ""))
    halves = rf"^(.+?) ((?:{starts}) .+)$"
    title, about = text.first_of(F.regexp_extract(head, halves, 1), head), text.first_of(F.regexp_extract(head, halves, 2), head)
    cards = rows.select("url", "pos", "link", title.alias("title"), about.alias("description"), date.alias("date_text")).where(F.col("title").isNotNull() & F.col("date_text").isNotNull() & ~F.col("title").isin(list(sections)))
    return dedup.first_wins(cards, [F.col("url"), F.col("link")], ["pos"])


def headline(blocks: DataFrame, by: list[str], least: int = 70) -> DataFrame:
    """The text of the largest size, the longest of that size; none if it is shorter than ``least``."""
    best = aggregates.best_candidate(blocks, by, [F.col("size"), F.length("text")], ["text", "size"], "pos")
    return best.where(F.length("text") >= least)


def component_article(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Article of a page's components (pos, component, text, markup): navigation and skipped kinds go, repeats go unless forced, up to the stop component."""
    content = blocks.where(~predicates.is_navigation(F.col("text")) & ~F.col("component").isin("nav", "footer", "disclaimer", "share"))
    begun = sequence.until_stop(content, F.col("component") == "stop", by, ["pos"])
    once = dedup.first_wins_or_forced(begun, F.lower(text.collapse(F.col("text"))), ["pos"], F.col("component") == "image", by)
    return aggregates.ordered_join(once, by, "pos", "markup")


def windowed_paragraphs(pages: DataFrame, body: str, anchor: Column, stops: list[str], size: int = 40_000, most: int = 18) -> DataFrame:
    """Paragraphs of a bounded window from an anchor to the first stop mark, without noise lines."""
    at = F.greatest(F.instr(F.col(body), anchor), F.lit(1))
    window = sequence.cut_at_first(F.substring(F.col(body), at, F.lit(size)), stops)
    rows = pages.withColumn("__w", window).select(*[c for c in pages.columns if c != body], F.posexplode(F.filter(F.transform(F.split("__w", r"\n\n"), lambda p: text.trim_ws(p)), lambda p: p != "")).alias("pos", "paragraph"))
    return rows.where(~predicates.is_noise_line(F.col("paragraph"))).where(F.col("pos") < most)


def json_article(pages: DataFrame, doc: str) -> DataFrame:
    """title, authors, description and markup of pages whose JSON (``doc``) has properties and typed components."""
    d = F.col(doc)
    parts = json.components(F.get_json_object(d, "$.items"))
    markup = F.array_join(F.filter(F.transform(parts, lambda c: json.component_html(c["kind"], c["body"])), lambda x: x.isNotNull()), "\n")
    return pages.withColumns({"title": json.any_path(d, "$.properties.title", "$.properties.summaryTitle"), "authors": json.names(d, "$.properties.authors"), "description": json.any_path(d, "$.properties.description", "$.properties.summaryDescription"), "content_html": markup})


def charts_into_body(body: Column, charts: Column, note: str = "Chart not available") -> Column:
    """Placeholders ``[[chart]]`` replaced in order by the charts' markup; a missing chart leaves a note."""
    parts = F.split(body, r"\[\[chart\]\]")
    put = lambda x, i: F.when(i < F.size(parts) - 1, F.concat(x, F.coalesce(F.get(charts, i), F.lit(f"<p>{note}</p>")))).otherwise(x)
    return F.array_join(F.transform(parts, put), "")


def postprocess_pages(pages: DataFrame, own: str) -> DataFrame:
    """Stored pages with a source line after the title, lone images as figures, styled once; ``status`` tells what happened."""
    anchors = F.regexp_extract_all("html", F.lit(r'(?i)<a [^>]*href="([^"]+)"'), F.lit(1))
    canonical = F.regexp_extract("html", r'(?i)<link rel="canonical" href="([^"]+)"', 1)
    source = urls.external_source(canonical, anchors, own)
    tagged = F.contains("html", F.lit('class="source"'))
    line = F.concat(F.lit('<p class="source"><a href="'), source, F.lit('" rel="noopener">'), source, F.lit("</a></p>"))
    status = F.when(tagged, "already").when(source.isNull(), "no source").otherwise("added")
    page = F.when(status == "added", text.insert_after_h1(F.col("html"), line)).otherwise(F.col("html"))
    styled = text.once(page, "figure{", text.insert_before_head_end(page, F.lit("<style>figure{margin:1em 0}</style>")))
    return pages.withColumns({"status": status, "html": text.wrap_lone_images(styled)})


def render_whitelisted(posts: DataFrame, base: str) -> DataFrame:
    """Bodies of REST posts reduced to the whitelist, with a description of their text."""
    clean = html.whitelist_html(F.col("content_html"), F.lit(base))
    return posts.withColumn("content_html", clean).withColumn("description", text.truncate_words(text.strip_tags(F.col("content_html"))))


def listing_cards(pages: DataFrame, card: str) -> DataFrame:
    """Cards of HTML listings: url, pos and the link, title, description, date and image inside each element of a class."""
    parsed = pages.select("url", html.html_tokens(F.col("html")).alias("els"))
    is_card = lambda t: F.array_contains(F.split(F.coalesce(F.try_element_at(t["attrs"], F.lit("class")), F.lit("")), " +"), card)
    rows = parsed.select("url", "els", F.posexplode(F.filter("els", is_card)).alias("pos", "c"))
    inside = lambda *tags: html.first_inside(F.col("els"), F.col("c.path"), lambda t: t["tag"].isin(*tags))
    attr = lambda e, a: F.try_element_at(e["attrs"], F.lit(a))
    date = inside("time")
    return rows.select(
        "url", "pos", attr(inside("a"), "href").alias("link"), inside("h2", "h3", "h4")["text"].alias("title"), inside("p")["text"].alias("description"),
        F.coalesce(attr(date, "datetime"), date["text"]).alias("pub_date_raw"), attr(inside("img"), "src").alias("image"),
    )


def layout_article(boxes: DataFrame, drawings: DataFrame, width: float, height: float) -> DataFrame:
    """Elements of laid-out documents in reading order: doc, page, nth, kind (h2, h3, p) and text.

    ``boxes`` are text blocks (doc, page, rectangle, text, size, bold), ``drawings`` rectangles.
    Text inside figures and lines repeated in the margins go; kinds follow from the size
    against the document's median.
    """
    margin = (F.col("y1") <= 0.1 * height) | (F.col("y0") >= 0.9 * height)
    repeated = aggregates.boilerplate_lines(boxes.where(margin), "doc", "page", "text")
    clean = aggregates.without_boilerplate(boxes, repeated, "doc", "text")
    body = layout.body_text(clean, layout.figure_regions(drawings, height)).where(~predicates.is_junk_line(F.col("text")))
    usual = boxes.groupBy("doc").agg(F.coalesce(F.median("size"), F.lit(10.0)).alias("usual"))
    kind = F.when(F.col("size") >= 1.3 * F.col("usual"), "h2").when(F.col("bold") & (F.col("size") >= 1.1 * F.col("usual")), "h3").otherwise("p")
    ordered = layout.reading_order(body, width).join(usual, "doc")
    return ordered.select("doc", "page", "nth", kind.alias("kind"), text.join_hyphens(F.col("text")).alias("text"))
