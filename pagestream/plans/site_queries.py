"""Registered queries of the forms that sites give text: cleaners, slugs, markdown, JSON, templates, feeds, builders.

The text of a row carries its own key, so each row has a result of its own; the SQL states
that result from the key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, html, json, predicates, text, urls
from ..operators import joins, layout, quality, sequence
from ..sources import readers, sinks
from ..streaming import incremental
from . import build, extraction
from .registry import query, table


def keyed(spark, sf_dir) -> DataFrame:
    """doc_id of all documents and k, its text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("k"))


def around(before: str, after: str = "") -> Column:
    return F.concat(F.lit(before), F.col("k"), F.lit(after))


# --- strings


@query("""with d as (select doc_id, doc_id::varchar as k from documents)
select doc_id, concat('a <b> ', k, ' c') as tags_first, concat('a ', k, ' c') as references_first, concat('z ', k, ' w') as without_comments, concat('a', chr(10), k, chr(10), chr(10), 'c') as line_breaks, concat('a & ', k, ' b') as one_line,
 concat('a', chr(10), chr(10), k) as block, concat('<b>', k, '</b>') as fragment, concat('café & ', k) as escapes, concat('example ', k) as hyphens, concat('été ', k) as encoding, concat('<p>', k, '</p>') as footer, concat('<p>', k, '</p>', chr(10), '<p>b</p>') as paragraphs,
 concat('<item><encoded>', k, '</encoded></item>') as bare from d""")
def text_cleaners(spark, sf_dir):
    page = around("<p>a &lt;b&gt; ", "</p>\n<p>c</p>")
    return keyed(spark, sf_dir).select(
        "doc_id", text.html_to_text(page).alias("tags_first"), text.strip_html(page).alias("references_first"), text.strip_tags(around("<!-- x > y -->z ", "&nbsp;w")).alias("without_comments"),
        text.clean_text(around("<p>a<br>", "</p><p>c</p>")).alias("line_breaks"), text.unescaped_line(around("a &amp; ", "\n b")).alias("one_line"), text.plain_block(around("a\r\n\n\n\n")).alias("block"),
        text.fragment(around(" <b>", "</b>\r\n")).alias("fragment"), html.decode_escapes(around("caf\\u00e9 &amp;amp; ")).alias("escapes"), text.join_hyphens(around("exam-\nple ")).alias("hyphens"),
        text.repair_mojibake(around("Ã©tÃ© ")).alias("encoding"), text.drop_syndication_footer(around("<p>", "</p><p>The post <a href=x>t</a> appeared first on S.</p>")).alias("footer"),
        text.keep_paragraphs(around("<div><p>", "</p>x<p>b</p></div>")).alias("paragraphs"),
        text.strip_namespaces(around('<a:item xmlns:a="http://a" xmlns="http://b"><content:encoded>', "</content:encoded></a:item>")).alias("bare"),
    )


@query("""with d as (select doc_id, doc_id::varchar as k from documents)
select doc_id, concat('a-b-c-', k) as decoded, concat(k, '-2026-04-20') as dated, concat('s', k, '-', substr(md5(k), 1, 10)) as hashed, substr(md5(concat(k, '||x')), 1, 12) as parts, concat('US Growth And AI ', k) as title,
 case when doc_id % 2 = 0 then concat(substr(repeat('word ', 120), 1, 599), '...') else repeat('word ', 110) end as words600, concat(repeat('x', 320), '...') as hard320, concat(repeat('y', 500), '...') as hard500 from d""")
def slug_forms(spark, sf_dir):
    long = F.when(F.col("doc_id") % 2 == 0, F.repeat(F.lit("word "), F.lit(200))).otherwise(F.repeat(F.lit("word "), F.lit(110)))
    return keyed(spark, sf_dir).select(
        "doc_id", text.slugify_decoded(around("a%20b&amp;c-", ".pdf"), True).alias("decoded"), text.slug_with_date(F.col("k"), F.lit("2026-04-20").cast("timestamp")).alias("dated"),
        text.slug_with_hash(around("s"), F.col("k")).alias("hashed"), text.short_hash(F.col("k"), F.lit(None).cast("string"), F.lit("x")).alias("parts"), text.title_from_slug(around("us-growth-and-ai-")).alias("title"),
        text.truncate_words(long, 600, "...").alias("words600"), text.truncate_hard(F.concat(F.repeat(F.lit("x"), F.lit(320)), F.col("k")), 320).alias("hard320"), text.truncate_hard(F.concat(F.repeat(F.lit("y"), F.lit(500)), F.col("k"))).alias("hard500"),
    )


@query("""with d as (select doc_id, doc_id::varchar as k from documents)
select doc_id, concat('x b c ', k) as plain, concat('<strong>b</strong> <a href="http://d">c</a> <em>e</em> <code>', k, '</code>') as inline, concat('<h2>T ', k, '</h2>', chr(10), '<p>text</p>', chr(10), '<ul><li>a</li>', chr(10), '<li>', k, '</li></ul>') as blocks,
 concat('Body of ', k, '.') as article, concat('Title ', k) as card, 'The market moved.' as about, 'May 4, 2025' as dated, concat('https://x/', k) as link from d""")
def markdown_forms(spark, sf_dir):
    article = F.concat(
        F.lit("Title: T\nURL Source: http://x\nMarkdown Content:\n# Title "), F.col("k"), F.lit(" - Citadel Securities\nMay 4, 2025\nShare on\n*   [](https://www.linkedin.com/share)\n\nBody of "), F.col("k"), F.lit(".\n## Explore\nmore\n\nThis website uses cookies. Yes.")
    )
    listing = F.concat(F.lit("* [![i](http://i) Research ### Title "), F.col("k"), F.lit(" The market moved. May 4, 2025 Learn more](https://x/"), F.col("k"), F.lit(")\n* [Research ### M&A Reports The rest. May 4, 2025](https://x/s)\n* [Research ### Undated The rest](https://x/u)"))
    cards = extraction.report_cards(keyed(spark, sf_dir).select(F.col("k").alias("url"), listing.alias("page")), "page")
    docs = keyed(spark, sf_dir).select(
        "doc_id", "k", text.strip_markdown_links(around("![x](u) **b** [c ", "](d)")).alias("plain"), text.inline_markdown(around("**b** [c](http://d) *e* `", "`")).alias("inline"),
        text.block_markdown(F.concat(around("# T ", "\n\ntext\n\n- a\n- "), F.col("k"))).alias("blocks"), text.clean_article_markdown(article, F.lit("T")).alias("article"),
    )
    return docs.join(cards.select(F.col("url").alias("k"), F.col("title").alias("card"), F.col("description").alias("about"), F.col("date_text").alias("dated"), "link"), "k").drop("k")


@query("""with d as (select doc_id, doc_id::varchar as k from documents)
select doc_id, concat('{"id": ', k, '}') as script, concat('v', k) as property, concat('{"a": "', k, '"}') as attribute, case doc_id % 3 when 0 then concat('N', k) when 1 then concat('N', k, ', M') else '' end as names,
 concat('<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>', k, '</td></tr></tbody></table>') as tbl, concat('<h2>', k, '</h2>', chr(10), '<ul><li>a &amp; b</li></ul>') as elements,
 concat('<p>', k, '</p>', chr(10), '<blockquote>q</blockquote>', chr(10), '<figure><img src="u" alt="x"><figcaption>c</figcaption></figure>', chr(10), '<p>l1</p><p>l2</p>') as article, concat('T', k) as title, concat('a<svg/>', k, '<p>Chart not available</p>c') as charts, concat('{"id": ', k, '}|{"b": {}}') as objects from d""")
def json_forms(spark, sf_dir):
    k, three = F.col("k"), F.col("doc_id") % 3
    people = F.when(three == 0, around('{"p": {"name": "N', '"}}')).when(three == 1, around('{"p": [{"name": "N', '"}, "M"]}')).otherwise(F.lit("{}"))
    doc = F.concat(
        F.lit('{"properties": {"summaryTitle": "T'), k, F.lit('"}, "items": {"b": {"type": "text", "text": "'), k,
        F.lit('"}, "a": {"type": "quote", "text": "q"}, "u": {"type": "other"}, "i": {"type": "image", "images": [{"url": "u", "alt": "x", "caption": "c"}]}, "l": {"type": "paragraphlist", "paragraphList": ["{\\"text\\": \\"l1\\"}", "l2"]}}}'),
    )
    none = F.lit(None).cast("string")
    element = lambda kind, words, items: F.struct(F.lit(kind).alias("kind"), words.alias("text"), items.alias("items"), none.alias("src"), none.alias("caption"))
    empty = F.array().cast("array<string>")
    found = extraction.json_article(keyed(spark, sf_dir).withColumn("doc", doc), "doc")
    return found.select(
        "doc_id", json.embedded_script(around('<script type="application/json" id="__DATA__">{"id": ', "}</script>"), "__DATA__").alias("script"), json.property_in_text(around('x "key" : "v', '" y'), "key").alias("property"),
        json.json_attribute(around('<div data-x="{&quot;a&quot;: &quot;', '&quot;}">'), "data-x").alias("attribute"), json.names(people, "$.p").alias("names"),
        json.rows_html(F.array(F.array(F.lit("h")), F.array(F.lit("")), F.array(k))).alias("tbl"), json.elements_html(F.array(element("h2", k, empty), element("ul", none, F.array(F.lit("a & b"))))).alias("elements"),
        F.col("content_html").alias("article"), "title", extraction.charts_into_body(around("a[[chart]]", "[[chart]]c"), F.array(F.lit("<svg/>"))).alias("charts"),
        F.array_join(html.json_objects(around('{ stray x = {"id": ', '}; y({"b": {}})')), "|").alias("objects"),
    )


@query("""with d as (select doc_id, doc_id::varchar as k from documents), i as (select doc_id, k, unnest([0, 1]) as pos from d)
select doc_id, pos, concat('T', k, '-', pos) as title, concat('http://x/', k, '/', pos) as link, case pos when 0 then ' one ' else ' two' end as body from i""")
def template_extract(spark, sf_dir):
    item = lambda n, tail: F.concat(F.lit("<b>T"), F.col("k"), F.lit(f"-{n}</b> <i>{n}</i> <u>http://x/"), F.col("k"), F.lit(f"/{n}</u> {tail}"))
    rows = keyed(spark, sf_dir).withColumn("page", F.concat(F.lit("head "), item(0, "one "), item(1, "two")))
    spans = sequence.match_spans(rows, F.col("page"), text.template_regex("<b>{%}</b>{*}<u>{%}</u>"), 2)
    cut = sequence.lead_span(spans, F.col("page"), ["doc_id"])
    return cut.select("doc_id", "pos", text.fill_template("{0}", F.col("groups"), F.lit("")).alias("title"), text.fill_template("{9}", F.col("groups"), F.get("groups", F.lit(1))).alias("link"), "body")


# --- predicates

NAVIGATION_SQL = ", ".join("'" + p.replace("'", "''") + "'" for p in predicates.NAVIGATION)


@query(f"""with t as (select doc_id, lower(concat(text, case doc_id % 4 when 0 then ' Leadership. Social impact. No warranty.' when 1 then ' SEC filings.' else '' end)) as t from documents),
h as (select doc_id, length(t) as n, length(list_filter([{NAVIGATION_SQL}], lambda p: contains(t, p))) as hits from t) select doc_id, (hits >= 3 and n > 200) or (hits >= 2 and n > 100) as navigation from h""")
def navigation_filter(spark, sf_dir):
    more = F.when(F.col("doc_id") % 4 == 0, " Leadership. Social impact. No warranty.").when(F.col("doc_id") % 4 == 1, " SEC filings.").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", predicates.is_navigation(F.concat("text", more)).alias("navigation"))


# (paragraph, whether it is junk, whether a line of it becomes a paragraph of the article: a line that begins with a page number does not)
PARAGRAPHS = (
    ("A sentence of the article that says a good deal about rates.", False, True),
    ("Too short a text.", True, False),
    ("Sources of growth are many, and this sentence names some of them.", False, True),
    ("Source: a bank and its own calculations of the year", True, False),
    ("See https://example.org for all of the tables of this note.", True, False),
    ("Jane Doe, Senior Economist and Research Analyst", True, False),
    ("3 May 2025 Notes of the week on rates", True, False),
    ("Figure 3: rates of the countries over some years", True, False),
    ("The dark blue line is the third level of the style", True, False),
    ("The title of the note, again and by itself", True, False),
    ("What the title of the note leaves open is how the rates of the coming years will move, which the rest of this paragraph discusses at some length and in detail.", False, True),
    ("Anna Bell, Carl Dorn, Emma Frost, Gary Hill, Ida Jones", True, False),
    ("deutsche bank research of the year page 12", True, False),
    ("12 Review of the markets of the year", True, False),
    ("Page 12 of the report tells how the rates moved in the year.", False, False),
)


@query("with d as (select doc_id, ([" + ", ".join(str(junk).lower() for _, junk, _ in PARAGRAPHS) + f"])[doc_id % {len(PARAGRAPHS)} + 1] as junk, ([" + ", ".join(str(kept).lower() for _, _, kept in PARAGRAPHS) + f"])[doc_id % {len(PARAGRAPHS)} + 1] as kept from documents) select doc_id, junk, kept, doc_id % 3 <> 1 as shell, doc_id % 3 = 2 as pdf, doc_id % 2 = 0 as undated from d")
def paragraph_rules(spark, sf_dir):
    rows = keyed(spark, sf_dir).withColumn("p", F.get(F.array(*[F.lit(p) for p, _, _ in PARAGRAPHS]), F.col("doc_id") % len(PARAGRAPHS)))
    junk = predicates.is_junk_paragraph(F.col("p"), F.lit("The title of the note"), F.lit("x"))
    lines = rows.select("doc_id", F.lit(0).alias("n"), F.col("p").alias("line"), F.lit("The title of the note").alias("title"))
    kept = extraction.article_paragraphs(lines, ["doc_id"], "n", "line", "title").select("doc_id", F.lit(True).alias("kept"))
    three = F.col("doc_id") % 3
    shell = predicates.is_shell(F.when(three == 0, "x\nDon't show this message anymore").when(three == 1, "## [a](b)\n## [c](d)\ntext").otherwise("## [a](b)\n## [c](d)\n## [e](f)"))
    pdf = predicates.is_valid_binary(F.when(three == 2, F.lit(b"%PDF-1.7 of many bytes")).otherwise(F.lit(b"<html> of many bytes")), b"%PDF", 10)
    undated = dates.not_a_plain_day(F.when(F.col("doc_id") % 2 == 0, "Mon, 20 Apr 2026 02:48:55 GMT").otherwise("2026-04-20"))
    flags = rows.select("doc_id", junk.alias("junk"), shell.alias("shell"), pdf.alias("pdf"), undated.alias("undated"))
    return flags.join(kept, "doc_id", "left").select("doc_id", "junk", F.coalesce("kept", F.lit(False)).alias("kept"), "shell", "pdf", "undated")


@query("""with d as (select doc_id, doc_id::varchar as k, doc_id % 8 as m from documents), r as (select unnest([{'m': 1, 'rule': 'title'}, {'m': 2, 'rule': 'link'}, {'m': 3, 'rule': 'no_body'}, {'m': 4, 'rule': 'description'}, {'m': 5, 'rule': 'page'}, {'m': 5, 'rule': 'length'}, {'m': 5, 'rule': 'markers'}, {'m': 5, 'rule': 'heading'},
 {'m': 5, 'rule': 'paragraphs'}, {'m': 6, 'rule': 'source'}, {'m': 7, 'rule': 'footer'}, {'m': 0, 'rule': 'localized'}]) as r) select k as key, r.rule as rule from d join r on d.m = r.m""")
def quality_gate(spark, sf_dir):
    m = F.col("doc_id") % 8
    words = F.concat(F.lit("<h1>T</h1><p>Our bottom line.</p><p>Week ahead.</p><p>"), F.repeat(F.lit("word "), F.lit(180)), F.lit("</p>"))
    rows = keyed(spark, sf_dir).select(
        "k", F.when(m == 1, " ").otherwise("T").alias("title"), F.when(m == 2, "https://other.example/a").otherwise("https://own.example/item/f/a/").alias("link"), F.when(m == 3, "<p>x</p>").alias("content_html"),
        F.concat(F.repeat(F.lit("d"), F.when(m == 4, 79).otherwise(80)), F.when(m == 7, " The post appeared first on S.").otherwise("")).alias("description"), F.when(m == 5, "short").otherwise(words).alias("page"),
        F.when(m == 6, "https://other.example/").when(m == 7, "").otherwise("https://own.example/x").alias("source_url"), F.when(m == 0, "/item/g/a/").otherwise("/item/f/a/").alias("path"),
    )
    rules = quality.item_rules(domain="https://own.example/") | quality.page_rules(text.plain_page_text(F.col("page")), ("our bottom line", "market backdrop", "week ahead")) | quality.structure_rules(F.col("page"))
    return quality.violations(rows, F.col("k"), rules | {"localized": urls.is_localized(F.col("path"), "https://own.example", F.lit("f"))})


# --- pages, layouts


@query("""select page_id, len(regexp_extract_all(html, '(?i)<h1[ >]')) as h1, len(regexp_extract_all(html, '(?i)<article[ >]')) as article, len(regexp_extract_all(html, '(?i)<footer[ >]')) as footer, len(regexp_extract_all(html, '(?i)<nav[ >]')) as nav from pages""")
def html_tag_counts(spark, sf_dir):
    elements = table(spark, sf_dir, "pages").select("page_id", html.html_tokens(F.col("html")).alias("e"))
    count = lambda tag: F.size(F.filter("e", lambda t: t["tag"] == tag)).cast("bigint").alias(tag)
    return elements.select("page_id", count("h1"), count("article"), count("footer"), count("nav"))


@query("""select page_id, concat('<h2>T', page_id, '</h2><p>a <a href="https://x.example/d/', page_id, '">l</a> <strong>b</strong></p><ul><li>c</li></ul><h4>e &amp; f</h4><img src="https://x.example/i.png" alt="">') as clean, concat('https://x.example/d/', page_id) as absolute, concat('https://x.example/', page_id, '.png') as rooted from pages""")
def whitelist_forms(spark, sf_dir):
    raw = F.concat(F.lit('<header>h</header><h1 class="x">T'), F.col("k"), F.lit('</h1><script>var x;</script><div><p style="y">a <a href="/d/'), F.col("k"), F.lit('">l</a> <strong>b</strong></p><p> </p></div><ul><li>c</li></ul><h6>e &amp; f</h6><a href="#top"></a><img src="data:x" srcset="i.png 1x, j.png 2x"><form>f</form>'))
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("k"))
    rooted = F.regexp_extract(urls.root_relative_to(around('<img alt="" src="/', '.png">'), "https://x.example"), 'src="([^"]+)"', 1)
    return pages.select("page_id", html.whitelist_html(raw, F.lit("https://x.example/")).alias("clean"), html.absolute_url(F.lit("https://x.example/a/"), around("../d/")).alias("absolute"), rooted.alias("rooted"))


@query("""select page_id::varchar as url, concat('<p>One ', page_id, '</p><p><strong>H</strong></p><p>Two &amp; three</p><p><strong>H</strong></p><p><img src="https://x.example/i', page_id, '.png" alt="" /></p>') as content_html from pages""")
def tabbed_layout(spark, sf_dir):
    k = F.col("page_id").cast("string")
    row = lambda block, words, kind, pos, tag, body, src=F.lit(None).cast("string"): F.struct(*[c.alias(n) for c, n in ((F.lit(block), "block"), (F.lit(words), "block_text"), (F.lit(kind), "component"), (F.lit(5), "tabs"), (F.lit(pos), "pos"), (F.lit(tag), "tag"), (body, "text"), (src, "src"))])
    rows = F.array(
        row(1, "b", "paragraph", 0, "p", F.concat(F.lit(" One  "), k)), row(1, "b", "paragraph", 1, "h2", F.lit("H")), row(2, "b", "paragraph", 0, "p", F.lit("Two & three")), row(2, "b", "paragraph", 1, "p", F.lit("two &  THREE")),
        row(2, "b", "paragraph", 2, "p", F.lit("Source: us")), row(3, "b", "other", 0, "p", F.lit("Not this")), row(4, "b", "paragraph", 0, "h2", F.lit("H")), row(5, "b", "image", 0, "img", F.lit(None).cast("string"), F.concat(F.lit("/i"), k, F.lit(".png"))),
        row(6, "Our big calls", "paragraph", 0, "p", F.lit("Stopped")), row(7, "b", "paragraph", 0, "p", F.lit("After the stop")),
    )
    return extraction.tabbed_article(table(spark, sf_dir, "pages").select(k.alias("url"), F.inline(rows)), ["url"], "https://x.example")


@query("""with b as (select page_id, unnest([0, 1, 3]) as n from pages) select page_id::varchar as doc, concat('Text ', n) as text, n from b""")
def layout_figures(spark, sf_dir):
    box = lambda n, y, body: F.struct(F.lit(n).alias("n"), F.lit(10.0).alias("x0"), F.lit(float(y)).alias("y0"), F.lit(60.0).alias("x1"), F.lit(y + 4.0).alias("y1"), F.lit(body).alias("text"))
    rect = lambda y: F.struct(F.lit(5.0).alias("x0"), F.lit(float(y)).alias("y0"), F.lit(95.0).alias("x1"), F.lit(y + 10.0).alias("y1"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("doc"), F.lit(0).alias("page"))
    boxes = pages.select("doc", "page", F.inline(F.array(box(0, 5, "Text 0"), box(1, 15, "Text 1"), box(2, 32, "Label of the first figure"), box(3, 50, "Text 3"), box(4, 73, "Label of the second figure"))))
    drawings = pages.select("doc", "page", F.inline(F.array(rect(30), rect(70))))
    return layout.body_text(boxes, layout.figure_regions(drawings, 100.0)).select("doc", "text", "n")


@query("""select page_id, case page_id % 3 when 0 then 'first' when 1 then 'second' else 'none' end as source, page_id % 3 = 2 as missing, case page_id % 3 when 0 then 'a' when 1 then 'b' end as alias from pages""")
def source_fallback(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("k"))
    at = F.col("page_id") % 3
    offered = lambda name, last: pages.select("page_id", F.explode(F.when(at <= last, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))).alias("source"))
    chosen = readers.first_source(offered("first", 0), offered("second", 1), offered("none", 2), by=["page_id"])
    cache = pages.select(readers.cache_key(F.when(at == 2, F.lit("-")).otherwise(around("https://x/"))).alias("key")).distinct()
    gone = readers.not_cached(pages.select("page_id", around("https://x/").alias("url")), cache).select("page_id", F.lit(True).alias("missing"))
    stored = pages.select(F.concat(F.when(at == 0, "a/").when(at == 1, "b/").otherwise("c/"), "k").alias("slug"), F.when(at == 0, "a").when(at == 1, "b").otherwise("c").alias("alias"))
    named = readers.with_aliases(pages, stored, [F.concat(F.lit("a/"), "k"), F.concat(F.lit("b/"), "k")], "slug", "alias")
    return chosen.join(gone, "page_id", "left").join(named.select("page_id", "alias"), "page_id").select("page_id", "source", F.coalesce("missing", F.lit(False)).alias("missing"), "alias")


# --- feeds, item pages, builders


@query("""select page_id::varchar as guid, concat('T & <', page_id, '>') as title, concat('https://own.example/item/f/', page_id, '/') as link, page_id % 2 = 0 as is_permalink, strftime(date '2025-01-01' + (page_id % 300)::int, '%Y-%m-%d') as day, concat('d "', page_id, '"') as description, concat('<p>', page_id, '</p>') as content_html,
 page_id::varchar as slug, false as is_broken from pages""")
def feed_round_trip(spark, sf_dir):
    k = F.col("page_id").cast("string")
    items = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("f"), F.col("page_id") % 4).alias("feed"), F.col("page_id").alias("pos"), F.concat(F.lit("T & <"), k, F.lit(">")).alias("title"), urls.item_page_url("https://own.example", F.lit("f"), k).alias("link"), k.alias("guid"),
        (F.col("page_id") % 2 == 0).alias("is_permalink"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).cast("timestamp").alias("pub_ts"), F.lit(None).cast("string").alias("author"),
        F.concat(F.lit('d "'), k, F.lit('"')).alias("description"), F.concat(F.lit("<p>"), k, F.lit("</p>")).alias("content_html"),
    )
    channels = items.select("feed").distinct().select("feed", F.lit("F").alias("title"), F.lit("https://own.example").alias("link"), F.lit("").alias("description"), F.lit("en").alias("language"), F.lit("2026-05-01").cast("timestamp").alias("last_build"))
    at = incremental.shared_path(spark, "feeds")
    sinks.write_feeds(items, channels, at)
    return readers.read_previous(spark, f"{at}/*/*.txt").select("guid", "title", "link", "is_permalink", F.date_format("pub_ts", "yyyy-MM-dd").alias("day"), "description", "content_html", "slug", "is_broken")


@query("""select page_id::varchar as slug, concat('T ', page_id) as title, concat('https://x.example/', page_id) as source, 0 as version, 3 as built, 'already' as status, true as figure from pages""")
def page_sinks(spark, sf_dir):
    k = F.col("page_id").cast("string")
    items = table(spark, sf_dir, "pages").select(F.concat(F.lit("f"), F.col("page_id") % 16).alias("feed"), k.alias("slug"), F.concat(F.lit("T "), k).alias("title"), F.lit("about").alias("description"), F.concat(F.lit("https://x.example/"), k).alias("source_url"))
    pages = sinks.pages_of_json(sinks.keyed_json(items))
    page = F.col("html")
    source = urls.external_source(F.regexp_extract(page, 'rel="canonical" href="([^"]+)"', 1), urls.links(page), "own.example")
    built = sinks.item_page(F.lit("x"), F.lit('<p><img src="i.png"></p>'), F.lit(""), 3)
    done = extraction.postprocess_pages(pages.withColumn("html", F.concat(page, F.lit('<p><img src="i.png"></p>'))), "own.example").select("feed", "slug", "status", F.contains("html", F.lit('<figure><img src="i.png" alt=""></figure>')).alias("figure"))
    read = pages.select("feed", "slug", F.regexp_extract(page, "<h1>(.*?)</h1>", 1).alias("title"), source.alias("source"), predicates.render_version(page).alias("version"), predicates.render_version(built).alias("built"))
    return read.join(done, ["feed", "slug"]).drop("feed")


@query("""with l as (select page_id as id, page_id % 4 as f, row_number() over (partition by page_id % 4 order by page_id % 300 desc, page_id) as r from pages), s as (select page_id * 3 as id from pages),
a as (select l.id, l.f, l.r, s.id is not null as known, case when s.id is null then 'new' when l.id % 9 = 0 then 'stale' when l.id % 2 = 1 then 'changed' else 'kept' end as action from l left join s using (id) where l.r <= 20),
b as (select *, action <> 'kept' and row_number() over (partition by f, action <> 'kept' order by r) > 5 as deferred from a)
select concat('f', f, '/', id) as key, action, deferred, action <> 'kept' and not deferred as rebuilt, strftime(case when known then date '2024-01-01' else date '2025-01-01' + (id % 300)::int end, '%Y-%m-%d') as day from b where known or not deferred""")
def builder_run(spark, sf_dir):
    version, page = 2, F.col("page_id").cast("string")
    pages = table(spark, sf_dir, "pages")
    feed_of = lambda i: F.concat(F.lit("f"), i % 4)
    title, about = F.concat(F.lit("Page "), page), F.lit("about")
    link = F.concat(F.lit("https://x.example/p/"), page)
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    listing = pages.select(feed_of(F.col("page_id")).alias("feed"), F.col("page_id").alias("pos"), title.alias("title"), link.alias("link"), about.alias("description"), F.date_format(day, "yyyy-MM-dd").alias("pub_date_raw"))
    details = pages.select(link.alias("link"), F.col("html").alias("content_html"))
    i = F.col("page_id") * 3
    slug, name = i.cast("string"), F.concat(F.lit("Page "), i)
    stored = pages.select(
        F.concat(feed_of(i), F.lit("/"), slug).alias("key"), feed_of(i).alias("feed"), slug.alias("slug"), name.alias("title"), F.concat(F.lit("https://x.example/p/"), slug).alias("link"), about.alias("description"),
        F.lit("Mon, 01 Jan 2024 00:00:00 GMT").alias("pub_date_raw"), F.when(i % 2 == 1, "other").otherwise(text.short_hash(name, about)).alias("print"), F.when(i % 9 == 0, 1).otherwise(version).alias("version"), F.lit("stored").alias("html"),
    )
    out = build.planned(listing, details, stored, F.lit("2026-05-01").cast("timestamp"), version, later=20)
    return out.select("key", "action", "deferred", F.contains("html", F.concat(F.lit("<h1>"), "title", F.lit("</h1>"))).alias("rebuilt"), F.date_format(dates.parse_rfc822(F.col("pub_date_raw")), "yyyy-MM-dd").alias("day"))


# --- listings, guards and lookups


@query("""with p as (select page_id::varchar as k from pages) select concat('u', k) as url, 0 as pos, concat('Page ', k) as title, concat('https://x.example/p/', k) as link from p
union all select concat('u', k), 1, concat('Some Page ', k), concat('https://x.example/p/some-page-', k) from p""")
def markdown_listing_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("k"))
    listing = F.concat(F.lit("* [Page "), "k", F.lit("](https://x.example/p/"), "k", F.lit(") and [](https://x.example/p/some-page-"), "k", F.lit(")\n* [Again](https://x.example/p/"), "k", F.lit(") [not a link](/p)"))
    return extraction.markdown_links(pages.select(F.concat(F.lit("u"), "k").alias("url"), listing.alias("markdown")), "markdown").select("url", "pos", "title", "link")


@query("""select page_id, length(trim(repeat(' words', (page_id % 20)::int))) < 50 as empty_shell, concat('part', page_id % 6) in ('part1', 'part4') as excluded from pages""")
def page_guards(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    title = F.concat(F.lit("Title "), F.col("page_id").cast("string"))
    body = F.concat(title, F.expr("repeat(' words', cast(page_id % 20 as int))"))
    slug = urls.last_segment(F.concat(F.lit("https://x.example/a/part"), (F.col("page_id") % 6).cast("string")))
    return pages.select("page_id", predicates.is_empty_shell(body, title).alias("empty_shell"), predicates.excluded_slug(slug, ["part1", "part4"]).alias("excluded"))


@query("""select o_orderkey, o_custkey, c_name as old_c_name, c_nationkey as old_c_nationkey from orders left join customer on o_custkey = c_custkey * 2""")
def lookup_by_key(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    stored = customer.withColumn("o_custkey", F.col("c_custkey") * 2)
    return joins.lookup(orders.select("o_orderkey", "o_custkey"), stored, "o_custkey", ["c_name", "c_nationkey"])


@query("""with o as (select o_custkey as doc, o_orderkey % 3 as page, case when o_orderkey % 2 = 0 then 'left' else 'right' end as col, o_orderkey::double as y0, o_orderstatus from orders)
select c.doc, c.page, c.col, c.y0, coalesce(min(case when b.y0 > c.y0 then b.y0 end), 1e9) as until from o c left join o b on c.doc = b.doc and c.page = b.page and c.col = b.col and b.o_orderstatus = 'F' group by all""")
def caption_regions(spark, sf_dir):
    key = F.col("o_orderkey")
    # a box on the left, or on the right, of a page of width 100
    boxes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc"), (key % 3).alias("page"), key.cast("double").alias("y0"), "o_orderstatus",
        F.when(key % 2 == 0, 10.0).otherwise(60.0).alias("x0"), F.when(key % 2 == 0, 40.0).otherwise(90.0).alias("x1"),
    )
    boxes = boxes.withColumn("col", layout.column_of(F.lit(100.0)))
    bounds = boxes.where("o_orderstatus = 'F'").select("doc", "page", "col", "y0")
    return layout.caption_regions(boxes.select("doc", "page", "col", "y0"), bounds, 1e9)
