"""Functions on the literal rows that no table supplies."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagestream.functions import dates, html, json, predicates, text, urls

NOW = dt.datetime


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (text.html_to_text, "a &lt;b&gt; c", "a <b> c"),
        (text.strip_html, "a &lt;b&gt; c", "a c"),
        (text.html_to_text, "<p>a</p><p>b</p>", "a b"),
        (text.clean_text, "<p>a<br>b</p><p>c</p>", "a\nb\n\nc"),
        (text.strip_tags, "<!-- x > y -->z", "z"),
        (text.normalize_space, "a b\r\n c", "a b c"),
        (text.plain_block, "a\r\n\n\n\nb ", "a\n\nb"),
        (text.strip_html, None, ""),
        (text.slugify, "  Hello, World! ", "hello-world"),
        (text.slugify, "日本", "item"),
        (text.slugify_decoded, "a%20b&amp;c+d", "a-b-c-d"),
        (text.title_from_slug, "us-growth-and-ai", "US Growth And AI"),
        (text.strip_markdown_links, "![x](u) **b** [c](d)", "x b c"),
        (text.join_hyphens, "exam-\nple so­ft", "example soft"),
        (text.repair_mojibake, "Ã©tÃ©", "été"),
        (text.repair_mojibake, "déjà", "déjà"),
        (text.repair_mojibake, "日本", "日本"),
        (text.srcset_first, "a.jpg 1x, b.jpg 2x", "a.jpg"),
        (text.keep_paragraphs, "<div><p>a</p>x<p class=y>b</p></div>", "<p>a</p>\n<p class=y>b</p>"),
        (text.drop_syndication_footer, "<p>a</p><p>The post <a href=x>t</a> appeared first on S.</p>", "<p>a</p>"),
        (text.escape_html, "a<b & \"c\"'", "a&lt;b &amp; &quot;c&quot;&#x27;"),
        (urls.canonical_url, "https://a.b/c/?x=1#y", "https://a.b/c"),
        (urls.url_host, "https://A.b:80/c", "a.b:80"),
        (urls.last_segment, "https://a.b/c/d/?x", "d"),
        (urls.is_pdf_url, "https://a.b/c.PDF?x=1", True),
        (html.html_unescape, "&eacute;&#39;", "é'"),
        (html.balanced_json, 'x({"a": "}", "b": {"c": "\\""}}) {', '{"a": "}", "b": {"c": "\\""}}'),
        (html.balanced_json, '{"a": 1', None),
        (html.decode_escapes, "a&amp;lt;b\\u0041", "a<bA"),
        (predicates.looks_blocked, "Just a moment...", True),
        (predicates.looks_blocked, "", True),
        (predicates.looks_blocked, "x" * 600 + "Cloudflare", False),
        (predicates.is_junk_line, "page 3", True),
        (predicates.is_junk_line, "12|34|56", True),
        (predicates.is_junk_line, "A sentence of text.", False),
        (predicates.needs_rebuild, '<img src="/a.png">', True),
        (predicates.render_version, '<meta name="item-render-version" content="7">', 7),
        (predicates.render_version, "<p>", 0),
    ],
)
def test_value(spark, f, value, expected):
    row = spark.createDataFrame([(value,)], "v string")
    assert row.select(f(F.col("v")).alias("x")).first()["x"] == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("March 5, 2026", NOW(2026, 3, 5)), ("march 5, 2026", NOW(2026, 3, 5)), ("Mar. 2026", NOW(2026, 3, 1)), ("Mar. 5, 2026", NOW(2026, 3, 5)),
        ("garbage", None), ("", None),
    ],
)
def test_listing_dates(spark, raw, expected):
    assert one(spark, dates.parse_first(F.col("v")), v=raw) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2026-04-20", NOW(2026, 4, 20)), ("2026-04-20T02:48:55Z", NOW(2026, 4, 20, 2, 48, 55)), ("Mon, 20 Apr 2026 02:48:55 GMT", NOW(2026, 4, 20, 2, 48, 55)),
        ("Mon, 20 Apr 2026 02:48:55 -0000", NOW(2026, 4, 20, 2, 48, 55)), ("20 Apr 2026 04:48:55 +0200", NOW(2026, 4, 20, 2, 48, 55)), ("x", None),
    ],
)
def test_feed_dates(spark, raw, expected):
    got = spark.range(1).select(F.date_format(dates.parse_any(F.lit(raw)), "yyyy-MM-dd HH:mm:ss").alias("x")).first()["x"]
    assert got == (expected.strftime("%Y-%m-%d %H:%M:%S") if expected else None)


def test_archive_and_compact_dates(spark):
    row = spark.range(1).select(dates.parse_first(F.lit("03-Apr-26"), dates.ARCHIVE_FORMATS).alias("a"), dates.compact_date(F.lit("video_20260403_x")).alias("b"), dates.date_in_text(F.lit("Posted on March 5, 2026 by"), "Posted on").alias("c"))
    assert row.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in "abc"]).first() == ("2026-04-03", "2026-04-03", "2026-03-05")


def test_template(spark):
    import re

    assert re.compile(text.template_regex("a{%}b").replace("(?ism)", "(?ism)")).search("axb")[1] == "x"
    assert re.compile(text.template_regex("a{%}b{*}c")).search("a1b22c")[1] == "1"
    assert text.template_regex("^x$") == "(?ism)^x$"
    groups = F.array(F.lit("t"), F.lit("u"))
    assert one(spark, text.fill_template("{0} - {1}", groups, F.lit("f"))) == "t - u"
    assert one(spark, text.fill_template("{5}", groups, F.lit("f"))) == "f"


@pytest.mark.parametrize(
    ("link", "title", "slug"),
    [("https://a.b/news/My-Post/", "T", "my-post"), ("https://a.b/file.html", "A title", "a-title"), ("https://a.b/", "T x", "t-x"), ("", "T x", "t-x")],
)
def test_slug_of(spark, link, title, slug):
    assert one(spark, text.slug_of(F.col("a"), F.col("b")), a=link, b=title) == slug


def test_slug_of_nothing_is_a_hash(spark):
    assert len(one(spark, text.slug_of(F.col("a"), F.col("b")), a="https://a.b/", b="日本")) == 12


def test_truncation_keeps_short_texts(spark):
    assert one(spark, text.truncate_words(F.col("v"), 10), v="short") == "short"
    assert one(spark, text.truncate_words(F.col("v"), 10), v="some words, here") == "some…"


def test_markdown(spark):
    got = one(spark, text.block_markdown(F.col("v")), v="# Head\n\nA **b** [c](http://d)\n\n- one\n- two\n\nend")
    assert "<h2>Head</h2>" in got
    assert '<p>A <strong>b</strong> <a href="http://d">c</a></p>' in got
    assert "<ul><li>one</li>" in got
    assert "<li>two</li></ul>" in got


def test_whitelist():
    got = html.whitelisted('<h1>T</h1><h6>s</h6><script>x</script><custom>u</custom><p> </p><p><a href="/x">l</a><a href="#t">t</a></p><img src="data:x" srcset="/i.png 1x">', "https://a.b/c")
    assert got == '<h2>T</h2><h4>s</h4>u<p><a href="https://a.b/x">l</a>t</p><img src="https://a.b/i.png" alt="">'


def test_tokens():
    rows = html.tokens('<div id="a"><p>x<b>y</b></p></div>')
    assert [(r["tag"], r["depth"], r["path"], r["text"]) for r in rows] == [("div", 0, "/0", ""), ("p", 1, "/0/1", "x"), ("b", 2, "/0/1/2", "y")]


def test_polymorphic_json(spark):
    for doc, expected in (('{"a": {"name": "X"}}', "X"), ('{"a": [{"name": "X"}, "Y"]}', "X, Y"), ('{"a": "Z"}', "Z"), ("{}", "")):
        assert one(spark, json.names(F.col("d"), "$.a"), d=doc) == expected
    parts = one(spark, json.components(F.col("d")), d='{"z": {"type": "text", "text": "t"}, "a": {"type": "quote"}}')
    assert [(p["pos"], p["key"], p["kind"]) for p in parts] == [(0, "z", "text"), (1, "a", "quote")]


def test_tables(spark):
    rows = F.array(F.array(F.lit("h1"), F.lit("h2")), F.array(F.lit("1"), F.lit("<2>")), F.array(F.lit(""), F.lit("")))
    assert one(spark, json.rows_html(rows)) == "<table><thead><tr><th>h1</th><th>h2</th></tr></thead><tbody><tr><td>1</td><td>&lt;2&gt;</td></tr></tbody></table>"
    assert one(spark, predicates.is_real_table(rows)) is True
    assert one(spark, predicates.is_real_table(F.array(F.array(F.lit("a"))))) is False


def test_page_edits(spark):
    page = "<html><head></head><body><h1>T</h1><p><img src=a></p><h1>U</h1></body></html>"
    assert one(spark, text.insert_after_h1(F.col("p"), F.lit("!")), p=page).count("!") == 1
    assert one(spark, text.insert_before_head_end(F.col("p"), F.lit("<s>")), p=page).startswith("<html><head><s></head>")
    assert "<figure><img src=a" in one(spark, text.wrap_lone_images(F.col("p")), p=page)
    assert one(spark, text.once(F.col("p"), "<h1>", F.lit("new")), p=page) == page


def test_links(spark):
    anchors = F.array(F.lit("/x"), F.lit("https://own/a"), F.lit("https://other/b"))
    assert one(spark, urls.external_source(F.lit("https://own/i"), anchors, "own")) == "https://other/b"
    assert one(spark, urls.external_source(F.lit("https://c/i"), anchors, "own")) == "https://c/i"
    assert one(spark, urls.is_localized(F.lit("https://b/item/f/s/"), "https://b", F.lit("f"))) is True
    assert one(spark, urls.is_localized(F.lit("https://x/item/f/s/"), "https://b", F.lit("f"))) is False
    assert one(spark, urls.asset_refs(F.lit('<img src="a.png"><a href="https://x"><img src="a.png"><i data="b.svg">'))) == ["a.png", "b.svg"]


def test_json_checks(spark):
    rows = spark.createDataFrame([('{"a": {"b": 1}}',), ("{a",), (None,), ("[1, 2]",)], "j string")
    assert [r[0] for r in rows.select(html.valid_json(F.col("j"))).collect()] == [True, False, False, True]
    doc = F.try_parse_json("j")
    assert [r[0] for r in rows.select(json.variant_path(doc, "$.a.b", "int")).collect()] == [1, None, None, None]


def test_batches_are_python_objects_in_pieces():
    import pyarrow as pa

    texts = [None, "", "a" * (html.PIECE_BYTES // 2), "b" * (html.PIECE_BYTES // 3), "c" * (3 * html.PIECE_BYTES), None, "d"]
    pieces = list(html._pieces([pa.array(texts, pa.string()), pa.array(range(7))]))
    assert [x for piece, _ in pieces for x in piece] == texts and [n for _, at in pieces for n in at] == list(range(7))
    assert [at for _, at in pieces] == [[0, 1, 2, 3], [4], [5, 6]]
    assert list(html._pieces([pa.array([], pa.string())])) == []


def test_tokens_of_a_batch_of_many_pieces(spark):
    pages = [(n, None if n % 7 == 3 else "" if n % 7 == 5 else f"<div><p>{n}</p></div>" + " " * (html.PIECE_BYTES // 5)) for n in range(40)]
    df = spark.createDataFrame(pages, "n int, page string").coalesce(1).withColumn("e", html.html_tokens(F.col("page")))
    got = {r["n"]: r["e"] and [(e["path"], e["text"]) for e in r["e"]] for r in df.drop("page").collect()}
    assert got == {n: page if page is None else [("/0", ""), ("/0/1", str(n))] if page else [] for n, page in pages}
    assert df.where("n < 0").collect() == []


def test_mapped_functions_share_a_worker(spark):
    pages = [(n, None if n % 7 == 3 else f"<p>{n} &amp;amp; <a href='/x'>l</a></p>" + "x" * (html.PIECE_BYTES // 5)) for n in range(40)]
    df = spark.createDataFrame(pages, "n int, page string").coalesce(1)
    page = F.col("page")
    made = df.select("n", html.whitelist_html(page, F.lit("https://a.b/")).alias("clean"), html.html_unescape(page).alias("plain"), html.absolute_url(F.lit(None).cast("string"), page).isNull().alias("gone"))
    assert made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("ArrowEvalPython [") == 1
    got = {r["n"]: (r["clean"], r["plain"], r["gone"]) for r in made.collect()}
    assert got == {n: (None, None, True) if p is None else (html.whitelisted(p, "https://a.b/"), p.replace("&amp;amp;", "&amp;"), False) for n, p in pages}
    assert made.where("n < 0").count() == 0
