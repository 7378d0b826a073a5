"""Readers, writers, snapshots, streams and the named pipelines on files made here."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pagestream.plans import extraction
from pagestream.sources import readers, sinks
from pagestream.streaming import incremental



def run_ts():
    return F.lit("2026-05-01 08:00:00").cast("timestamp")


@pytest.fixture
def items(spark):
    rows = [("f", 0, "A & B", "https://x/a", "g1", False, dt.datetime(2026, 4, 20, 2, 48, 55), "d <1>", None, "a", "https://x/a"), ("f", 1, "C", "https://x/c", "g2", True, None, "", "<p>c</p>", "c", "https://x/c")]
    return spark.createDataFrame(rows, "feed string, pos int, title string, link string, guid string, is_permalink boolean, pub_ts timestamp, description string, content_html string, slug string, source_url string").withColumn("author", F.lit(None).cast("string"))


def test_feed_round_trip(spark, items, tmp_path):
    channels = spark.createDataFrame([("f", "F", "https://x", "", "en")], "feed string, title string, link string, description string, language string").withColumn("last_build", run_ts())
    sinks.write_feeds(items, channels, str(tmp_path / "out"))
    xml = next((tmp_path / "out" / "feed=f").glob("*.txt")).read_text()
    (tmp_path / "f.xml").write_text(xml)
    got = readers.read_feed(spark, str(tmp_path / "f.xml")).orderBy("guid").collect()
    assert [(r["title"], r["guid"], r["is_permalink"], r["description"], r["is_broken"]) for r in got] == [("A & B", "g1", False, "d <1>", False), ("C", "g2", True, None, False)]
    assert got[0]["pub_date_raw"] == "Mon, 20 Apr 2026 02:48:55 GMT"
    assert got[1]["content_html"] == "<p>c</p>"
    channel = readers.read_channel(spark, str(tmp_path / "f.xml")).first()
    assert channel["title"] == "F"
    assert readers.read_previous(spark, str(tmp_path / "f.xml")).where("slug = 'a'").count() == 1
    assert readers.read_previous(spark, str(tmp_path / "none.xml")).count() == 0


def test_sitemap_pages_and_markdown(spark, tmp_path):
    (tmp_path / "map.xml").write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://x/a</loc><lastmod>2026-04-20</lastmod></url><url><loc>https://x/b</loc></url></urlset>')
    assert [r["url"] for r in readers.read_sitemap(spark, str(tmp_path / "map.xml")).orderBy("url").collect()] == ["https://x/a", "https://x/b"]
    page = tmp_path / "item" / "f" / "s"
    page.mkdir(parents=True)
    (page / "index.html").write_text("<h1>T</h1>")
    row = readers.read_pages(spark, str(tmp_path)).first()
    assert (row["feed"], row["slug"], row["html"]) == ("f", "s", "<h1>T</h1>")
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "a.md").write_text("Title: T\nPublished Time: 2026-04-20T02:48:55Z\nMarkdown Content:\n# T\n\nbody")
    row = readers.read_markdown(spark, str(tmp_path / "md")).first()
    assert (row["title"], row["markdown"]) == ("T", "# T\n\nbody")


def test_json_sources(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps([{"url": "/a", "title": ""}, {"url": "/b", "title": "B", "formattedPublishedDate": "March 5, 2026"}, {"url": "/c", "title": "C"}]))
    assert [r["link"] for r in readers.read_listing_json(spark, str(tmp_path / "l.json"), 2, "https://x").collect()] == ["https://x/b"]
    (tmp_path / "h.json").write_text(json.dumps({"insights": {"hits": [{"title": "T", "slug": "s"}]}}))
    assert readers.read_hits(spark, str(tmp_path / "h.json")).first()["path"] == "s"
    (tmp_path / "p.json").write_text(json.dumps([{"id": 1, "link": "u", "date_gmt": "2026-04-20T02:48:55", "title": {"rendered": "T"}}]))
    (tmp_path / "d.json").write_text(json.dumps([{"id": 1, "content": {"rendered": "<p>b</p><script>x</script>"}}]))
    posts = readers.read_posts(spark, str(tmp_path / "p.json"), str(tmp_path / "d.json"))
    assert extraction.render_whitelisted(posts, "https://x").first()["content_html"] == "<p>b</p>"


def test_config():
    got = readers.load_config("settings: {max_items: 3}\nname: x", "settings: {max_items: 200, dedup: true}")
    assert got == {"settings": {"max_items": 3, "dedup": True}, "name": "x"}
    with pytest.raises(ValueError, match="mapping"):
        readers.load_config("- a")


def test_first_source_and_cache(spark):
    empty, one, two = spark.range(0), spark.range(1), spark.range(2)
    assert readers.first_source(empty, one, two).count() == 1
    cache = spark.range(1).select(readers.cache_key(F.lit("u1")).alias("key"))
    wanted = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert [r["url"] for r in readers.not_cached(wanted, cache).collect()] == ["u2"]


def test_generic_extraction(spark):
    page = "## [First](https://x/a)\nAbout it.\nMarch 5, 2026\n## [Second](https://x/b)\nNo date here.\n## [First](https://x/a)\nAgain\n## [Other](https://y/c)\n"
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    previous = spark.createDataFrame([("none", "x")], "guid string, pub_date_raw string")
    config = {"extraction": {"pattern": "## [{%}]({%})", "link_group": 2, "link_filter": "^https://x/"}, "settings": {"max_items": 5}}
    got = extraction.extract_items(pages, config, previous, run_ts()).orderBy("pos").collect()
    assert [(r["title"], r["link"], r["description"], r["pub_date_raw"]) for r in got] == [
        ("First", "https://x/a", "About it.", "Thu, 05 Mar 2026 00:00:00 GMT"),
        ("Second", "https://x/b", "No date here.", "Fri, 01 May 2026 08:00:00 GMT"),
    ]
    again = extraction.extract_items(pages, config, previous, run_ts(), undated_new="none").orderBy("pos").collect()
    assert again[1]["pub_date_raw"] is None


def test_rewrite_and_postprocess(spark, items):
    pages = spark.createDataFrame([("f", "a", "<h1>T</h1><p>a much longer text of the page</p>")], "feed string, slug string, html string")
    got = extraction.rewrite_feed(items, pages, "https://b", ["f"]).orderBy("pos").collect()
    assert got[0]["link"] == "https://b/item/f/a/"
    assert got[0]["description"].startswith("T a much longer")
    assert got[0]["content_html"] is None
    stored = spark.createDataFrame([("<head></head><h1>T</h1><a href='x' href=\"https://o/z\">",)], "html string")
    first = extraction.postprocess_pages(stored, "b.example")
    twice = extraction.postprocess_pages(first.select("html"), "b.example")
    assert first.first()["status"] == "added"
    assert twice.first()["html"] == first.first()["html"]


def test_article_pipelines(spark):
    md = "Title: T\n# T\n\n" + "Some text of the article. " * 20
    pages = spark.createDataFrame([("u", "T", md), ("v", "B", "Just a moment..."), ("w", "S", "short")], "url string, title string, markdown string")
    assert [r["url"] for r in extraction.parse_article(pages).collect()] == ["u"]
    blocks = spark.createDataFrame([("u", 0, "text", "A", "<p>A</p>"), ("u", 1, "nav", "N", "n"), ("u", 2, "text", "a ", "<p>a</p>"), ("u", 3, "stop", "S", ""), ("u", 4, "text", "Z", "<p>Z</p>")], "url string, pos int, component string, text string, markup string")
    assert extraction.component_article(blocks, ["url"]).first()["joined"] == "<p>A</p>"
    doc = '{"properties": {"title": "T", "authors": {"name": "N"}}, "items": {"b": {"type": "text", "text": "x"}, "a": {"type": "quote", "text": "q"}}}'
    row = extraction.json_article(spark.createDataFrame([(doc,)], "doc string"), "doc").first()
    assert (row["title"], row["authors"], row["content_html"]) == ("T", "N", "<p>x</p>\n<blockquote>q</blockquote>")
    charts = spark.range(1).select(extraction.charts_into_body(F.lit("a[[chart]]b[[chart]]c"), F.array(F.lit("<svg/>"))).alias("x")).first()["x"]
    assert charts == "a<svg/>b<p>Chart not available</p>c"


def test_pages_json_and_rehost(spark, items):
    keyed = sinks.keyed_json(items)
    assert sinks.pages_of_json(keyed).count() == 2
    pages = spark.createDataFrame([("f", "a", '<img src="http://x/1.png">'), ("f", "b", "none")], "feed string, slug string, html string")
    assets = spark.createDataFrame([("http://x/1.png", "img-001.png")], "url string, local string")
    assert sorted(r["html"] for r in sinks.rehosted(pages, assets).collect()) == ['<img src="img-001.png">', "none"]


def test_snapshots(spark, tmp_path):
    snap = incremental.Snapshots(spark, str(tmp_path / "s"))
    first = snap.publish(spark.range(1))
    second = snap.publish(spark.range(2))
    assert snap.current() == second
    snap.restore(first)
    assert snap.load().count() == 1
    with pytest.raises(ValueError, match="bad"):
        snap.guarded(lambda: spark.range(3), lambda df: (_ for _ in ()).throw(ValueError("bad")))
    assert snap.current() == first
    assert snap.publish_if(False, spark.range(9)) == first


def test_a_lost_pointer_loses_no_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    snap = incremental.Snapshots(spark, str(tmp_path / "s"))
    upsert = incremental.upsert_batch(snap, "k", F.col("v"), schema)
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    upsert(batch(*[(i, 0) for i in range(50)]), 0)
    files = {p for p in (tmp_path / "s").rglob("*.parquet")}
    upsert(batch((3, 9), (77, 1)), 1)
    # only the partitions of the batch's keys are written
    new = {p.parent.name for p in (tmp_path / "s").rglob("*.parquet")} - {p.parent.name for p in files}
    assert len({p for p in (tmp_path / "s").rglob("*.parquet")} - files) <= 2
    assert len(new) <= 2
    state = sorted(map(tuple, snap.load(schema=schema).collect()))
    assert state == [(i, 0) for i in range(50)] + [(77, 1)]
    upsert(batch((3, 9), (77, 1)), 1)  # again, as after a failure
    assert sorted(map(tuple, snap.load(schema=schema).collect())) == state
    # a run that dies before its pointer is renamed leaves the last one
    newest = max((tmp_path / "s").glob("current-*.json"))
    newest.rename(tmp_path / "s" / ".cut-off.new")
    upsert(batch((78, 1)), 2)
    assert sorted(map(tuple, snap.load(schema=schema).collect())) == [*state, (78, 1)]
    snap.prune(keep=1)
    assert snap.load(schema=schema).count() == 52
    for p in (tmp_path / "s").glob("current-*.json"):
        p.unlink()
    with pytest.raises(FileNotFoundError):
        upsert(batch((79, 1)), 3)


def test_upsert_actions(spark):
    now = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c"), (4, "d")], "id int, print string")
    stored = spark.createDataFrame([(1, "a", 2), (2, "b", 2), (3, "c", 1), (9, "z", 2)], "id int, print string, version int")
    got = incremental.plan_upsert(now, stored, "id", "print", 2)
    assert {r["id"]: r["action"] for r in got.collect()} == {1: "kept", 2: "changed", 3: "stale", 4: "new"}


def test_stream_dedup(spark, tmp_path):
    schema = "k string, ts timestamp"
    spark.createDataFrame([("a", dt.datetime(2026, 1, 1)), ("a", dt.datetime(2026, 1, 1, 0, 1)), ("b", dt.datetime(2026, 1, 1))], schema).write.parquet(str(tmp_path / "in"))
    stream = incremental.read_landing(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    seen = []
    incremental.run_to_end(incremental.dedup_stream(stream, "ts", ["k"], "10 minutes"), lambda df, _: seen.extend(r["k"] for r in df.collect()), str(tmp_path / "cp"))
    assert sorted(seen) == ["a", "b"]


def test_listing_cards_and_elements(spark):
    from pagestream.functions import html as h
    from pagestream.functions import json as js

    page = '<div class="card big" data-k="1"><a href="/a"><h3>A</h3></a><p>about</p><time datetime="2026-04-20">x</time><img src="i.png"></div><div class="card"><p>b</p><p>c</p><ul></ul></div>'
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    got = extraction.listing_cards(pages, "card").orderBy("pos").collect()
    assert [tuple(r)[2:] for r in got] == [("/a", "A", "about", "2026-04-20", "i.png"), (None, None, "b", None, None)]
    els = pages.select(h.html_tokens(F.col("html")).alias("e"))
    row = els.select(h.nearest_ancestor(F.col("e"), F.lit("/0/1/2"), "data-k").alias("k"), h.following_siblings(F.col("e"), F.lit("/6/7"), 1, ["p", "ul"]).alias("s")).first()
    assert row["k"] == "1"
    assert [x["text"] for x in row["s"]] == ["c"]
    doc = spark.range(1).select(js.json_attribute(F.lit('<a data-x="{&quot;a&quot;: 1}">'), "data-x").alias("x")).first()["x"]
    assert doc == '{"a": 1}'


def test_layout_article(spark):
    rows = []
    for page in range(4):
        rows += [("d", page, 0.0, 2.0, 100.0, 6.0, "Running head of it", 8.0, False), ("d", page, 5.0, 20.0, 95.0, 30.0, f"Heading {page} here", 18.0, True), ("d", page, 5.0, 40.0, 95.0, 50.0, f"exam-\nple text {page}", 10.0, False), ("d", page, 10.0, 62.0, 40.0, 68.0, "label in figure", 10.0, False)]
    boxes = spark.createDataFrame(rows, "doc string, page int, x0 double, y0 double, x1 double, y1 double, text string, size double, bold boolean")
    drawings = spark.createDataFrame([("d", p, 5.0, 60.0, 95.0, 80.0) for p in range(4)], "doc string, page int, x0 double, y0 double, x1 double, y1 double")
    got = extraction.layout_article(boxes, drawings, 100.0, 100.0).orderBy("page", "nth").collect()
    assert [(r["kind"], r["text"]) for r in got][:2] == [("h2", "Heading 0 here"), ("p", "example text 0")]
    assert len(got) == 8


def test_builder_runs(spark, tmp_path):
    from pagestream.operators import quality
    from pagestream.plans import build

    snap = incremental.Snapshots(spark, str(tmp_path / "s"))
    listing = spark.createDataFrame([("f", i, f"Title {i}", f"https://x/a{i}", "about", f"2026-04-{10 + i}") for i in range(4)], "feed string, pos int, title string, link string, description string, pub_date_raw string")
    details = spark.createDataFrame([(f"https://x/a{i}", f"<p>Body {i}</p>") for i in (0, 1, 3)], "link string, content_html string")
    rules = {"page": F.contains("html", F.lit("<p>Body"))}
    first = build.run(snap, listing, details, run_ts(), 1, rules, first=3, budget=2)
    # the three newest are listed, two are built: 3 has an article, 2 has none and waits
    assert [r["slug"] for r in snap.load().collect()] == ["a3"]
    second = build.run(snap, listing, details, run_ts(), 1, rules, budget=2)
    assert second != first
    held = {r["slug"]: r for r in snap.load().collect()}
    assert set(held) == {"a1", "a3"}
    assert "<h1>Title 1</h1>" in held["a1"]["html"]
    assert held["a1"]["pub_date_raw"] == "Sat, 11 Apr 2026 00:00:00 GMT"
    build.run(snap, listing, details, run_ts(), 1, rules)
    last = snap.current()
    assert {r["slug"] for r in snap.load().collect()} == {"a0", "a1", "a3"}
    assert build.run(snap, listing, details, run_ts(), 1, rules) == last  # nothing new: the version stays
    with pytest.raises(quality.QualityError, match="page: f/a3"):
        build.run(snap, listing, details.withColumn("content_html", F.lit("<p>bad</p>")), run_ts(), 2, rules, budget=1, later=3)
    assert snap.current() == last
    build.run(snap, listing.where("pos > 0"), details, run_ts(), 1)  # what the listing lost goes
    assert {r["slug"] for r in snap.load().collect()} == {"a1", "a3"}


def test_headline_cache_and_structure(spark, tmp_path):
    from pagestream.operators import quality

    blocks = spark.createDataFrame([("a", 0, 12.0, "x" * 90), ("a", 1, 20.0, "y" * 70), ("a", 2, 20.0, "z" * 30), ("b", 0, 30.0, "short")], "doc string, pos int, size double, text string")
    assert [(r["doc"], r["text"]) for r in extraction.headline(blocks, ["doc"]).collect()] == [("a", "y" * 70)]
    readers.save_cache(spark.createDataFrame([("u1", "page")], "url string, html string"), str(tmp_path / "cache"))
    wanted = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert [r["url"] for r in readers.not_cached(wanted, spark.read.parquet(str(tmp_path / "cache"))).collect()] == ["u2"]
    pages = spark.createDataFrame([(1, "<h1>T</h1><p>a<p>b<p class=x>c"), (2, "<h1> </h1><p>a")], "id int, html string")
    found = quality.violations(pages, F.col("id"), quality.structure_rules(F.col("html")))
    assert sorted((r["key"], r["rule"]) for r in found.collect()) == [(2, "heading"), (2, "paragraphs")]
    with pytest.raises(Exception, match="no title"):
        quality.asserted(pages, F.col("id") < 2, F.lit("no title")).collect()


def test_windowed_paragraphs(spark):
    page = "menu\n\n" + "\n\n".join(["Commentary of the week", "A long enough paragraph about markets and rates.", "short", "Another long enough paragraph about growth.", "STOP here and after it nothing."])
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    got = extraction.windowed_paragraphs(pages, "html", F.lit("Commentary"), ["STOP"]).orderBy("pos").collect()
    assert [r["paragraph"] for r in got] == ["A long enough paragraph about markets and rates.", "Another long enough paragraph about growth."]


def test_binaries_mirror_and_logs(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"%PDF" + b"x" * 1200)
    (folder / "short.pdf").write_bytes(b"%PDF")
    (folder / "other.pdf").write_bytes(b"<html>" + b"x" * 1200)
    found = readers.read_binaries(spark, str(folder), b"%PDF", 1000)
    assert [r["path"].rsplit("/", 1)[-1] for r in found.collect()] == ["a.pdf"]
    sinks.mirror(found, str(tmp_path / "mirror"))
    copy = spark.read.parquet(str(tmp_path / "mirror")).collect()
    assert [bytes(r["content"]) for r in copy] == [(folder / "a.pdf").read_bytes()]  # unchanged
    for status in ("SUCCESS", "FAILED"):
        sinks.log_run(spark.createDataFrame([("f", status)], "feed string, status string"), str(tmp_path / "log"))
    assert sorted(r["status"] for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["FAILED", "SUCCESS"]


def test_written_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame([("f", "a", "<p>1</p>"), ("g", "a", "<p>2</p>"), ("f", "b", None)], "feed string, slug string, html string")
    sinks.write_pages(pages, str(tmp_path / "pages"))
    back = spark.read.parquet(str(tmp_path / "pages"))
    assert sorted((r["feed"], r["slug"], r["html"] or "") for r in back.collect()) == [("f", "a", "<p>1</p>"), ("f", "b", ""), ("g", "a", "<p>2</p>")]
    assert [r["html"] for r in back.where("feed = 'g'").collect()] == ["<p>2</p>"]
