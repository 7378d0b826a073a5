"""Operators on literal rows, and invariants."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagestream.operators import aggregates, dedup, joins, layout, quality, sequence, topk


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_first_wins_and_forced(spark):
    df = spark.createDataFrame([("a", 3, False), ("b", 5, False), ("A", 7, False), ("a", 9, True)], "k string, pos int, force boolean")
    assert rows(dedup.first_wins(df, F.lower("k"), ["pos"]), "pos") == [(3,), (5,)]
    forced = dedup.first_wins_or_forced(df, F.lower("k"), ["pos"], F.col("force"))
    assert rows(forced, "pos") == [(3,), (5,), (9,)]
    once = dedup.first_wins(df, F.lower("k"), ["pos"])
    assert rows(dedup.first_wins(once, F.lower("k"), ["pos"]), "pos") == rows(once, "pos")


def test_two_keys_and_last(spark):
    df = spark.createDataFrame([("s1", "T", 1, True), ("s1", "U", 2, True), ("s2", "t", 3, True), ("s3", "t", 4, False)], "slug string, title string, pos int, fresh boolean")
    got = dedup.two_key_first_wins(df, F.col("slug"), F.lower("title"), ["pos"], F.col("fresh"))
    assert rows(got, "pos") == [(1,), (4,)]
    assert rows(dedup.last_wins(df, "slug", F.col("pos"), ["title"]), "slug", "title") == [("s1", "U"), ("s2", "t"), ("s3", "t")]


def test_spans_and_bodies(spark):
    page = spark.createDataFrame([(1, "## [A](u)\ntext a\n## [B](v)\ntext b")], "id int, page string")
    spans = sequence.match_spans(page, F.col("page"), r"## \[(.+?)\]\((.+?)\)", 2)
    got = sequence.lead_span(spans, F.col("page"), ["id"]).orderBy("pos").collect()
    assert [(r["groups"], r["start"], r["body"]) for r in got] == [(["A", "u"], 1, "\ntext a\n"), (["B", "v"], 18, "\ntext b")]


@pytest.mark.parametrize(("at", "kept"), [(0, [1, 2, 3, 4]), (2, [0, 1, 3, 4]), (3, [0, 1, 2]), (4, [0, 1, 2, 3])])
def test_stop_marker(spark, at, kept):
    df = spark.createDataFrame([("d", i, i == at) for i in range(5)], "doc string, pos int, stop boolean")
    assert rows(sequence.until_stop(df, F.col("stop"), ["doc"], ["pos"], at_least=3), "pos") == [(k,) for k in kept]


def test_paragraphs_and_bullets(spark):
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(["a", "b", "", "c", "- x", "y", "- z"])], "doc string, pos int, line string")
    text = sequence.assemble(lines.where("pos < 4"), F.col("line"), F.col("line") == "", ["doc"], ["pos"])
    assert rows(text, "first_pos", "text") == [(0, "a b"), (3, "c")]
    items = sequence.merge_continuations(lines.where("pos > 3"), F.col("line"), F.startswith("line", F.lit("- ")), ["doc"], ["pos"])
    assert rows(items, "text") == [("- x y",), ("- z",)]


def test_islands_use_the_running_maximum(spark):
    df = spark.createDataFrame([(1, 0.0, 100.0), (1, 5.0, 10.0), (1, 90.0, 95.0), (1, 104.0, 110.0), (1, 200.0, 210.0)], "doc int, y0 double, y1 double")
    got = sequence.merge_overlapping(df, "y0", "y1", F.lit(5.0), ["doc"], ["y0"])
    assert rows(got, "y0", "island") == [(0.0, 0), (5.0, 0), (90.0, 0), (104.0, 0), (200.0, 1)]


def test_ordinals_and_runs(spark):
    df = spark.createDataFrame([(1, 0, True), (1, 1, True), (1, 2, False), (1, 3, True)], "doc int, pos int, m boolean")
    assert rows(sequence.ordinals(df, ["doc"], ["pos"], F.col("m")), "pos", "ordinal") == [(0, -1), (1, -2), (2, 1), (3, -3)]
    got = {r["pos"]: r["run"] for r in sequence.runs(df, F.col("m"), ["doc"], ["pos"]).collect()}
    assert got[0] == got[1] != got[3]
    assert got[2] is None


def test_carry_forward(spark):
    now = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "new"), ("d", None)], "guid string, fresh string")
    old = spark.createDataFrame([("a", "old"), ("b", "")], "guid string, pub string")
    got = joins.carry_forward(now, old, "guid", "pub", F.col("fresh"), F.lit("run"))
    assert {r["guid"]: r["pub"] for r in got.collect()} == {"a": "old", "b": None, "c": "new", "d": "run"}


def test_positional_out_of_range(spark):
    a = spark.createDataFrame([("p", i) for i in range(3)], "page string, x int")
    b = spark.createDataFrame([("p", 10), ("p", 11)], "page string, y int")
    assert rows(joins.positional(a, b, ["page"], ["x"], ["y"]), "x", "y") == [(0, 10), (1, 11)]


def test_full_outer_leftovers(spark):
    slots = spark.createDataFrame([(1, 0), (2, 1)], "k int, o int")
    found = spark.createDataFrame([(2, "f"), (-1, "g")], "k int, file string")
    assert rows(joins.full_outer_leftovers(slots, found, "k", "o"), "k", "state") == [(-1, "leftover"), (1, "unfilled"), (2, "filled")]


def test_two_key_lookup(spark):
    table = spark.createDataFrame([("g1", "s1", "x"), (None, "s2", "y")], "guid string, slug string, v string")
    now = spark.createDataFrame([("g1", "s2"), ("g9", "s2"), ("g9", "s9")], "guid string, slug string")
    assert sorted(str(r["old_v"]) for r in joins.two_key_lookup(now, table, "guid", "slug", ["v"]).collect()) == ["None", "x", "y"]


@pytest.mark.parametrize(("width", "left"), [(5.9, 1), (6.0, 0), (0.0, 1)])
def test_rectangle_cover(spark, width, left):
    box = spark.createDataFrame([("d", 0.0, 0.0, 10.0, 1.0)], "doc string, x0 double, y0 double, x1 double, y1 double")
    cover = spark.createDataFrame([("d", 0.0, 0.0, width, 1.0)], "doc string, x0 double, y0 double, x1 double, y1 double")
    assert joins.not_covered(box, cover, ["doc"], 0.6).count() == left


def test_boilerplate_thresholds(spark):
    df = spark.createDataFrame([("f", p, t) for p in range(8) for t in (["Menu"] if p < 3 else []) + ["menu 2"] * (p < 2) + ["x" * 120]], "feed string, page int, line string")
    assert rows(aggregates.boilerplate_lines(df, "feed", "page", "line"), "line", "n") == [("menu", 3)]
    two = df.where("page < 2")
    assert aggregates.boilerplate_lines(two, "feed", "page", "line").count() == 0


def test_two_column_reading_order(spark):
    boxes = [("a", 0, 0, 40, 10), ("b", 60, 0, 100, 10), ("c", 0, 20, 40, 30), ("d", 60, 20, 100, 30), ("full", 0, 40, 100, 45), ("e", 0, 50, 40, 60), ("f", 60, 50, 100, 60)]
    df = spark.createDataFrame([("doc", 1, n, float(x0), float(y0), float(x1), float(y1)) for n, x0, y0, x1, y1 in boxes], "doc string, page int, text string, x0 double, y0 double, x1 double, y1 double")
    got = layout.reading_order(df, 100.0).orderBy("nth").collect()
    assert [r["text"] for r in got] == ["a", "c", "b", "d", "full", "e", "f"]


@pytest.mark.parametrize("page", ["1", "id % 3"])
def test_partitions_of_reading_order_follow_the_size_read(spark, tmp_path, monkeypatch, page):
    n = F.col("id").cast("double")
    spark.range(4000).select((F.col("id") % 500).cast("string").alias("doc"), "id", n.alias("x0"), n.alias("y0"), (n + 9).alias("x1"), (n + 9).alias("y1")).write.parquet(str(tmp_path / "b"))
    boxes = spark.read.parquet(str(tmp_path / "b")).withColumn("page", F.expr(page))
    stored = sum(p.stat().st_size for p in (tmp_path / "b").glob("*.parquet"))
    usual = {tuple(r) for r in layout.reading_order(boxes, 50.0, ["id"]).select("id", "nth").collect()}
    monkeypatch.setattr(layout, "PART_BYTES", stored // 20)
    ordered = layout.reading_order(boxes, 50.0, ["id"])
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange hashpartitioning"), plan.count("Sort [")) == (1, 2)
    assert 20 <= ordered.rdd.getNumPartitions() <= 22
    assert {tuple(r) for r in ordered.select("id", "nth").collect()} == usual and len(usual) == 4000


def test_undated_first_or_last(spark):
    df = spark.createDataFrame([(1, "2026-01-02"), (2, None), (3, "2026-01-05")], "pos int, d string").withColumn("ts", F.try_to_timestamp("d"))
    last = [r["pos"] for r in df.orderBy(topk.newest_first(F.col("ts"), "last"), "pos").collect()]
    first = [r["pos"] for r in df.orderBy(topk.newest_first(F.col("ts"), "first", F.lit("2026-02-01").cast("timestamp")), "pos").collect()]
    assert (last, first) == ([3, 1, 2], [2, 3, 1])


def test_quality_gate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", None)], "k string, n int")
    found = quality.violations(df, F.col("k"), {"big": F.col("n") > 2})
    assert rows(found, "key", "rule") == [("a", "big"), ("c", "big")]
    with pytest.raises(quality.QualityError, match="big"):
        quality.require_none(found)
    quality.require_none(found.where("false"))


def test_title_rule_is_the_pattern(spark):
    pieces = ["<h1>", "<H1 a='b'>", "</h1>", "</H1>", " ", "  ", "\n", "a", "<h1", ">", "<p>", "\u0130", "\U0001f600"]
    draw = random.Random(1)
    pages = ["".join(draw.choices(pieces, k=draw.randint(0, 9))) for _ in range(3000)] + ["<h1></h1>x</h1>", "<h1 </h1>", "</h1>a<h1>", None]
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    got = df.select(quality.has_title(F.col("page")).alias("a"), F.col("page").rlike("(?is)<h1[^>]*>.*[^ ].*</h1>").alias("b"), "page").collect()
    assert [r for r in got if r["a"] != r["b"]] == [] and {r["b"] for r in got} == {True, False, None}


@pytest.mark.parametrize("page", ["<h1>T</h1>" + "word " * 200_000, "<h1>a" * 200_000, "<h1 " * 200_000, "<h1>" + " " * 1_000_000])
def test_title_rule_takes_a_pages_length(spark, page):
    rules = quality.structure_rules(F.col("page"))
    df = spark.createDataFrame([("k", page)], "k string, page string")
    began = time.monotonic()
    assert ("heading" in {r["rule"] for r in quality.violations(df, F.col("k"), rules).collect()}) != page.startswith("<h1>T")
    assert time.monotonic() - began < 30


def test_counters(spark):
    df, seen = aggregates.counted(spark.range(10), "run", even=F.count_if(F.col("id") % 2 == 0))
    df.collect()
    assert seen.get == {"even": 5}
