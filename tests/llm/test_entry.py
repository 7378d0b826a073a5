"""Registered queries: columns of the contracts, SQL, and the pipeline's stages."""

import zlib

import pytest
from compare import assert_same
from pyspark.sql import functions as F

import corpus_pipeline
from pagestream.llm import queries as q

COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op3_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_line_dedup": {"doc_id": "bigint", "text": "string", "n_lines": "bigint", "n_dropped": "bigint"},
    "op8_shard": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op9_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_contract(spark, sf, name):
    got = q.queries()[name](spark, sf)
    kinds = dict(got.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    source = "pages" if "page_id" in COLUMNS[name] else "documents"
    assert got.count() == spark.read.parquet(f"{sf}/{source}.parquet").count()


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_sql(spark, sf, duck, name):
    assert_same(q.queries()[name](spark, sf).toPandas(), duck.sql(q.oracle_sql()[name]).df())


def test_crc_and_held_out(spark, sf):
    rows = q.op8_shard(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) and r["size"] == len(r["text"].encode()) + 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in q.op10_language(spark, sf).collect())


def test_pipeline_stages(spark, sf, tmp_path):
    import brute

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        if name != "shard":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        if name == "language":
            letters = {d for d, t in before.items() if t and any(c.isalpha() for c in t)}
            labelled = {r["doc_id"] for r in docs.where("lang is not null").collect()}
            assert labelled & letters == {r["doc_id"] for r in rows} & letters  # documents of learned languages stay
        elif name == "near_duplicates":
            assert sorted(r["doc_id"] for r in rows) == sorted({g for _, g in brute.groups(list(before.items()), 5, 80, 100).values()})
        elif name == "decontaminate":
            hit = brute.contamination(list(before.items()), bench)
            assert sorted(r["doc_id"] for r in rows) == sorted(d for d in before if not hit[d][1])
        elif name == "mix":
            assert {r["doc_id"] for r in rows} <= set(before)
            mixed = len(rows)
        else:
            assert len(rows) == mixed
            assert sorted({r["shard"] for r in rows}) == list(range(8))
        before = {r["doc_id"]: r["text"] for r in rows}


def test_language_stage_without_labels(spark, sf):
    docs = spark.createDataFrame([(1, "clean words", None, "s", 11), (2, "12 34 !", None, "s", 7), (3, None, None, "s", 0), (4, "слова", None, "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, sf).collect()) == [1, 4]


def test_language_stage_decides(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    one = {r["lang"]: r["text"] for r in docs.where("length(text) > 300").collect()}
    half = lambda k: one[k][: min(len(one["en"]), len(one["de"]))]
    new = [
        (-1, "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 3, None), (-2, "qzxj vkqw xzzq jjkx wqvz qxqx zvkj xkcq vvqz " * 5, None), (-3, one["de"], None),
        (-4, half("en") + " " + half("de"), None), (-5, "123 456 !!", "en"), (-6, one["en"], None),
    ]
    both = docs.unionByName(spark.createDataFrame([(i, t, k, "s", len(t)) for i, t, k in new], docs.schema))
    kept = lambda **wanted: {r["doc_id"] for r in corpus_pipeline.language(spark, both, sf, **wanted).where("doc_id < 0").collect()}
    assert kept() == {-3, -4, -6}  # another language, no language and no letter go
    assert kept(languages=["en"], least=0.8) == {-6}  # the wrong language and the mixture go
    assert kept(languages=["en", "de"], least=0.8) == {-3, -4, -6}
    assert kept(least=0.0) == {-1, -2, -3, -4, -6}


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).where(F.col("slot") == 0).count() == 8


CLASHES = ("shard", "slot", "taken", "size", "cls", "root", "lang_pred", "score", "hit_spans", "key", "bucket")


def _tables(spark, folder, rows, bench):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_on_awkward_rows(spark, sf, tmp_path):
    usual = spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    texts = [r["text"] for r in usual.where("lang = 'en' and length(text) > 300").orderBy("doc_id").limit(4).collect()]
    back = [" ".join(reversed(t.split())) for t in texts]
    rows = [
        (-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, " \n\t", "en", None, 3), (-5, back[0], "en", "s", 50), (-5, back[0], "en", "s", 50), (-6, back[0], None, "t", 50),
        (None, back[1], "en", "s", 1), (-7, back[2], "en", "t", 9), (-8, (texts[3] + " ") * 400, None, None, None), (-9, "!!! ### 123", "de", None, 5),
    ]
    folder = _tables(spark, tmp_path, rows, [("a", back[2]), ("b", None), (None, ""), ("c", "not in any text")])
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(usual)
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit("clash"))
    awkward = lambda df: sorted((r["doc_id"] for r in df.where("doc_id < 0 or doc_id is null").collect()), key=str)
    expected = {"language": [-5, -5, -6, -7, -8, None], "near_duplicates": [-6, -7, -8, None], "decontaminate": [-6, -8, None]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name in expected:  # no letter, then copies, then the benchmark's text go; a null id stays
            assert awkward(docs) == sorted(expected[name], key=str)
        elif name == "mix":
            mixed = docs.count()
            assert set(awkward(docs)) <= {-6, -8, None}
    got = docs.collect()
    assert len(got) == mixed and set(docs.columns) == {*corpus_pipeline.COLUMNS, "shard", "slot"}
    assert all(len(r["text"]) == 400 * (len(texts[3]) + 1) for r in got if r["doc_id"] == -8)
    for k in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))


@pytest.mark.parametrize("rows, bench", [([], [("a", "some words")]), ([], []), ([(1, None, None, None, None), (None, None, "en", "s", 0)], [])])
def test_run_on_nothing(spark, tmp_path, rows, bench):
    assert corpus_pipeline.run(spark, _tables(spark, tmp_path, rows, bench)).count() == 0


def test_run_without_a_benchmark(spark, tmp_path):
    rows = [(i, f"text number {i} of a few words that differ {'q' * i} from one another", "en", "s", 9) for i in range(12)]
    got = corpus_pipeline.run(spark, _tables(spark, tmp_path, rows, [])).collect()
    assert {r["doc_id"] for r in got} == set(range(12))
