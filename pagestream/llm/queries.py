"""The thin queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as dc
from . import htmltext, jaccard, langid, linededup, mix, quality, shard, sql, toxicity, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dc.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        dc.N_WORDS,
        dc.hit_words().alias("n_hit"),
        F.size(dc.ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", dc.ITEMS).cast("binary"), 256).alias("items_sha256"),
        (F.size(dc.SPANS) > 0).alias("contaminated"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urlfilter.fit(urlfilter.training_table(spark))
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"), weights, ["page_id"])


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract_pages(_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held = langid.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.train(documents, labels.where(~held))
    return toxicity.score(documents.withColumn("held_out", held), model, ["doc_id", "held_out"])


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents"), 3, 90, 100).select("doc_id", "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.assign_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return placed.select(
        "doc_id",
        shard.record_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(shard.LAW).alias("law"),
        shard.SHARD,
        shard.SLOT,
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select("doc_id", *quality.BASE, "base_failed", "kept")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(documents.where(~held & F.col("doc_id").isNotNull()))
    return langid.identify(documents.withColumn("held_out", held), model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix_sources, op2_decontaminate, op3_url_filter, op4_html_text, op5_toxicity, op6_jaccard, op7_line_dedup, op8_shard, op9_quality, op10_language)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ALL)
