"""The corpus pipeline: five stages over ``documents``, each a function of (spark, docs, sf_dir).

A stage gets what its predecessor kept, as a Parquet table, and returns a DataFrame.  All
but the last return the columns of ``documents``.

1. ``language``: mixture language identification; a document stays if the wanted languages
   (``LANGUAGES``; all learned ones by default) explain at least ``LEAST`` of its text.
   Documents without a letter, in other languages or of no language go.  Where no labelled
   text exists to learn from, every document with a letter stays.
2. ``near_duplicates``: n-gram Jaccard join on five-word shingles at 0.8; the document of
   the smallest id of each group stays.
3. ``decontaminate``: documents with a benchmark window go.
4. ``mix``: sources mixed to target weights; a document stays with as many rows as the
   mix takes it (a document taken in part stays whole), so decisions take effect and
   texts stay whole.
5. ``shard``: two-pass external shuffle into eight shards; adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestream.llm import decontaminate, jaccard, langid, mix, shard
from pagestream.llm.common import dropped, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 8
#: The languages that the first stage keeps (None: every learned one), and how much of a text they must explain.
LANGUAGES: Sequence[str] | None = None
LEAST = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: Sequence[str] | None = LANGUAGES, least: float = LEAST) -> DataFrame:
    """Documents of which the wanted languages explain at least ``least``."""
    model = langid.train(docs)
    if model is None:  # no labelled text to learn from: a letter is enough, as with a model
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs.select(*COLUMNS), model, list(COLUMNS))
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (langid.explained(languages) >= least)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_first(docs.select(*COLUMNS), 5, 80, 100)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mix.repeat_taken(docs.select(*COLUMNS))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled records with their shard and slot."""
    return shard.assign_shards(docs.select(*COLUMNS), SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminated), ("mix", mixed), ("shard", sharded)]

#: Language mixtures and seeded permutations have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder, read again, and removed after the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs, path = written(out, f"pipeline-{name}")
        if before:
            dropped(spark, before)
        before = path
    return docs
