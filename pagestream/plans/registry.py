"""Registry of queries: ``registered`` maps a name to (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
registered: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        registered[f.__name__] = (f, sql)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(c: str) -> Column:
    return F.col(c).cast("timestamp")
