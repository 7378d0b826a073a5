"""Sharding by a two-pass external shuffle.

Pass one scatters every record into memory-sized buckets by a seeded hash of its id
and text: one exchange of the whole rows, uniform whatever the sources or copies.  Rows of
one id and text that fill more than a bucket (counted, where a bucket is found overfull) are
combined with their number before they move and dealt by a copy number of their own.
Pass two sorts each bucket by that hash (Spark's sort spills) and applies a Fisher-Yates
permutation of the bucket's places.  A permutation follows from the seed, the bucket and
its number of rows alone, so it is drawn beside the records: one array of places for each
bucket, joined by bucket where the records already lie, and the texts never leave the
JVM.  A record's global place is the bucket's offset plus its place in the bucket;
contiguous runs of places form the shards, whose sizes differ by one row at most
(law ``rows``).  A task that runs again after a lost executor gives the same places.

Defined results: null ids and null texts hash like values of their own; the order of rows
that are equal in id and text among each other is free; an empty table gives no rows.  A
column named like an output gives way to it.  Rows with a column that cannot be grouped by
(a map) are not split when they repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, small

#: Bytes of text in a bucket, and the most partitions that buckets are dealt to.
BUCKET_BYTES = 16 << 20
PARTITIONS = 100_000
SEED = 20_240_601
SHARD, SLOT = "shard", "slot"
LAW = "rows"


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _permutations(batches):
    """The places of each bucket's records: Fisher-Yates on 0..n-1, seeded by the bucket."""
    for batch in batches:
        bucket, n, key = (batch.column(i).to_numpy() for i in range(3))
        for i in range(len(bucket)):
            perm = np.random.Generator(np.random.PCG64([int(key[i]), int(bucket[i])])).permutation(int(n[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(3).slice(i, 1), pa.array([perm.astype(np.int32)], type=pa.list_(pa.int32()))], names=["p_bucket", "offset", "perm"])


def assign_shards(records: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``records`` with ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in each shard)."""
    if not 0 < shards:
        raise ValueError("shards must be positive")
    records = records.drop(*[c for c in (SHARD, SLOT) if c not in (id_col, text_col)])
    columns = records.columns
    named = [F.col(f"`{id_col}`"), F.col(f"`{text_col}`")]
    key = F.xxhash64(F.lit(seed), *named, *[c.isNull() for c in named])
    total, rows = records.agg(F.sum(record_bytes(F.col(f"`{text_col}`"))), F.count(F.lit(1))).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    own = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)]
    size = record_bytes(F.col(f"__c{columns.index(text_col)}"))
    hashed = _split_copies(records.select(*own, key.alias("__key"), F.pmod(key, F.lit(buckets)).alias("__bucket")), size, buckets, bucket_bytes)
    sizes = kept(hashed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n")))
    offset = F.sum("n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    drawn = sizes.select("__bucket", "n", F.lit(seed).cast("long").alias("seed"), offset.alias("offset"))
    perms = drawn.mapInArrow(_permutations, "p_bucket long, offset long, perm array<int>")
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy("__key", f"__c{columns.index(id_col)}"))
    spread = hashed.repartition(min(buckets, PARTITIONS), "__bucket")
    placed = spread.withColumn("__nth", place).join(perms.hint("merge"), F.col("__bucket") == F.col("p_bucket"))
    low, extra = divmod(rows, shards)
    g, wide = F.col("offset") + F.col("perm")[F.col("__nth") - 1], extra * (low + 1)
    placed = placed.withColumn("__g", g)
    shard = F.expr(f"case when __g < {wide} then __g div {low + 1} else {extra} + (__g - {wide}) div {max(low, 1)} end").cast("int")
    slot = F.expr(f"case when __g < {wide} then __g % {low + 1} else (__g - {wide}) % {max(low, 1)} end").cast("long")
    return placed.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], shard.alias(SHARD), slot.alias(SLOT))


def _split_copies(hashed: DataFrame, size: Column, buckets: int, bucket_bytes: int) -> DataFrame:
    """``hashed`` with the copies of one key dealt over the buckets where they would overfill one."""
    groupable = not any(isinstance(f.dataType, T.MapType) for f in hashed.schema.fields)
    most = hashed.groupBy("__bucket").agg(F.sum(size).alias("b")).agg(F.max("b")).first()[0] or 0
    if buckets == 1 or most <= 2 * bucket_bytes or not groupable:
        return hashed
    hot = kept(hashed.groupBy("__key").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).where((F.col("b") > bucket_bytes) & (F.col("n") > 1)).select("__key"))
    if not (n := hot.count()):
        return hashed
    hot = small(hot, n, 16)
    fields = hashed.columns
    copies = hashed.join(hot, "__key", "left_semi").groupBy(*fields).agg(F.count(F.lit(1)).alias("__n"))
    copies = copies.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    dealt = copies.withColumn("__bucket", F.pmod(F.xxhash64(*fields, "__copy"), F.lit(buckets))).select(*fields)
    return hashed.join(hot, "__key", "left_anti").select(*fields).unionAll(dealt)


def write_shards(records: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shuffled records to ``path/shard=k``; a bucket meets two shards at most, so tasks write few files."""
    assign_shards(records, shards, **options).write.partitionBy(SHARD).parquet(path)
