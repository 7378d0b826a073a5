"""What several operators share: the shared folder, checked broadcasts, tables on disk."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and holds at most so many bytes.
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset and the session is local (tests), one of our own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(found)
        return found
    if not (own := spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
        spark.sparkContext.setCheckpointDir(own := tempfile.mkdtemp(prefix="pagestream-"))
    return own


#: What this session keeps: tables in the shared folder, and tables on executors' disks.
_tables: list[str] = []
_kept: list[DataFrame] = []


def released(spark: SparkSession) -> None:
    """Drop every intermediate table of this session, once no result that reads them is needed any more."""
    unkept(*_kept)
    for path in list(_tables):
        dropped(spark, path)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder: lineage is cut, a lost executor costs only its running tasks."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if path in _tables:
        _tables.remove(path)


def kept(df: DataFrame) -> DataFrame:
    """``df``, kept on the executors' disks once computed, for tables that are read again.

    Its lineage stays: what a lost executor held is computed again.
    """
    _kept.append(df.persist(StorageLevel.DISK_ONLY))
    return _kept[-1]


def unkept(*tables: DataFrame) -> None:
    """Let go of kept tables that nothing reads any more."""
    for df in tables:
        df.unpersist()
    _kept[:] = [x for x in _kept if all(x is not df for df in tables)]


#: Bytes of an Arrow batch between the JVM and Python: both sides hold a few of them for each task.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches to BATCH_BYTES, where it is higher or unset."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(name).lower())
    now = int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[found[2]] if found else 0
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


#: Rows of a partition of a narrow table that is cut.
CUT_ROWS = 250_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder.

    ``rows``: a known bound on its rows; partitions, and so files, then follow it.
    """
    shared_folder(df.sparkSession)
    return (df if rows is None else df.coalesce(-(-rows // CUT_ROWS) or 1)).checkpoint()


def settled(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` computed once by as many tasks as it has, counted, then cut; and its number of rows."""
    held = kept(df)
    n = held.count()
    done = cut(held, n)
    unkept(held)
    return done, n


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast if its counted rows fit BROADCAST_BYTES; else leave the join to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
