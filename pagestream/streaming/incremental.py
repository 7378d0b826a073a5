"""Incremental builds: plan, versioned snapshots with a pointer, streams into a state table.

State is the published output.  Every version is written whole under its own directory;
then a pointer file with the next number is made under another name and renamed, and the
highest pointer counts.  Pointers are never deleted before a newer one is in place, so a run
that fails at any step leaves the last version, and going back is one more pointer.

A pointer names the directories that make up the version.  State that is merged by key is
partitioned by a hash of the key; a batch rewrites the partitions that its keys fall into,
and the pointer keeps the directories of the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plan_upsert(now: DataFrame, stored: DataFrame, key: str, print_: str, version: int, force: Column | None = None) -> DataFrame:
    """``action`` for each current row: new, stale (older render version), changed or kept; vanished rows are not kept."""
    old = stored.select(F.col(key).alias("__key"), F.col(print_).alias("__print"), F.col("version").alias("__version"), F.lit(True).alias("__known"))
    joined = now.join(old, F.col(key) == F.col("__key"), "left")
    changed = ~F.col(print_).eqNullSafe(F.col("__print"))
    action = F.when(F.col("__known").isNull(), "new").when(F.coalesce("__version", F.lit(0)) < version, "stale").when(changed if force is None else changed | force, "changed").otherwise("kept")
    return joined.withColumn("action", action).drop("__key", "__print", "__version", "__known")


#: Partitions of state that is merged by key.
STATE_PARTS = 64


class Snapshots:
    """Versioned snapshots of a table under a path that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        at = self._at(self.path)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _pointers(self) -> list[str]:
        """Complete pointer files, oldest first."""
        return sorted(n for n in self._names() if n.startswith("current-") and n.endswith(".json"))

    def _read(self, pointer: str) -> dict:
        return json.loads("".join(r["value"] for r in self.spark.read.text(f"{self.path}/{pointer}").collect()))

    def _write(self, version: str, parts: dict[str, str]) -> None:
        """Point at a version by a pointer of the next number; another writer that took the number is an error."""
        last = self._pointers()
        number = int(last[-1][len("current-") : -len(".json")]) + 1 if last else 1
        new, final = self._at(f"{self.path}/.{uuid.uuid4().hex}.new"), self._at(f"{self.path}/current-{number:012d}.json")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps({"version": version, "parts": parts}).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(new, final):
            self._fs.delete(new, False)
            raise FileExistsError(f"another run published {final.toString()}")

    def pointer(self) -> dict | None:
        """Version and parts of the newest pointer; versions without any pointer are an error, not an empty state."""
        found = self._pointers()
        if found:
            return self._read(found[-1])
        if any(self._fs.exists(self._at(f"{self.path}/{n}/_SUCCESS")) for n in self._names() if n.startswith("v-")):
            raise FileNotFoundError(f"{self.path} holds versions but no pointer; restore one of them")
        return None

    def current(self) -> str | None:
        found = self.pointer()
        return found["version"] if found else None

    def load(self, version: str | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The current version, or a named one; an empty table where there is none and a schema is given."""
        parts = self._parts_of(version) if version else self.pointer()
        if parts is None:
            if schema is None:
                raise FileNotFoundError(f"no snapshot under {self.path}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(*[f"{self.path}/{at}" for at in sorted(set(parts["parts"].values()))])

    def _parts_of(self, version: str) -> dict:
        for p in reversed(self._pointers()):
            if (found := self._read(p))["version"] == version:
                return found
        if self._fs.exists(self._at(f"{self.path}/{version}/_SUCCESS")):
            return {"version": version, "parts": {"": version}}
        raise FileNotFoundError(version)

    def publish(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a version, then point at it."""
        version = f"v-{uuid.uuid4().hex}"
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{version}")
        self._write(version, {"": version})
        return version

    def merge(self, batch: DataFrame, key: str, combine: Callable[[DataFrame, DataFrame], DataFrame], parts: int = STATE_PARTS) -> str | None:
        """Merge a batch into state partitioned by key: ``combine(state, batch)`` sees the partitions of the batch's keys only."""
        part = F.pmod(F.xxhash64(key), F.lit(parts))
        now = self.pointer()
        held = dict(now["parts"]) if now else {}
        if "" in held:
            raise ValueError(f"{self.path} is not partitioned by key")
        touched = [str(r[0]) for r in batch.select(part).distinct().collect()]  # at most ``parts`` numbers
        if not touched:
            return now["version"] if now else None
        old = [f"{self.path}/{held[p]}" for p in touched if p in held]
        state = self.spark.read.schema(batch.schema).parquet(*old) if old else self.spark.createDataFrame([], batch.schema)
        version = f"v-{uuid.uuid4().hex}"
        combine(state, batch).withColumn("__part", part).write.partitionBy("__part").parquet(f"{self.path}/{version}")
        held |= {p: f"{version}/__part={p}" for p in touched if self._fs.exists(self._at(f"{self.path}/{version}/__part={p}"))}
        self._write(version, held)
        return version

    def prune(self, keep: int = 2) -> None:
        """Remove pointers older than the last ``keep``, and the directories that no pointer left names."""
        pointers = self._pointers()
        used = {at.split("/")[0] for p in pointers[-keep:] for at in self._read(p)["parts"].values()}
        for p in pointers[:-keep]:
            self._fs.delete(self._at(f"{self.path}/{p}"), False)
        for n in self._names():
            if n.startswith("v-") and n not in used:
                self._fs.delete(self._at(f"{self.path}/{n}"), True)

    def publish_if(self, changed: bool, df: DataFrame) -> str | None:
        """Publish where something changed; else the last version stays, byte for byte."""
        return self.publish(df) if changed else self.current()

    def restore(self, version: str) -> None:
        """Point back at an earlier version."""
        self._write(version, self._parts_of(version)["parts"])

    def guarded(self, build: Callable[[], DataFrame], check: Callable[[DataFrame], None] = lambda df: None) -> str | None:
        """Build, check and publish; on any failure the last version stays current and the error is raised."""
        df = build()
        check(df)
        return self.publish(df)


def upsert_batch(snapshots: Snapshots, key: str, order: Column, schema: T.StructType) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges a micro-batch into the state, the first row of a key staying.

    A batch that runs again changes nothing.
    """

    def combine(state: DataFrame, batch: DataFrame) -> DataFrame:
        merged = state.withColumn("__late", F.lit(0)).unionByName(batch.withColumn("__late", F.lit(1)))
        return merged.groupBy(key).agg(F.min_by(F.struct(*schema.names), F.struct("__late", order.alias("o"))).alias("r")).select("r.*")

    def run(batch: DataFrame, _: int) -> None:
        snapshots.merge(batch.select(*schema.names), key, combine)

    return run


def dedup_stream(events: DataFrame, ts: str, keys: list[str], delay: str) -> DataFrame:
    """Stream without repeated keys within a watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def read_landing(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of a landing directory, so many files for each trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_to_end(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is there, in bounded micro-batches, then stop."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def first_of_each(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """First row of each key of a directory, computed as a stream into a snapshot."""
    schema = spark.read.parquet(path).schema
    where = shared_path(spark, "stream")
    snapshots = Snapshots(spark, f"{where}/state")
    kept = T.StructType([schema[key], schema[order]])
    # a file source needs a directory: the parent, narrowed to the table
    parent, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path if _is_dir(spark, path) else f"{parent}/{name[:-1]}[{name[-1]}]")
    run_to_end(stream.select(key, order), upsert_batch(snapshots, key, F.col(order), kept), f"{where}/checkpoint")
    return snapshots.load(schema=kept)


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
