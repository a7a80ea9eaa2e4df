"""Snapshots on plain Parquet (S10, S11, M09, M10), file compaction (G01), Z-order layout.

A published version is one complete snapshot folder plus one log entry that names it:

* ``<root>/data/<version>-<attempt>/`` — the rows, written first;
* ``<root>/versions/version=<n>.json`` — a one-row log entry, created last, at once, and never overwritten.

Readers only see versions with a log entry, so a crashed or rejected write is invisible
(stage → validate → publish).  Two writers of one version collide on the log
entry, which only one of them can create (``create_file`` says on which stores).  This is a naming convention for snapshots, not a table
format: there is no transaction log and no merge on read.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.sources.ingest import create_file, list_names, list_times, remove

LOG_SCHEMA = "published_at timestamp, operation string, row_count long, path string, version long"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log_path = f"{self.root}/versions"

    def history(self) -> DataFrame:
        """Published versions.  Only a log that does not exist yet is empty; any
        read error propagates."""
        if not list_names(self.spark, self.log_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").json(self.log_path)

    def latest_version(self) -> int | None:
        return self.history().agg(F.max("version").alias("v")).first()["v"]

    def publish(self, df: DataFrame, operation: str = "WRITE", version: int | None = None, validate=None) -> int:
        """Write ``df`` as ``version`` (default: the next one), validate it, then add its log entry.

        ``validate(staged_df) -> bool``; a failing validation leaves the
        version unpublished.  An existing version is never overwritten."""
        if version is None:
            latest = self.latest_version()
            version = 0 if latest is None else latest + 1
        path = f"{self.root}/data/{version}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        if validate is not None and not validate(staged):
            raise ValueError(f"version {version} failed validation; not published")
        entry = {"published_at": _dt.datetime.now(_dt.timezone.utc).isoformat(), "operation": operation, "row_count": staged.count(), "path": path, "version": version}
        create_file(self.spark, f"{self.log_path}/version={version}.json", json.dumps(entry) + "\n")
        return version

    def expire(self, before: _dt.datetime, keep_last: int = 1) -> list[int]:
        """Drop the versions published before ``before``, but not the newest ``keep_last``; returns their numbers.

        A version's log entry goes first, so from then on reading it fails clearly ("no published version"), then its
        folder.  A run that stops between the two leaves folders without an entry; the next one removes those that were
        written before ``before``, too, so it must be older than any write that is still going on."""
        rows = self.history().select("version", "published_at", "path").orderBy(F.desc("version")).collect()  # versions, not rows
        mark = self.spark.range(1).select(F.lit(before).cast("timestamp").alias("t")).first()["t"]
        gone = [r for r in rows[max(1, keep_last):] if r["published_at"] < mark]
        for r in gone:
            remove(self.spark, f"{self.log_path}/version={r['version']}.json")
        kept = {r["path"].rsplit("/", 1)[1] for r in rows} - {r["path"].rsplit("/", 1)[1] for r in gone}
        for name, modified in list_times(self.spark, f"{self.root}/data"):
            if name not in kept and (modified < mark.timestamp() or any(r["path"].endswith(f"/{name}") for r in gone)):
                remove(self.spark, f"{self.root}/data/{name}")
        return sorted(r["version"] for r in gone)

    def read(self, version: int | None = None, as_of: _dt.datetime | str | None = None) -> DataFrame:
        """A published version (latest by default, or the newest one
        published at or before ``as_of``).  Only that folder is scanned."""
        hist = self.history()
        if version is not None:
            hist = hist.filter(F.col("version") == version)
        elif as_of is not None:
            hist = hist.filter(F.col("published_at") <= F.lit(as_of).cast("timestamp"))
        path = hist.agg(F.max_by("path", "version").alias("p")).first()["p"]
        if path is None:
            raise ValueError(f"no published version (version={version}, as_of={as_of})")
        return self.spark.read.parquet(path)


def compact_files(spark: SparkSession, source: str, target: str, target_file_bytes: int = 128 * 1024 * 1024) -> int:
    """Copy a folder of many small Parquet files into files of about ``target_file_bytes``;
    returns their number.  The caller switches readers to ``target``.

    A file is written by one task.  Where the files to write are few beside the parts that are read (or one), each task
    reads its share of the small files as they are; otherwise rows are dealt out by a shuffle, which makes the files alike."""
    from tablecheck.sources.ingest import file_inventory
    size = file_inventory(spark, source).agg(F.sum("size_bytes")).first()[0] or 0
    n = max(1, -(-size // target_file_bytes))
    rows = spark.read.parquet(source)
    few = n == 1 or rows.rdd.getNumPartitions() >= 4 * n
    (rows.coalesce(int(n)) if few else rows.repartition(int(n))).write.mode("errorifexists").parquet(target)
    return int(n)


def zorder(df: DataFrame, columns: list[str], n_partitions: int, bits: int = 16,
           partition_bytes: int = 16 * 1024 * 1024) -> DataFrame:
    """Cluster rows by a Morton (Z-order) key over several columns:
    range-partition on the key, sort inside partitions.

    ``n_partitions`` is the least number of ranges; a larger input gets one for every ``partition_bytes`` of the files it is read
    from, so what a task sorts does not grow with the table."""
    from tablecheck.functions import morton_key
    from tablecheck.sources.ingest import file_bytes
    k = morton_key(columns, bits)
    n = max(n_partitions, -(-file_bytes(df) // partition_bytes))
    return df.withColumn("__z", k).repartitionByRange(n, "__z").sortWithinPartitions("__z").drop("__z")


def save_snapshot(df: DataFrame, table_name: str) -> tuple[DataFrame, int]:
    """S10 silver snapshot: overwrite a managed table, read it back, count."""
    df.write.mode("overwrite").saveAsTable(table_name)
    snap = df.sparkSession.table(table_name)
    return snap, snap.count()


@contextmanager
def bronze_snapshot(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """S11/G06 bronze snapshot: persisted for the duration of a block, released after."""
    snap = df.persist(level)
    try:
        yield snap
    finally:
        snap.unpersist()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (shared storage on a
    cluster) — survives executor loss, unlike a local checkpoint."""
    from tablecheck.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
