"""Month-partitioned landing, run modes, ledgers and done markers.

The reference downloads files one by one in a single process.  Here landing
is a Spark job: the source is read once, the month selection is a partition
predicate (pruned at the scan when the source is itself partitioned), and the
write is a dynamic partition overwrite — re-running the same months replaces
exactly those partitions (idempotent).  Bookkeeping (ledger, marker) is
derived from Spark-side aggregates; nothing row-level goes through the driver.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
import uuid
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Landing layout and marker texts.
PARTITION_COLS = ("year", "month")
MARKER_FIELDS = ["ingestion_date", "job_type", "data_period", "taxi_types", "total_files", "total_size_gb", "job_run_id",
                 "latest_available_month", "publication_delay_months", "duplicate_files_skipped", "status"]
MODE_CURRENT = "current"
MODE_HISTORICAL = "historical"
STATUS_SUCCESS = "SUCCESS"
STATUS_EMPTY = "EMPTY"
STATUS_PARTIAL = "PARTIAL"

LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])


# --------------------------------------------------------------------------- months
def month_sequence(spark: SparkSession, start_year: int, start_month: int, num_months: int) -> DataFrame:
    """``num_months`` consecutive (year, month) from a start, December
    rolling over into January — built by Spark's ``sequence`` of dates."""
    if num_months <= 0:
        return spark.createDataFrame([], "year int, month int")
    start = _dt.date(start_year, start_month, 1)
    d = F.explode(F.sequence(F.lit(start), F.add_months(F.lit(start), num_months - 1),
                             F.expr("INTERVAL 1 MONTH"))).alias("d")
    return spark.range(1).select(d).select(F.year("d").alias("year"), F.month("d").alias("month"))


def with_month_partitions(df: DataFrame, ts_col: str) -> DataFrame:
    """Add integer ``year``/``month`` partition columns from an event time."""
    return df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))


def month_index(year: Column | str, month: Column | str) -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return y * 12 + (m - 1)


def months_predicate(start_year: int, start_month: int, num_months: int,
                     year: str = "year", month: str = "month") -> Column:
    """S01/S07 on (year, month) columns: bounds on the year alone reach the scan even
    where the two are ordinary columns; on partition columns all of it prunes."""
    lo = start_year * 12 + (start_month - 1)
    hi = lo + num_months - 1
    y = F.col(year)
    return (y >= lo // 12) & (y <= hi // 12) & month_index(year, month).between(lo, hi)


def month_range_predicate(df: DataFrame, ts_col: str, start_year: int, start_month: int, num_months: int) -> Column:
    """S01/S07 on an event time: a half-open range ``[first month, after the last)``, pushed to
    the scan as plain comparisons."""
    def first(index: int) -> Column:
        return F.lit(f"{index // 12:04d}-{index % 12 + 1:02d}-01").cast(df.schema[ts_col].dataType)
    lo = start_year * 12 + (start_month - 1)
    return (F.col(ts_col) >= first(lo)) & (F.col(ts_col) < first(lo + num_months))


# --------------------------------------------------------------------------- latest month, run modes
def latest_available_month(partitions: DataFrame, as_of: _dt.date,
                           year: str = "year", month: str = "month") -> DataFrame:
    """Newest (year, month) of the current year up to the current month,
    else the newest of the previous year, else (previous year, 1).

    ``partitions`` is any DataFrame with year/month columns (e.g. the landed
    table; only its partition columns are read).  One aggregate, one row."""
    cur_y, cur_m = as_of.year, as_of.month
    cand = partitions.select(F.col(year).cast("int").alias("y"), F.col(month).cast("int").alias("m")).filter(
        ((F.col("y") == cur_y) & (F.col("m") <= cur_m)) | (F.col("y") == cur_y - 1))
    best = cand.agg(F.max(F.struct("y", "m")).alias("b"))
    return best.select(F.coalesce(F.col("b.y"), F.lit(cur_y - 1)).alias("latest_year"),
                       F.coalesce(F.col("b.m"), F.lit(1)).alias("latest_month"))


def run_mode_window(mode: str, latest_year: int, latest_month: int, base_year: int = 2024) -> list[tuple[int, int, int]]:
    """The month ranges a run covers, as (start_year, start_month, n).

    ``current``    -> the latest month only.
    ``historical`` -> every month from January of ``base_year`` up to the month
    before the latest (D30: years between base and latest are included).
    """
    if mode == MODE_CURRENT:
        return [(latest_year, latest_month, 1)]
    if mode != MODE_HISTORICAL:
        raise ValueError("mode must be 'current' or 'historical'")
    n = (latest_year * 12 + latest_month - 1) - base_year * 12
    return [(base_year, 1, n)] if n > 0 else []


def run_mode_predicate(mode: str, latest_year: int, latest_month: int, base_year: int = 2024,
                       year: str = "year", month: str = "month") -> Column:
    parts = [months_predicate(y, m, n, year, month) for y, m, n in run_mode_window(mode, latest_year, latest_month,
                                                                                base_year)]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def run_mode_range(df: DataFrame, ts_col: str, mode: str, latest_year: int, latest_month: int,
                   base_year: int = 2024) -> Column:
    """S07 on an event time (pushable); nothing to read gives false."""
    parts = [month_range_predicate(df, ts_col, y, m, n)
             for y, m, n in run_mode_window(mode, latest_year, latest_month, base_year)]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


# --------------------------------------------------------------------------- landing
def union_types(frames: dict[str, DataFrame], type_col: str = "trip_type") -> DataFrame:
    """Several sources with drifting schemas -> one frame + literal type column."""
    parts = [df.withColumn(type_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def land(df: DataFrame, target: str, predicate: Column | None = None, fmt: str = "parquet",
         max_records_per_file: int | None = None, months: list[tuple[int, int]] | None = None) -> None:
    """Write the selected months as Hive partitions ``year=YYYY/month=MM``.

    The rows are rebalanced by month: AQE cuts a large month into several writers and
    packs small ones together.  Dynamic partition overwrite replaces the partitions
    present in ``df``; with ``months`` (what the run covers), a month that has no rows any more
    is replaced by an empty one, so a re-run or backfill is idempotent there too.
    A table that was landed with unpadded months (``month=1``) keeps that layout; one that holds a month
    in both forms is an error."""
    from tablecheck.sources.readers import month_folders
    spark = df.sparkSession
    out = df.filter(predicate) if predicate is not None else df
    years = {r[0] for r in out.select("year").distinct().collect()} | {y for y, _ in months or []}  # years, not rows
    names = month_folders(spark, target, [y for y in years if y is not None])
    plain = any(n == f"month={m}" for (_, m), n in names.items() if m < 10)
    if plain and any(n == f"month={m:02d}" for (_, m), n in names.items() if m < 10):
        raise ValueError(f"{target} holds padded and unpadded months")
    width = 1 if plain else 2
    named = out.withColumn("month", F.col("month").cast("string") if plain else F.lpad(F.col("month").cast("string"), 2, "0"))
    w = (named.hint("rebalance", *PARTITION_COLS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITION_COLS).format(fmt))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(target)
    if months:
        present = {tuple(r) for r in out.select(*PARTITION_COLS).distinct().collect()}
        for y, m in sorted(set(months) - present):
            out.drop(*PARTITION_COLS).limit(0).write.mode("overwrite").format(fmt).save(f"{target}/year={y}/month={m:0{width}d}")


# --------------------------------------------------------------------------- file inventory, ledger
def file_inventory(spark: SparkSession, root: str, glob: str = "*.parquet", modified_after: str | None = None) -> DataFrame:
    """Files under ``root`` with size and modification time, without
    reading their content (``binaryFile`` source, content column pruned).
    year/month are taken from Hive-style path segments when present."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after.replace(" ", "T")[:19])
    inv = (reader.load(root)
           .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modification_time")))
    y = F.regexp_extract("path", r"year=(\d{4})", 1)
    m = F.regexp_extract("path", r"month=(\d{1,2})", 1)
    return inv.select("path", F.when(y != "", y.cast("int")).alias("year"),
                      F.when(m != "", m.cast("int")).alias("month"), "size_bytes", "modification_time")


def new_files(inventory: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Candidate files not yet in the ledger (left anti join on path)."""
    if ledger is None:
        return inventory
    done = ledger.filter(F.col("status") == STATUS_SUCCESS).select("path").distinct()
    return inventory.join(done, "path", "left_anti")


def files_modified_since(spark: SparkSession, root: str, ledger: DataFrame, overlap_seconds: int = 0,
                         glob: str = "*.parquet") -> DataFrame:
    """Files whose modification time is not older than the ledger's newest one less ``overlap_seconds``, and that the
    ledger does not hold with that time.

    The time bound prunes the listing (``modifiedAfter``); the ledger decides among files of equal or overlapping times, so
    none is lost or repeated.  A file written again is new; ``overlap_seconds`` covers stores and writers whose
    clocks differ.  An empty ledger takes every file."""
    done = ledger.filter(F.col("status") == STATUS_SUCCESS).select("path", F.col("modification_time").alias("seen")).distinct()
    newest = done.agg((F.max("seen") - F.expr(f"INTERVAL {overlap_seconds + 1} SECONDS")).cast("string").alias("t")).first()["t"]  # whole seconds, and the bound is exclusive
    files = file_inventory(spark, root, glob, newest)
    return files.join(done, (files["path"] == done["path"]) & (files["modification_time"] == done["seen"]), "left_anti")


def ledger_rows(files: DataFrame, run_id: str, status: str = STATUS_SUCCESS) -> DataFrame:
    """Ledger entries for a run (one per file), ready to append."""
    return files.select("path", F.col("year").cast("int"), F.col("month").cast("int"), "size_bytes",
                        F.col("modification_time").cast("timestamp"), F.lit(status).alias("status"),
                        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("landed_at"))


def size_report(inventory: DataFrame) -> DataFrame:
    """Size per file in MB and the total in GB (the total is a scalar
    subquery: one aggregate, no join)."""
    total = inventory.agg(F.sum("size_bytes")).scalar()
    return inventory.select(
        "path", F.round(F.col("size_bytes") / F.lit(1024 * 1024), 1).alias("size_mb"),
        F.round(total / F.lit(1024 ** 3), 2).alias("total_gb"))


def done_marker(landed: DataFrame, job_type: str, run_id: str, latest_year: int, latest_month: int,
                types: list[str], skipped: int = 0, ingestion_time: _dt.datetime | None = None,
                size_col: str | None = "size_bytes", expected_months: int | None = None) -> DataFrame:
    """The one-row done marker, aggregated from what was landed.

    ``landed`` has one row per landed file (or per landed month partition)
    with year/month (+ size).  data_period = the first landed month; status is
    computed (D31): SUCCESS, PARTIAL (fewer months than expected) or EMPTY."""
    aggs = [F.count(F.lit(1)).alias("total_files"), F.min(F.struct("year", "month")).alias("first")]
    if size_col and size_col in landed.columns:
        aggs.append(F.sum(size_col).alias("bytes"))
    else:
        aggs.append(F.lit(0).cast("long").alias("bytes"))
    a = landed.agg(*aggs)
    ts = (ingestion_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).isoformat()
    period = F.when(F.col("first").isNotNull(),
                    F.format_string("%04d-%02d", F.col("first.year"), F.col("first.month"))).otherwise(F.lit("unknown"))
    status = F.when(F.col("total_files") == 0, F.lit(STATUS_EMPTY))
    if expected_months is not None:
        status = status.when(F.col("total_files") < expected_months, F.lit(STATUS_PARTIAL))
    status = status.otherwise(F.lit(STATUS_SUCCESS))
    values = [F.lit(ts), F.lit(job_type), period, F.array(*[F.lit(t) for t in types]), F.col("total_files"),
              F.round(F.coalesce(F.col("bytes"), F.lit(0)) / F.lit(1024 ** 3), 2), F.lit(run_id),
              F.lit(f"{latest_year:04d}-{latest_month:02d}"), _publication_delay(latest_year, latest_month, ingestion_time),
              F.lit(skipped).cast("long"), status]
    return a.select(*[v.alias(n) for v, n in zip(values, MARKER_FIELDS)])


def _publication_delay(latest_year: int, latest_month: int, now: _dt.datetime | None) -> Column:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return F.lit((now.year * 12 + now.month) - (latest_year * 12 + latest_month)).cast("long")


def write_marker(marker: DataFrame, path: str) -> None:
    """One small JSON file (the marker has one row)."""
    marker.coalesce(1).write.mode("overwrite").json(path)


# --------------------------------------------------------------------------- reference files, config-driven
def read_reference_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Lookup CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def generic_ingest(spark: SparkSession, config: DataFrame, readers: dict | None = None) -> list[str]:
    """Metadata-driven ingest — one config row per source
    (source_name, file_format, source_url, target_prefix, partition_cols).
    The config is small and collected; each source is a normal Spark job."""
    done = []
    for row in config.collect():
        r = row.asDict()
        reader = (readers or {}).get(r["source_name"])
        df = reader() if reader else spark.read.format(r["file_format"]).option("header", True).load(r["source_url"])
        cols = r.get("partition_cols") or []
        w = df.write.mode("overwrite")
        if cols:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
        w.parquet(r["target_prefix"])
        done.append(r["source_name"])
    return done


def incremental_since(df: DataFrame, watermark_col: str, last_value) -> DataFrame:
    """Rows strictly newer than the stored watermark (the stored
    value is cast to the column's type; pass text for time zone-free values)."""
    if last_value is None:
        return df
    return df.filter(F.col(watermark_col) > F.lit(last_value).cast(df.schema[watermark_col].dataType))


def next_watermark(df: DataFrame, watermark_col: str) -> DataFrame:
    """The new watermark value (one aggregate) — persist it only after
    the data write succeeded."""
    return df.agg(F.max(watermark_col).alias("watermark"))


class IncrementalLoad:
    """Incremental loads under a persisted watermark.

    * ``<root>/batches/batch=<n>/`` — the rows of one load, written first (a re-run overwrites them);
    * ``<root>/control/batch=<n>.json`` — its control row ``(batch, low, high, row_count, loaded_at)``, created last and at once.

    A load reads what is newer than the last control row's ``high`` and not newer than the newest value it
    saw before reading, so rows that arrive meanwhile belong to the next load.  Readers see only batches with a control
    row: a crash before it leaves a folder that the next load overwrites, a crash after it leaves nothing to
    do, so no row is lost or read twice.  Of two loads at once one fails at the control row.  Rows of a watermark value
    must be complete when a newer value is seen; ``lag`` (an interval text) keeps the newest part for later where they are not."""

    def __init__(self, spark: SparkSession, root: str, watermark_col: str):
        self.spark, self.root, self.watermark_col = spark, root.rstrip("/"), watermark_col

    def control(self) -> DataFrame:
        """The committed loads, one row each."""
        schema = "batch long, low string, high string, row_count long, loaded_at string"
        if not list_names(self.spark, f"{self.root}/control"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("mode", "FAILFAST").json(f"{self.root}/control")

    def last(self) -> tuple[int, str | None]:
        """Number and upper bound of the last committed load; ``(-1, None)`` before the first."""
        row = self.control().agg(F.max(F.struct("batch", "high")).alias("r")).first()["r"]
        return (row["batch"], row["high"]) if row else (-1, None)

    def load(self, source: DataFrame, lag: str | None = None) -> int | None:
        """Load what is new; returns the batch number, or None if nothing was."""
        last, low = self.last()
        kind = source.schema[self.watermark_col].dataType
        new = incremental_since(source, self.watermark_col, low)
        high = F.max(self.watermark_col) - F.expr(f"INTERVAL {lag}") if lag else F.max(self.watermark_col)
        high = new.agg(high.cast("string").alias("high")).first()["high"]
        if high is None:
            return None
        path = f"{self.root}/batches/batch={last + 1}"
        new.filter(F.col(self.watermark_col) <= F.lit(high).cast(kind)).write.mode("overwrite").parquet(path)
        n = self.spark.read.schema(source.schema).parquet(path).count()
        if not n:
            return None
        row = {"batch": last + 1, "low": low, "high": high, "row_count": n, "loaded_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
        create_file(self.spark, f"{self.root}/control/batch={last + 1}.json", json.dumps(row) + "\n")
        return last + 1

    def read(self) -> DataFrame:
        """The rows of all committed loads, with their batch."""
        batches = [r["batch"] for r in self.control().select("batch").collect()]  # loads, not rows
        if not batches:
            raise ValueError(f"nothing has been loaded to {self.root}")
        return self.spark.read.option("basePath", f"{self.root}/batches").parquet(*[f"{self.root}/batches/batch={b}" for b in batches])


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of the store; none if it does not exist."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []


def list_times(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names in a folder of the store with their modification times in seconds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in store.listStatus(path)] if store.exists(path) else []


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is read from, each counted once; 0 where it is not read from files.  One listing for each folder."""
    spark, folders = df.sparkSession, {}
    for name in df.inputFiles():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
        folders.setdefault(path.getParent().toString(), set()).add(path.getName())
    total = 0
    for folder, names in folders.items():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += sum(s.getLen() for s in store.listStatus(path) if s.getPath().getName() in names)
    return total


def file_parts(df: DataFrame, part_bytes: int = 2 * 1024 * 1024) -> int | None:
    """Partitions for a shuffle of ``df``, so that what one of them holds does not grow with the table: one for every ``part_bytes``
    of the files it is read from.  None where these are fewer than the cores: adaptive execution then finds the number."""
    n = -(-file_bytes(df) // part_bytes)
    return n if n > df.sparkSession.sparkContext.defaultParallelism else None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder of the store."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that must not exist yet: written beside it, then renamed, which fails where the name is taken.

    Of several writers one succeeds on stores whose rename does not replace a file (HDFS; local folders here by an exclusive
    link).  Object stores that replace need a single writer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = store.create(staged, False)
    out.write(text.encode())
    out.close()
    try:
        if store.getScheme() == "file":  # a local rename replaces; a hard link never does
            try:
                os.link(staged.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                raise FileExistsError(f"{path} exists already") from None
        elif store.exists(target) or not store.rename(staged, target):
            raise FileExistsError(f"{path} exists already")
    finally:
        store.delete(staged, False)


# --------------------------------------------------------------------------- failure isolation
STATUS_FAILED = "FAILED"


def _norm_path(c: Column) -> Column:
    """file:/x, file:///x and /x name the same file."""
    return F.regexp_replace(c, r"^file:(//)?", "file:")


def footer_rows(files: DataFrame) -> DataFrame:
    """``(path, footer_rows)``: the row count each Parquet footer declares, null where it cannot be read."""
    def run(batches):
        for batch in batches:
            counts = []
            for path in batch.column(0).to_pylist():
                try:
                    store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                    with store.open_input_file(place) as f:
                        counts.append(pq.ParquetFile(f).metadata.num_rows)
                except (OSError, pa.ArrowException):
                    counts.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["path", "footer_rows"])
    return files.select("path").mapInArrow(run, "path string, footer_rows long")


#: Types that hold every value of the ones before them.
_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def wider_type(a: str, b: str) -> str:
    """The narrowest type that holds every value of both: whole numbers widen, single precision and whole numbers of up to
    32 bits widen to double, and what has no common number type becomes text."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {a, b} <= {"tinyint", "smallint", "int", "float", "double"}:
        return "double"
    if {a, b} == {"date", "timestamp"}:
        return "timestamp"
    return "string"


def file_schemas(files: DataFrame) -> DataFrame:
    """``(path, fields)``: each Parquet file's columns as ``[(name, type)]``, from its footer; files are read by many tasks."""
    simple = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double",
              "bool": "boolean", "string": "string", "large_string": "string", "binary": "binary", "date32[day]": "date"}

    def kind(t: pa.DataType) -> str:
        if pa.types.is_timestamp(t):
            return "timestamp" if t.tz else "timestamp_ntz"
        if pa.types.is_decimal(t):
            return f"decimal({t.precision},{t.scale})"
        if str(t) not in simple:
            raise TypeError(f"columns of type {t} are not widened")
        return simple[str(t)]

    def run(batches):
        for batch in batches:
            fields = []
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with store.open_input_file(place) as f:
                    fields.append([{"name": c.name, "type": kind(c.type)} for c in pq.ParquetFile(f).schema_arrow])
            shape = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fields, shape)], names=["path", "fields"])
    return files.select("path").mapInArrow(run, "path string, fields array<struct<name: string, type: string>>")


def read_widened(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Parquet files whose columns changed type or came later, as one table without loss.

    Files are grouped by their own schema; each group is read as it is and cast to the common wider types; a column that a
    group lacks is null there.  (``mergeSchema`` stops at a column that was a number and is text now.)"""
    groups = file_schemas(file_inventory(spark, root, glob)).groupBy("fields").agg(F.collect_list("path").alias("paths")).collect()  # file names
    types: dict[str, str] = {}
    for g in groups:
        for f in g["fields"]:
            types[f["name"]] = wider_type(types[f["name"]], f["type"]) if f["name"] in types else f["type"]
    parts = []
    for g in sorted(groups, key=lambda g: str(g["fields"])):
        own = spark.read.schema(", ".join(f"`{f['name']}` {f['type']}" for f in g["fields"])).parquet(*g["paths"])
        parts.append(own.select(*[F.col(f"`{f['name']}`").cast(types[f["name"]]).alias(f["name"]) for f in g["fields"]]))
    if not parts:
        raise ValueError(f"no files under {root}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_isolating_failures(spark: SparkSession, root: str, run_id: str, fmt: str = "parquet",
                            glob: str = "*.parquet", schema: T.StructType | str | None = None
                            ) -> tuple[DataFrame, DataFrame]:
    """Read every file under ``root``; a corrupt file does not stop the
    job, and is *not* silent: the returned ledger marks it FAILED.

    Returns (data, ledger).  Corrupt files are skipped by the reader
    (``ignoreCorruptFiles``), which may come after some of their rows; so the rows
    each file delivered are held against its footer.  Fewer, or no readable footer, is FAILED, and
    none of that file's rows are in the data; a valid empty file is SUCCESS.  Formats without
    a footer are FAILED when a file with bytes gives no row.  The data keeps the source path in ``_source_file``."""
    inv = file_inventory(spark, root, glob)
    reader = (spark.read.format(fmt).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    # without a declared schema, infer it from every readable footer (a corrupt
    # first file must not decide the schema)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    data = reader.load(root).withColumn("_source_file", F.col("_metadata.file_path"))
    # the hash of all columns makes the count read every page; a count alone is answered by the footers
    given = data.groupBy(_norm_path(F.col("_source_file")).alias("__p")).agg(
        F.count(F.lit(1)).alias("__given"), F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in data.columns])).alias("__h")) \
        .filter(F.col("__h").isNotNull())
    files = inv.join(footer_rows(inv), "path") if fmt == "parquet" else inv.withColumn(
        "footer_rows", F.when(F.col("size_bytes") == 0, F.lit(0).cast("long")).otherwise(-1))
    files = files.join(given, _norm_path(files["path"]) == given["__p"], "left")
    got = F.coalesce("__given", F.lit(0))
    whole = F.when(F.col("footer_rows") >= 0, got == F.col("footer_rows")).otherwise(F.col("footer_rows").isNotNull() & (got > 0))
    status = F.when(whole, F.lit(STATUS_SUCCESS)).otherwise(F.lit(STATUS_FAILED))
    ledger = files.select("path", F.col("year").cast("int"), F.col("month").cast("int"), "size_bytes",
                          F.col("modification_time").cast("timestamp"), status.alias("status"),
                          F.lit(run_id).alias("run_id"), F.current_timestamp().alias("landed_at"))
    failed = files.filter(status == STATUS_FAILED).select(_norm_path(F.col("path")).alias("__f"))
    return data.join(failed, _norm_path(F.col("_source_file")) == F.col("__f"), "left_anti"), ledger
