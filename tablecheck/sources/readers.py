"""Readers, catalog tables and lookup loading.

Thin on purpose: each function is the Spark call a user would write, plus
the guard the reference lacked (errors surface, no SQL built from data,
existence checks without full counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUILTIN_FORMATS = ("parquet", "orc", "json", "csv", "text")


# --------------------------------------------------------------------------- lookups
def load_lookup(spark: SparkSession, query: str, source: str = "spark", jdbc_options: dict | None = None,
                on_empty: str = "none") -> DataFrame | None:
    """A lookup from Spark SQL or a JDBC query.

    Errors propagate (the reference swallowed them, D29).  ``on_empty``:
    'none' returns None for an empty result (checked with ``isEmpty`` — reads
    at most one row), 'keep' returns the empty frame."""
    if source == "spark":
        df = spark.sql(query)
    elif source == "jdbc":
        opts = dict(jdbc_options or {})
        opts["query"] = query
        df = spark.read.format("jdbc").options(**opts).load()
    else:
        raise ValueError("source must be 'spark' or 'jdbc'")
    if on_empty == "none" and df.isEmpty():
        return None
    return df


def master_items(master: DataFrame, column: str, where: str | None = None,
                 fallback_where: str | None = None) -> DataFrame:
    """Distinct active items of a master table (main filter, optional
    different fallback filter used only when the main one selects nothing)."""
    main = master.filter(where) if where else master
    items = main.select(column).distinct()
    if fallback_where and fallback_where != where and items.isEmpty():
        items = master.filter(fallback_where).select(column).distinct()
    return items


def active_master_filters(config: DataFrame, object_name: str, flag_col: str = "filter_in_silver") -> list[dict]:
    """The master-filter rules configured for an object (small config, collected)."""
    rows = config.filter((F.col("object_name") == object_name) & (F.col(flag_col) == 1)).collect()
    return [r.asDict() for r in rows]


# --------------------------------------------------------------------------- reading
def read_table(spark: SparkSession, source: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
               options: dict | None = None) -> DataFrame:
    """Path or catalog table in any available format.

    Delta/Iceberg/Avro need external jars; they are used only when the
    format's data source is on the classpath, otherwise a clear error."""
    if fmt == "table":
        return spark.table(source)
    if fmt not in BUILTIN_FORMATS and not format_available(spark, fmt):
        raise ValueError(f"format {fmt!r} is not available in this Spark installation")
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(source)


def format_available(spark: SparkSession, fmt: str) -> bool:
    """Whether a data source short name resolves (e.g. 'avro', 'delta'):
    resolving a reader for a path that does not exist fails with
    DATA_SOURCE_NOT_FOUND only when the format itself is missing."""
    if fmt in BUILTIN_FORMATS:
        return True
    try:
        spark.read.format(fmt).load("/nonexistent/tablecheck-probe")
    except Exception as e:  # noqa: BLE001
        msg = str(e)
        return "DATA_SOURCE_NOT_FOUND" not in msg and "Failed to find data source" not in msg
    return True


def month_folders(spark: SparkSession, root: str, years: list[int]) -> dict[tuple[int, int], str]:
    """The ``year=/month=`` folders of some years, by number, however the month is written (``1``, ``01``).

    One listing for each year, of folder names only.  Two folders of one month would be read twice: an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root, found = root.rstrip("/"), {}
    for year in sorted(set(years)):
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/year={year}/month=*")
        for status in pattern.getFileSystem(conf).globStatus(pattern) or []:
            name = status.getPath().getName().split("=", 1)[1]
            if not status.isDirectory() or not name.isdigit():
                continue
            if (year, int(name)) in found:
                raise ValueError(f"{root} holds month {year}-{int(name):02d} twice: {found[year, int(name)]} and month={name}")
            found[year, int(name)] = f"month={name}"
    return found


def read_month_range(spark: SparkSession, root: str, months: DataFrame | list[tuple[int, int]],
                     fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """S18 partition projection: read exactly the year=/month= directories of
    a declared range; ``basePath`` keeps year/month as columns.  Folders are matched
    by number (``month=1`` and ``month=01``); months with no directory are skipped."""
    pairs = months if isinstance(months, list) else [(r["year"], r["month"]) for r in months.collect()]
    root = root.rstrip("/")
    folders = month_folders(spark, root, [y for y, _ in pairs])
    existing = [f"{root}/year={y}/{folders[y, m]}" for y, m in pairs if (y, m) in folders]
    r = spark.read.format(fmt).option("basePath", root)
    if schema is not None:
        r = r.schema(schema)
    if not existing:
        if schema is None:
            raise ValueError("no partition of the range exists and no schema was given")
        return spark.createDataFrame([], schema)
    return r.load(existing)


# --------------------------------------------------------------------------- catalog tables
def create_external_table(spark: SparkSession, name: str, location: str, schema_ddl: str,
                          partition_cols: list[str], fmt: str = "parquet", repair: bool = True) -> DataFrame:
    """External partitioned table over existing files; with ``repair`` the
    partitions already on storage are registered (``MSCK REPAIR TABLE``)."""
    parts = ", ".join(partition_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {fmt} PARTITIONED BY ({parts}) "
              f"LOCATION '{location}'")
    if repair:
        try:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        except Exception as e:  # noqa: BLE001 - catalogs without partition management discover on read
            if "not supported" not in str(e).lower() and "NOT_SUPPORTED" not in str(e):
                raise
    return spark.table(name)


def bulk_load(df: DataFrame, table_name: str, mode: str = "append") -> None:
    """Load a frame into an existing table by position (``insertInto``)
    or create it (``saveAsTable``) when it does not exist yet."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table_name):
        df.write.mode(mode).insertInto(table_name)
    else:
        df.write.mode(mode).saveAsTable(table_name)


def bucketed_copy(df: DataFrame, table_name: str, key: str | list[str], n_buckets: int,
                  sort: bool = True) -> DataFrame:
    """Write a bucketed (hash-distributed) table; two tables bucketed the
    same way on the join key join without an exchange (co-located, like a
    distribution key).  Broadcast covers the 'replicate/ALL' style."""
    keys = [key] if isinstance(key, str) else list(key)
    w = df.write.mode("overwrite").bucketBy(n_buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table_name)
    return df.sparkSession.table(table_name)
