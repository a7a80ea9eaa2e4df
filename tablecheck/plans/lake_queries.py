"""Landing, run-mode and change/merge queries.

Landing queries treat ``orders`` as the month-partitioned source (year/month
of ``o_orderdate``); "today" is injected (``AS_OF``) so results are stable.
Change queries derive a deterministic change set from ``customer``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablecheck.operators import change as C
from tablecheck.plans.fixtures import table
from tablecheck.plans.registry import query
from tablecheck.sources import ingest as I

AS_OF = dt.date(2001, 6, 15)
AS_OF_EMPTY_YEAR = dt.date(2002, 3, 1)
BASE_YEAR = 1999
_YM = "year(o_orderdate) AS year, month(o_orderdate) AS month"


def _orders_parts(spark, sf):
    return I.with_month_partitions(table(spark, sf, "orders"), "o_orderdate")


def _latest_sql(y, m):
    return (f"WITH p AS (SELECT DISTINCT {_YM} FROM orders), "
            f"c AS (SELECT max({{'y': year, 'm': month}}) AS b FROM p WHERE (year = {y} AND month <= {m}) "
            f"OR year = {y - 1}) SELECT coalesce(b.y, {y - 1}) AS latest_year, coalesce(b.m, 1) AS latest_month FROM c")


@query("latest_month", "S06", _latest_sql(AS_OF.year, AS_OF.month))
def latest_month(spark, sf):
    return I.latest_available_month(_orders_parts(spark, sf).select("year", "month"), AS_OF)


@query("latest_month_fallback", "S06", _latest_sql(AS_OF_EMPTY_YEAR.year, AS_OF_EMPTY_YEAR.month))
def latest_month_fallback(spark, sf):
    """No data in the current year: newest month of the previous year."""
    return I.latest_available_month(_orders_parts(spark, sf).select("year", "month"), AS_OF_EMPTY_YEAR)


def _mode_rows(spark, sf, mode, y, m):
    o = table(spark, sf, "orders")
    return I.with_month_partitions(o.filter(I.run_mode_range(o, "o_orderdate", mode, y, m, BASE_YEAR)), "o_orderdate")


def _latest(spark, sf, as_of):
    row = I.latest_available_month(_orders_parts(spark, sf).select("year", "month"), as_of).first()
    return row["latest_year"], row["latest_month"]


@query("month_range", "S01",
       f"SELECT {_YM}, count(*) AS n_rows FROM orders WHERE (year(o_orderdate) * 12 + month(o_orderdate) - 1) "
       "BETWEEN 1997 * 12 + 10 AND 1997 * 12 + 13 GROUP BY 1, 2")
def month_range(spark, sf):
    """Four months from 1997-11 (rolling over December): a half-open range of order dates, pushed to the scan."""
    o = table(spark, sf, "orders")
    return I.with_month_partitions(o.filter(I.month_range_predicate(o, "o_orderdate", 1997, 11, 4)), "o_orderdate") \
        .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("current_slice", "S07",
       f"SELECT {_YM}, count(*) AS n_rows FROM orders WHERE year(o_orderdate) = 2001 AND month(o_orderdate) = 6 "
       "GROUP BY 1, 2")
def current_slice(spark, sf):
    y, m = _latest(spark, sf, AS_OF)
    return _mode_rows(spark, sf, "current", y, m) \
        .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("historical_slice", ("S07", "M12"),
       f"SELECT {_YM}, count(*) AS n_rows FROM orders WHERE year(o_orderdate) * 12 + month(o_orderdate) - 1 "
       f"BETWEEN {BASE_YEAR} * 12 AND 2001 * 12 + 4 GROUP BY 1, 2")
def historical_slice(spark, sf):
    """Base year January up to the month before the latest (all years between)."""
    y, m = _latest(spark, sf, AS_OF)
    return _mode_rows(spark, sf, "historical", y, m) \
        .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("done_marker", ("S09", "G12"),
       f"WITH p AS (SELECT DISTINCT {_YM} FROM orders WHERE year(o_orderdate) * 12 + month(o_orderdate) - 1 "
       f"BETWEEN {BASE_YEAR} * 12 AND 2001 * 12 + 4) "
       "SELECT '2001-06-15T00:00:00' AS ingestion_date, 'run-1' AS job_run_id, 0.0 AS total_size_gb, "
       "CAST(0 AS BIGINT) AS publication_delay_months, 'historical' AS job_type, "
       "CASE WHEN count(*) = 0 THEN 'unknown' ELSE lpad(CAST(min({'y': year, 'm': month}).y AS VARCHAR), 4, '0') "
       "|| '-' || lpad(CAST(min({'y': year, 'm': month}).m AS VARCHAR), 2, '0') END AS data_period, "
       "['fhvhv'] AS taxi_types, count(*) AS total_files, '2001-06' AS latest_available_month, "
       "CAST(0 AS BIGINT) AS duplicate_files_skipped, "
       "CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) < 29 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM p")
def done_marker(spark, sf):
    """Done marker aggregated from the landed month partitions of a historical run."""
    y, m = _latest(spark, sf, AS_OF)
    landed = _mode_rows(spark, sf, "historical", y, m) \
        .select("year", "month").distinct()
    n_expected = I.run_mode_window("historical", y, m, BASE_YEAR)[0][2]
    return I.done_marker(landed, "historical", "run-1", y, m, ["fhvhv"], size_col=None,
                         ingestion_time=dt.datetime(2001, 6, 15), expected_months=n_expected)


@query("size_report", "S08")
def size_report(spark, sf):
    """Per-file MB and total GB of the source files (metadata only; rows-only check)."""
    inv = I.file_inventory(spark, sf)
    return I.size_report(inv)


@query("incremental_load", ("S22", "M06"),
       "SELECT count(*) AS n_rows, max(o_orderdate) AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def incremental_load(spark, sf):
    """Rows newer than the stored watermark, and the next watermark."""
    o = table(spark, sf, "orders")
    new = I.incremental_since(o, "o_orderdate", "2000-01-01 00:00:00")
    return new.agg(F.count(F.lit(1)).alias("n_rows"), F.max("o_orderdate").alias("watermark"))


@query("union_types", "S02",
       "SELECT trip_type, count(*) AS n_rows, count(l_linenumber) AS n_with_line FROM ("
       "SELECT o_orderkey AS k, NULL AS l_linenumber, 'orders' AS trip_type FROM orders UNION ALL "
       "SELECT l_orderkey, l_linenumber, 'lineitem' FROM lineitem) GROUP BY trip_type")
def union_types(spark, sf):
    """Sources with drifting schemas unioned by name with a literal type column."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    u = I.union_types({"orders": o, "lineitem": li})
    return u.groupBy("trip_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count("l_linenumber").alias("n_with_line"))


# =========================================================================== change / merge
_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_C = ", ".join(_CUST)
_STAGING_SQL = ("(SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, 'UPDATED' AS c_mktsegment "
                "FROM customer WHERE c_custkey % 10 = 0 UNION ALL "
                "SELECT c_custkey + 10000000, c_name || '-new', c_nationkey, c_acctbal, c_mktsegment "
                "FROM customer WHERE c_custkey % 25 = 0)")


def _staging(spark, sf):
    c = table(spark, sf, "customer")
    upd = c.filter(F.col("c_custkey") % 10 == 0).select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 100).alias("c_acctbal"),
        F.lit("UPDATED").alias("c_mktsegment"))
    new = c.filter(F.col("c_custkey") % 25 == 0).select(
        (F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.concat("c_name", F.lit("-new")).alias("c_name"),
        "c_nationkey", "c_acctbal", "c_mktsegment")
    return upd.unionByName(new)


@query("upsert", ("M01", "M02", "M05"),
       f"SELECT {_C} FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {_STAGING_SQL} s WHERE s.c_custkey = c.c_custkey) "
       f"UNION ALL SELECT {_C} FROM {_STAGING_SQL}")
def upsert(spark, sf):
    """Delete-matching + insert-all (= MERGE update-all/insert-all = SCD type 1)."""
    return C.upsert(table(spark, sf, "customer"), _staging(spark, sf), ["c_custkey"])


@query("merge_full", "M03",
       f"WITH s AS (SELECT * FROM {_STAGING_SQL} UNION ALL SELECT {_C} FROM customer WHERE c_custkey % 10 <> 0 "
       "AND c_custkey % 7 <> 0) "
       "SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, "
       "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE s.c_name END AS c_name, "
       "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey, "
       "CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, "
       "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment "
       "FROM customer t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey WHERE s.c_custkey IS NOT NULL")
def merge_full(spark, sf):
    """MERGE: update c_acctbal when matched, insert new, delete rows missing from the source."""
    c = table(spark, sf, "customer")
    src = _staging(spark, sf).unionByName(
        c.filter((F.col("c_custkey") % 10 != 0) & (F.col("c_custkey") % 7 != 0)).select(*_CUST))
    return C.merge(c, src, ["c_custkey"], update_cols=["c_acctbal"], delete_missing=True)


_CHANGES_SQL = ("(SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, 'U' AS op, "
                "1 AS seq FROM customer WHERE c_custkey % 10 = 0 UNION ALL "
                "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 2, c_mktsegment, 'U', 2 FROM customer "
                "WHERE c_custkey % 10 = 0 UNION ALL "
                "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'D', 3 FROM customer "
                "WHERE c_custkey % 15 = 0 UNION ALL "
                "SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment, 'I', 1 FROM customer "
                "WHERE c_custkey % 25 = 0)")


def _changes(spark, sf):
    c = table(spark, sf, "customer")
    u1 = c.filter(F.col("c_custkey") % 10 == 0).withColumn("c_acctbal", F.col("c_acctbal") + 1) \
        .withColumn("op", F.lit("U")).withColumn("seq", F.lit(1))
    u2 = c.filter(F.col("c_custkey") % 10 == 0).withColumn("c_acctbal", F.col("c_acctbal") + 2) \
        .withColumn("op", F.lit("U")).withColumn("seq", F.lit(2))
    d = c.filter(F.col("c_custkey") % 15 == 0).withColumn("op", F.lit("D")).withColumn("seq", F.lit(3))
    i = c.filter(F.col("c_custkey") % 25 == 0).withColumn("c_custkey", F.col("c_custkey") + 10_000_000) \
        .withColumn("op", F.lit("I")).withColumn("seq", F.lit(1))
    return u1.unionByName(u2).unionByName(d).unionByName(i)


@query("cdc_apply", "M04",
       f"WITH ch AS {_CHANGES_SQL}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey "
       "ORDER BY seq DESC) AS rn FROM ch) WHERE rn = 1) "
       f"SELECT {_C} FROM customer c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.c_custkey = c.c_custkey) "
       f"UNION ALL SELECT {_C} FROM l WHERE op <> 'D'")
def cdc_apply(spark, sf):
    """Latest change per key (by sequence) applied: D deletes, I/U upsert."""
    return C.cdc_apply(table(spark, sf, "customer"), _changes(spark, sf), ["c_custkey"], order_cols=["seq"])


_DIM0 = "TIMESTAMP '1990-01-01 00:00:00'"
_LOAD = "TIMESTAMP '2024-01-01 00:00:00'"
_SNAP_SQL = ("(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 100 "
             "ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 15 <> 0 UNION ALL "
             "SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer "
             "WHERE c_custkey % 25 = 0)")


def _snapshot(spark, sf):
    c = table(spark, sf, "customer")
    kept = c.filter(F.col("c_custkey") % 15 != 0).withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
    new = c.filter(F.col("c_custkey") % 25 == 0).withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    return kept.unionByName(new)


@query("scd2", "M05",
       f"WITH d AS (SELECT {_C} FROM customer), s AS {_SNAP_SQL} "
       f"SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment, {_DIM0} AS effective_from, "
       f"CASE WHEN s.c_custkey IS NOT NULL AND (s.c_acctbal <> d.c_acctbal OR s.c_name <> d.c_name "
       f"OR s.c_mktsegment <> d.c_mktsegment OR s.c_nationkey <> d.c_nationkey) THEN {_LOAD} END AS effective_to, "
       f"NOT (s.c_custkey IS NOT NULL AND (s.c_acctbal <> d.c_acctbal OR s.c_name <> d.c_name "
       f"OR s.c_mktsegment <> d.c_mktsegment OR s.c_nationkey <> d.c_nationkey)) AS is_current "
       f"FROM d LEFT JOIN s ON d.c_custkey = s.c_custkey "
       f"UNION ALL SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment, {_LOAD}, "
       f"CAST(NULL AS TIMESTAMP), true FROM s LEFT JOIN d ON d.c_custkey = s.c_custkey WHERE d.c_custkey IS NULL "
       f"OR s.c_acctbal <> d.c_acctbal OR s.c_name <> d.c_name OR s.c_mktsegment <> d.c_mktsegment "
       f"OR s.c_nationkey <> d.c_nationkey")
def scd2(spark, sf):
    """SCD type 2: changed rows closed and re-opened at the load time, new keys opened."""
    dim = table(spark, sf, "customer").select(
        *_CUST, F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"))
    return C.scd2(dim, _snapshot(spark, sf), ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                  "2024-01-01 00:00:00")


@query("scd3", "M05",
       f"SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, "
       "CASE WHEN c.c_custkey % 10 = 0 THEN 'UPDATED' ELSE c.c_mktsegment END AS c_mktsegment, "
       "CASE WHEN c.c_custkey % 10 = 0 THEN c.c_mktsegment ELSE NULL END AS prev_mktsegment FROM customer c")
def scd3(spark, sf):
    """SCD type 3: the previous segment kept in its own column."""
    dim = table(spark, sf, "customer").withColumn("prev_mktsegment", F.lit(None).cast("string"))
    upd = _staging(spark, sf).filter(F.col("c_custkey") < 10_000_000)
    return C.scd3(dim, upd, ["c_custkey"], "c_mktsegment", "prev_mktsegment")


@query("lambda_view", "M13",
       "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1")
def lambda_view(spark, sf):
    """Serving view: batch layer up to the cut + speed layer after it (= full daily counts).
    The layers overlap by a year, so the view has to cut both."""
    o = table(spark, sf, "orders")
    batch = o.filter(F.col("o_orderdate") <= F.lit("1999-07-01 00:00:00").cast("timestamp_ntz"))
    speed = o.filter(F.col("o_orderdate") > F.lit("1998-07-01 00:00:00").cast("timestamp_ntz"))
    served = C.lambda_view(batch, speed, "o_orderdate", "1999-01-01 00:00:00")
    return served.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))


# =========================================================================== versioned tables, evolution, projection
def _scratch(spark, name):
    import uuid
    from tablecheck.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _versions(spark, sf):
    from tablecheck.sources.versions import VersionedTable
    vt = VersionedTable(spark, _scratch(spark, "vt"))
    base = table(spark, sf, "customer")
    vt.publish(base, operation="LOAD")
    vt.publish(C.upsert(vt.read(), _staging(spark, sf), ["c_custkey"]), operation="MERGE",
               validate=lambda staged: not staged.isEmpty())
    return vt


@query("time_travel", ("M09", "M10"), f"SELECT {_C} FROM customer")
def time_travel(spark, sf):
    """Stage -> validate -> publish two versions; read version 0 back."""
    return _versions(spark, sf).read(version=0)


@query("version_latest", ("M09", "M10", "M01"),
       f"SELECT {_C} FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {_STAGING_SQL} s WHERE s.c_custkey = c.c_custkey) "
       f"UNION ALL SELECT {_C} FROM {_STAGING_SQL}")
def version_latest(spark, sf):
    """The latest published version (the merged state)."""
    return _versions(spark, sf).read()


@query("schema_evolution", ("M11", "S20"),
       "SELECT count(*) AS n_rows, count(CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END) AS n_status FROM orders")
def schema_evolution(spark, sf):
    """Two appends with different schemas read back with mergeSchema."""
    path = _scratch(spark, "evolve")
    o = table(spark, sf, "orders")
    o.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_custkey").write.mode("append").parquet(path)
    o.filter(F.col("o_orderkey") % 2 == 1).select("o_orderkey", "o_custkey", "o_orderstatus") \
        .write.mode("append").parquet(path)
    back = spark.read.option("mergeSchema", "true").parquet(path)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count("o_orderstatus").alias("n_status"))


@query("partition_projection", ("S18", "S01", "S20", "M12"),
       f"SELECT {_YM}, count(*) AS n_rows FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 3, 4) "
       "GROUP BY 1, 2")
def partition_projection(spark, sf):
    """Land six months as year=/month= partitions (twice: idempotent), then
    read three of them by explicit partition paths (no full listing)."""
    from tablecheck.sources.readers import read_month_range
    root = _scratch(spark, "landed")
    parts = _orders_parts(spark, sf)
    I.land(parts, root, I.months_predicate(1997, 1, 6))
    I.land(parts, root, I.months_predicate(1997, 1, 6))
    back = read_month_range(spark, root, I.month_sequence(spark, 1997, 2, 3))
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("query_in_place", ("S16", "S15"),
       "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def query_in_place(spark, sf):
    """SQL directly over the Parquet file (no table registration)."""
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n_orders FROM parquet.`{sf.rstrip('/')}/orders.parquet` "
                     "GROUP BY o_orderstatus")


@query("reference_csv", ("S05", "S26"), "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def reference_csv(spark, sf):
    """A lookup landed as CSV with a header, read back with an explicit schema."""
    path = _scratch(spark, "zones-csv")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    return I.read_reference_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("master_items", ("S13", "A03"),
       "SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal > 0")
def master_items(spark, sf):
    """Active master items: main filter, fallback only when it selects nothing."""
    from tablecheck.sources.readers import master_items as items
    return items(table(spark, sf, "customer"), "c_mktsegment", where="c_acctbal > 1e12",
                 fallback_where="c_acctbal > 0")


@query("generic_ingest", ("S24", "S26"),
       "SELECT 'orders' AS source_name, count(*) AS n_rows FROM orders UNION ALL "
       "SELECT 'customer', count(*) FROM customer")
def generic_ingest(spark, sf):
    """Metadata-driven ingest: one config row per source (format, target,
    partition columns); each source is an ordinary read/write job."""
    root = _scratch(spark, "generic")
    cfg = spark.createDataFrame(
        [("orders", "parquet", f"{sf}/orders.parquet", f"{root}/orders", ["o_orderstatus"]),
         ("customer", "parquet", f"{sf}/customer.parquet", f"{root}/customer", [])],
        "source_name string, file_format string, source_url string, target_prefix string, partition_cols array<string>")
    done = I.generic_ingest(spark, cfg)
    parts = [spark.read.parquet(f"{root}/{n}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("source_name"), "n_rows") for n in done]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("new_files", "S03")
def new_files(spark, sf):
    """Files not yet in the ledger (anti join on path) — metadata only; rows-only check."""
    inv = I.file_inventory(spark, sf)
    ledger = I.ledger_rows(inv.filter(F.col("path").rlike("(orders|customer)\\.parquet$")), "run-0")
    return I.new_files(inv, ledger)
