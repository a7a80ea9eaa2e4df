"""S01–S09 landing/ledger/marker and M09–M12, G01–G03 versioned tables."""
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.sources import ingest as I
from tablecheck.sources.versions import VersionedTable, bronze_snapshot, cut_lineage, zorder

SF = "/root/testdata/sf0.001"


def test_s01_month_sequence_rolls_over(spark):
    got = [(r["year"], r["month"]) for r in I.month_sequence(spark, 2023, 11, 4).collect()]
    assert got == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_s06_latest_month_rules(spark):
    parts = spark.createDataFrame([(2023, 5), (2023, 9), (2022, 12)], "year int, month int")
    r = I.latest_available_month(parts, dt.date(2024, 3, 1)).first()
    assert (r["latest_year"], r["latest_month"]) == (2023, 9)
    r = I.latest_available_month(parts.limit(0), dt.date(2024, 3, 1)).first()
    assert (r["latest_year"], r["latest_month"]) == (2023, 1)
    parts2 = spark.createDataFrame([(2024, 2), (2024, 5)], "year int, month int")
    r = I.latest_available_month(parts2, dt.date(2024, 3, 1)).first()
    assert (r["latest_year"], r["latest_month"]) == (2024, 2)


def test_s07_run_modes():
    assert I.run_mode_window("current", 2026, 1) == [(2026, 1, 1)]
    # historical: base 2024, latest 2026-01 -> every month 2024-01 .. 2025-12
    assert I.run_mode_window("historical", 2026, 1, 2024) == [(2024, 1, 24)]
    with pytest.raises(ValueError):
        I.run_mode_window("weekly", 2026, 1)


def test_landing_is_idempotent_and_ledger_skips_known_files(spark, tmp_dir):
    o = I.with_month_partitions(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderdate")
    target = os.path.join(tmp_dir, "landed")
    pred = I.months_predicate(1996, 1, 3)
    I.land(o, target, pred)
    I.land(o, target, pred)  # re-run replaces the same partitions
    landed = spark.read.parquet(target)
    assert landed.count() == o.filter(pred).count()
    assert sorted({(r["year"], r["month"]) for r in landed.select("year", "month").collect()}) == \
        [(1996, 1), (1996, 2), (1996, 3)]
    inv = I.file_inventory(spark, target)
    ledger = I.ledger_rows(inv, "run-1")
    assert I.new_files(inv, ledger).count() == 0
    I.land(o, target, I.months_predicate(1996, 4, 1))
    new = I.new_files(I.file_inventory(spark, target), ledger)
    assert {(r["year"], r["month"]) for r in new.collect()} == {(1996, 4)}
    marker = I.done_marker(I.ledger_rows(I.file_inventory(spark, target), "run-2"), "historical", "run-2", 1996, 5,
                           ["fhvhv"], expected_months=4).first()
    assert marker["data_period"] == "1996-01" and marker["status"] == "SUCCESS" and marker["total_files"] >= 4
    rep = I.size_report(inv).collect()
    assert all(r["size_mb"] >= 0 for r in rep)


def test_done_marker_empty(spark):
    empty = spark.createDataFrame([], "year int, month int, size_bytes long")
    m = I.done_marker(empty, "current", "r", 2024, 1, ["fhvhv"]).first()
    assert m["status"] == "EMPTY" and m["data_period"] == "unknown"


def test_versioned_table_publish_time_travel_rollback(spark, tmp_dir):
    vt = VersionedTable(spark, os.path.join(tmp_dir, "vt"))
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    assert vt.publish(df) == 0
    assert vt.publish(df.filter("id < 50")) == 1
    assert vt.read().count() == 50 and vt.read(version=0).count() == 100
    with pytest.raises(ValueError):
        vt.publish(df.limit(0), validate=lambda d: not d.isEmpty())
    assert vt.latest_version() == 1  # rejected version never published
    with pytest.raises(ValueError):
        vt.read(as_of=dt.datetime(2000, 1, 1))  # nothing was published back then
    assert vt.read(as_of=dt.datetime(2100, 1, 1)).count() == 50
    with pytest.raises(Exception, match="exists already"):
        vt.publish(df, version=0)  # a version is never overwritten
    assert vt.read(version=0).count() == 100 and vt.history().count() == 2
    # an unreadable log is an error, not an empty table that the next publish would start over
    with open(os.path.join(tmp_dir, "vt", "versions", "version=1.json"), "wb") as fh:
        fh.write(b"broken")
    with pytest.raises(Exception):
        vt.publish(df)


def test_zorder_keeps_rows(spark):
    df = spark.range(1000).select((F.col("id") % 31).alias("a"), (F.col("id") % 17).alias("b"))
    z = zorder(df, ["a", "b"], 4)
    assert z.exceptAll(df).count() == 0 and z.count() == 1000


def test_snapshots_and_checkpoint(spark):
    """Bronze snapshot persisted and released; lineage cut by a reliable checkpoint."""
    df = spark.range(10)
    with bronze_snapshot(df) as snap:
        assert snap.count() == 10 and snap.storageLevel.useMemory
    assert cut_lineage(df.filter("id > 4")).count() == 5


def test_s04_corrupt_file_is_isolated_and_reported(spark, tmp_dir):
    root = os.path.join(tmp_dir, "src")
    spark.read.parquet(f"{SF}/region.parquet").write.parquet(os.path.join(root, "good"))
    os.makedirs(os.path.join(root, "bad"), exist_ok=True)
    with open(os.path.join(root, "bad", "part-broken.parquet"), "wb") as fh:
        fh.write(b"PAR1 this is not a parquet file PAR1")
    data, ledger = I.read_isolating_failures(spark, root, "run-9")
    assert data.count() == 5
    st = {os.path.basename(r["path"]): r["status"] for r in ledger.collect()}
    assert st["part-broken.parquet"] == "FAILED"
    assert [v for k, v in st.items() if k != "part-broken.parquet"] == ["SUCCESS"] * (len(st) - 1)


def test_s04_damaged_pages_are_failed_not_short(spark, tmp_dir):
    """A file whose pages are damaged gives some rows and then stops: none of them are taken, and the ledger says FAILED.
    A valid file without rows is SUCCESS."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    root = os.path.join(tmp_dir, "src")
    os.makedirs(root)
    for name, lo in (("a", 0), ("b", 100_000)):
        pq.write_table(pa.table({"x": list(range(lo, lo + 100_000))}), f"{root}/{name}.parquet", row_group_size=10_000, compression="snappy")
    pq.write_table(pa.table({"x": pa.array([], pa.int64())}), f"{root}/empty.parquet")
    meta = pq.ParquetFile(f"{root}/b.parquet").metadata
    with open(f"{root}/b.parquet", "r+b") as fh:
        fh.seek(meta.row_group(6).column(0).data_page_offset)
        fh.write(b"\xff" * 400)
    data, ledger = I.read_isolating_failures(spark, root, "run-1", schema="x long")
    st = {os.path.basename(r["path"]): r["status"] for r in ledger.collect()}
    assert st == {"a.parquet": "SUCCESS", "b.parquet": "FAILED", "empty.parquet": "SUCCESS"}
    assert data.agg(F.count("*"), F.max("x")).first() == (100_000, 99_999)


def test_month_ranges_reach_the_scan_and_a_large_month_has_more_files(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    plan = o.filter(I.month_range_predicate(o, "o_orderdate", 1997, 11, 4))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-11-01" in plan and "LessThan(o_orderdate,1998-03-01" in plan
    target = os.path.join(tmp_dir, "landed")
    big = spark.range(0, 400_000, 1, 8).selectExpr("id", "sha2(cast(id as string), 256) AS h", "1996 AS year", "1 AS month")
    small = spark.range(10).selectExpr("id", "'x' AS h", "1996 AS year", "2 AS month")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        spark.conf.set(key, "4m")
        I.land(big.unionAll(small), target)
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{target}/year=1996/month=01/*.parquet")) > 1
    plan = spark.read.parquet(target).filter(I.months_predicate(1996, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert spark.read.parquet(target).filter(I.months_predicate(1996, 2, 1)).count() == 10
    # the same months again, now without rows in February: the old ones go
    I.land(big.limit(5), target, months=[(1996, 1), (1996, 2)])
    assert sorted(r["month"] for r in spark.read.parquet(target).collect()) == [1] * 5


def test_zorder_cuts_a_larger_input_into_more_ranges(spark, tmp_dir):
    from tablecheck.sources.ingest import file_bytes
    src = os.path.join(tmp_dir, "a folder=1%")  # the name of a file is a URI
    spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") % 977).alias("b")).repartition(3).write.parquet(src)
    df = spark.read.parquet(src)
    size = sum(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".parquet"))
    assert file_bytes(df) == size == file_bytes(df.unionAll(df)) and file_bytes(spark.range(3)) == 0
    z = zorder(df, ["a", "b"], 2, partition_bytes=size // 5)
    assert z.rdd.getNumPartitions() in (5, 6) and zorder(df, ["a", "b"], 2).rdd.getNumPartitions() == 2
    assert z.exceptAll(df).count() == 0 and z.count() == 20_000


def test_compaction_into_one_file_moves_no_rows(spark, tmp_dir):
    from tablecheck.sources.versions import compact_files
    small, large, three = (os.path.join(tmp_dir, n) for n in ("small", "large", "three"))
    spark.range(30_000).repartition(20).write.parquet(small)
    used = []
    write = type(spark.range(0).write).parquet
    try:
        type(spark.range(0).write).parquet = lambda w, *a, **k: (used.append(w._df._jdf.queryExecution().executedPlan().toString()), write(w, *a, **k))[1]
        assert compact_files(spark, small, large, 1 << 30) == 1
    finally:
        type(spark.range(0).write).parquet = write
    assert "Coalesce" in used[0] and "Exchange" not in used[0]
    size = sum(os.path.getsize(os.path.join(small, f)) for f in os.listdir(small) if f.endswith(".parquet"))
    assert compact_files(spark, small, three, -(-size // 3)) == 3
    for path, n in ((large, 1), (three, 3)):
        back = spark.read.parquet(path)
        assert sorted(r["id"] for r in back.collect()) == list(range(30_000))
        assert sum(f.endswith(".parquet") for f in os.listdir(path)) == n
