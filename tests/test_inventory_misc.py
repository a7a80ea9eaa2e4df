"""File inventory, size report, new-file detection, sketches, summaries,
empty guards and compaction (S03, S08, O03, G01)."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.operators.reconcile import assert_not_empty
from tablecheck.sources import ingest as I
from tablecheck.sources.versions import compact_files

SF = "/root/testdata/sf0.001"


def test_s08_inventory_sizes_and_total_match_the_file_system(spark):
    inv = I.file_inventory(spark, SF)
    sizes = {r["path"].replace("file:", ""): r["size_bytes"] for r in inv.collect()}
    want = {p: os.path.getsize(p) for p in glob.glob(f"{SF}/*.parquet")}
    assert {os.path.realpath(p): v for p, v in sizes.items()} == {os.path.realpath(p): v for p, v in want.items()}
    rep = I.size_report(inv).collect()
    assert {r["total_gb"] for r in rep} == {round(sum(want.values()) / 1024 ** 3, 2)}
    assert all(r["size_mb"] == round(sizes[r["path"].replace("file:", "")] / 1024 ** 2, 1) for r in rep)


def test_s03_m07_new_files_skip_landed_and_are_idempotent(spark):
    inv = I.file_inventory(spark, SF)
    n = inv.count()
    some = I.ledger_rows(inv.filter(F.col("path").rlike("(orders|customer)\\.parquet$")), "run-1")
    fresh = I.new_files(inv, some)
    assert fresh.count() == n - 2
    assert not fresh.filter(F.col("path").rlike("(orders|customer)\\.parquet$")).count()
    # a FAILED ledger row does not count as landed; after landing everything nothing is new
    failed = I.ledger_rows(inv.filter(F.col("path").endswith("region.parquet")), "run-2", "FAILED")
    assert I.new_files(inv, some.unionByName(failed)).count() == n - 2
    assert I.new_files(inv, I.ledger_rows(inv, "run-3")).count() == 0


def test_o03_q31_empty_guard_reads_one_row(spark):
    df = spark.read.parquet(f"{SF}/region.parquet")
    assert_not_empty(df, "region")
    with pytest.raises(ValueError, match="empty"):
        assert_not_empty(df.filter(F.lit(False)), "nothing")


def test_g01_compaction(spark, tmp_dir):
    small, large = os.path.join(tmp_dir, "small"), os.path.join(tmp_dir, "large")
    src = spark.read.parquet(f"{SF}/orders.parquet")
    src.repartition(6).write.parquet(small)
    assert compact_files(spark, small, large, 1 << 30) == 1
    assert len(glob.glob(os.path.join(large, "*.parquet"))) == 1
    back = spark.read.parquet(large)
    assert back.exceptAll(src).count() == 0 and back.count() == src.count()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        compact_files(spark, small, large)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace
    from tablecheck.session import checkpoint_dir, is_one_machine
    assert is_one_machine("local[8]") and is_one_machine("local") and not is_one_machine("local-cluster[2,1,1024]")
    conf = SimpleNamespace(get=lambda *a: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
