"""M01–M05 change patterns on small literal tables."""
import datetime as dt

import pytest

from tablecheck.operators import change as C

SCHEMA = "k int, a string, b int"


def test_merge_update_insert_delete(spark):
    t = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", 3)], SCHEMA)
    s = spark.createDataFrame([(2, "Y", 20), (4, "w", 4)], SCHEMA)
    out = C.merge(t, s, ["k"], update_cols=["b"], delete_missing=True)
    assert sorted(tuple(r) for r in out.collect()) == [(2, "y", 20), (4, "w", 4)]
    out = C.merge(t, s, ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 1), (2, "Y", 20), (3, "z", 3), (4, "w", 4)]


def test_merge_duplicate_source_key_raises(spark):
    t = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA)
    with pytest.raises(ValueError):
        C.merge(t, s, ["k"])


def test_upsert_and_cdc(spark):
    t = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], SCHEMA)
    ch = spark.createDataFrame([(1, "x1", 1, "U", 1), (1, "x2", 1, "U", 2), (2, "y", 2, "D", 1),
                                (3, "n", 3, "I", 1)], SCHEMA + ", op string, seq int")
    out = C.cdc_apply(t, ch, ["k"], order_cols=["seq"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x2", 1), (3, "n", 3)]
    up = C.upsert(t, spark.createDataFrame([(2, "Y", 9)], SCHEMA), ["k"])
    assert sorted(tuple(r) for r in up.collect()) == [(1, "x", 1), (2, "Y", 9)]


def test_flatten_cdc_nested_images(spark):
    recs = spark.createDataFrame(
        [(("U", "t", dt.datetime(2024, 1, 1)), (1, "old"), (1, "new")),
         (("D", "t", dt.datetime(2024, 1, 2)), (2, "gone"), None)],
        "metadata struct<operation:string,`table-name`:string,timestamp:timestamp>, "
        "`before-image` struct<k:int,a:string>, `after-image` struct<k:int,a:string>")
    flat = C.flatten_cdc(recs, "k")
    assert sorted((r["op"], r["k"], r["a"]) for r in flat.collect()) == [("D", 2, "gone"), ("U", 1, "new")]


def test_scd2_and_scd3(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    dim = spark.createDataFrame([(1, "x", t0, None, True), (2, "y", t0, None, True)],
                                "k int, a string, effective_from timestamp, effective_to timestamp, is_current boolean")
    snap = spark.createDataFrame([(1, "x"), (2, "Y"), (3, "z")], "k int, a string")
    out = C.scd2(dim, snap, ["k"], ["a"], t1)
    got = sorted((r["k"], r["a"], r["effective_to"], r["is_current"]) for r in out.collect())
    assert got == [(1, "x", None, True), (2, "Y", None, True), (2, "y", t1, False), (3, "z", None, True)]
    d3 = spark.createDataFrame([(1, "x", None)], "k int, a string, prev_a string")
    out = C.scd3(d3, spark.createDataFrame([(1, "y")], "k int, a string"), ["k"], "a", "prev_a")
    assert tuple(out.first()) == (1, "y", "x")


def test_repeated_keys_are_rejected_or_resolved(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, v string, seq int")
    staging = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "k int, v string, seq int")
    with pytest.raises(ValueError):
        C.upsert(target, staging, ["k"])
    assert [tuple(r) for r in C.upsert(target, staging, ["k"], ["seq"]).collect()] == [(1, "c", 2)]
    dim = spark.sql("SELECT 1 AS k, 'a' AS v, DATE'2020-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, true AS is_current")
    with pytest.raises(ValueError):
        C.scd2(dim, staging, ["k"], ["v"], "2024-01-01")
