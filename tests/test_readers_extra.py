"""Readers, catalog tables, co-located joins and more streaming shapes
(S05, S10, S12–S19, S21, S23, S26, J12, M08, T12, T16, G05, G06, Q31)."""
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.operators.reconcile import assert_not_empty, checksum
from tablecheck.sources import ingest as I
from tablecheck.sources import readers as RD
from tablecheck.sources.versions import save_snapshot
from tablecheck.streaming import stream as S

SF = "/root/testdata/sf0.001"


def test_s05_reference_csv_with_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones")
    spark.read.parquet(f"{SF}/nation.parquet").write.option("header", True).csv(path)
    z = I.read_reference_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    assert z.count() == 25 and dict(z.dtypes)["n_nationkey"] == "int"


def test_s10_s21_s23_snapshot_ctas_view(spark):
    snap, n = save_snapshot(spark.read.parquet(f"{SF}/region.parquet"), "silver_region")
    assert n == 5 and snap.count() == 5
    spark.sql("CREATE TABLE region_ctas USING parquet AS SELECT r_regionkey, upper(r_name) AS r_name FROM silver_region")
    t = spark.table("region_ctas")
    assert t.count() == 5
    t.groupBy().count().createOrReplaceTempView("v_region_summary")
    assert spark.table("v_region_summary").first()[0] == 5
    RD.bulk_load(t, "region_ctas")  # S19: insertInto an existing table
    assert spark.table("region_ctas").count() == 10


def test_s12_s13_s14_lookup_loading(spark):
    spark.read.parquet(f"{SF}/customer.parquet").createOrReplaceTempView("cust_master")
    assert RD.load_lookup(spark, "SELECT c_custkey FROM cust_master WHERE c_acctbal < -100000") is None
    lk = RD.load_lookup(spark, "SELECT c_custkey FROM cust_master WHERE c_acctbal < 0")
    assert lk.count() > 0
    with pytest.raises(Exception):
        RD.load_lookup(spark, "SELECT nope FROM cust_master")  # errors surface (no silent None)
    items = RD.master_items(spark.table("cust_master"), "c_mktsegment", where="c_acctbal > 1e9",
                            fallback_where="c_acctbal > 0")
    assert items.count() == 5
    cfg = spark.createDataFrame([("orders", 1), ("orders", 0), ("other", 1)], "object_name string, filter_in_silver int")
    assert len(RD.active_master_filters(cfg, "orders")) == 1


def test_s17_s18_external_table_and_projection(spark, tmp_dir):
    o = I.with_month_partitions(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderdate")
    root = os.path.join(tmp_dir, "land")
    I.land(o, root, I.months_predicate(1996, 1, 3))
    ddl = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
           "o_orderdate timestamp_ntz, o_orderpriority string, year int, month int")
    t = RD.create_external_table(spark, "ext_orders_t", root, ddl, ["year", "month"])
    assert t.count() == o.filter(I.months_predicate(1996, 1, 3)).count()
    r = RD.read_month_range(spark, root, [(1996, 2), (1996, 9)])
    assert {(x["year"], x["month"]) for x in r.select("year", "month").distinct().collect()} == {(1996, 2)}


def test_s26_formats(spark, tmp_dir):
    df = spark.read.parquet(f"{SF}/region.parquet")
    for fmt in ("orc", "json"):
        p = os.path.join(tmp_dir, fmt)
        df.write.format(fmt).save(p)
        assert RD.read_table(spark, p, fmt, schema=df.schema).count() == 5
    if not RD.format_available(spark, "avro"):
        with pytest.raises(ValueError):
            RD.read_table(spark, "/x", "avro")


def test_j12_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = RD.bucketed_copy(spark.read.parquet(f"{SF}/orders.parquet"), "orders_b", "o_custkey", 8)
        c = RD.bucketed_copy(spark.read.parquet(f"{SF}/customer.parquet")
                             .withColumnRenamed("c_custkey", "o_custkey"), "customer_b", "o_custkey", 8)
        j = o.join(c, "o_custkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.count() == 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_g05_g06_q31_q32(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert df.repartition(4, "l_orderkey").rdd.getNumPartitions() == 4
    assert df.repartition(4).coalesce(2).rdd.getNumPartitions() == 2
    cached = df.cache()
    assert cached.count() == 6000 and cached.is_cached
    cached.unpersist()
    with pytest.raises(ValueError):
        assert_not_empty(df.limit(0), "silver")
    a, b = checksum(df).first(), checksum(df.orderBy("l_partkey")).first()
    assert a == b  # order-insensitive


def _events_dir(spark, tmp_dir, name="ev"):
    src = os.path.join(tmp_dir, name)
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.withColumn("day", F.dayofmonth("ts")).write.partitionBy("day").parquet(src)
    return src, e


def test_t12_complete_and_update_modes(spark, tmp_dir):
    src, e = _events_dir(spark, tmp_dir)
    counts = S.file_stream(spark, src, e.schema).groupBy("event_type").count()
    S.run_available_now(counts, os.path.join(tmp_dir, "c1"), None, "complete", fmt="memory", query_name="cnt_c")
    got = {r["event_type"]: r["count"] for r in spark.table("cnt_c").collect()}
    assert got == {r["event_type"]: r["count"] for r in e.groupBy("event_type").count().collect()}
    S.run_available_now(counts, os.path.join(tmp_dir, "c2"), None, "update", fmt="memory", query_name="cnt_u")
    assert spark.table("cnt_u").count() >= len(got)


def test_m08_bookmark_picks_up_only_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "book")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.filter("event_id < 500").write.parquet(os.path.join(src, "a"))
    ck, out = os.path.join(tmp_dir, "ck_book"), os.path.join(tmp_dir, "out_book")
    S.run_available_now(S.file_stream(spark, src + "/*", e.schema), ck, out)
    assert spark.read.parquet(out).count() == 500
    e.filter("event_id >= 500").write.parquet(os.path.join(src, "b"))  # a late file arrives
    S.run_available_now(S.file_stream(spark, src + "/*", e.schema), ck, out)
    assert spark.read.parquet(out).count() == e.count()  # old files not re-read


def test_t16_fan_out(spark, tmp_dir):
    src, e = _events_dir(spark, tmp_dir, "fan")
    raw, agg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "agg")
    sink = S.fan_out_sink(raw, agg, lambda b: b.groupBy("event_type").count())
    S.run_available_now(S.file_stream(spark, src, e.schema), os.path.join(tmp_dir, "ck_fan"), sink)
    assert spark.read.parquet(raw).count() == e.count()
    assert spark.read.parquet(agg).agg(F.sum("count")).first()[0] == e.count()
