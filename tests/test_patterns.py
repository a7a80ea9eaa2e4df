"""Window/join patterns: golden rows and brute-force equivalence."""
import datetime as dt
import os
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablecheck.operators import patterns as P

SF = "/root/testdata/sf0.001"


def test_w10_vs_w11_frames(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, v int")
    rows_w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    range_w = Window.orderBy("v")
    out = df.select("id", F.sum("v").over(rows_w).alias("r"), F.sum("v").over(range_w).alias("g")).orderBy("id")
    assert [(r["r"], r["g"]) for r in out.collect()] == [(1, 2), (2, 2), (4, 4)]


def test_w19_islands(spark):
    d = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 6), dt.date(2024, 1, 7),
         dt.date(2024, 1, 7)]
    df = spark.createDataFrame([(1, x) for x in d], "u int, d date")
    out = P.islands(df, ["u"], F.col("d")).orderBy("start_period").collect()
    assert [(r["start_period"], r["end_period"], r["length"]) for r in out] == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 3), 3), (dt.date(2024, 1, 6), dt.date(2024, 1, 7), 2)]


def test_band_join_equals_brute_force(spark):
    df = spark.range(400).select(F.col("id").alias("id"), (F.col("id") % 3).alias("g"),
                                 ((F.col("id") * 37) % 101 / 7.0).alias("x"))
    got = P.band_join(df, df, ["g"], "x", 1.5, "id", "id").select("id_a", "id_b")
    a, b = df.alias("a"), df.alias("b")
    exp = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.id") < F.col("b.id")) &
                 (F.abs(F.col("a.x") - F.col("b.x")) <= 1.5)).select(F.col("a.id").alias("id_a"),
                                                                    F.col("b.id").alias("id_b"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_band_join_spreads_pairs_and_keeps_them(spark):
    rows = [(i, "xyz"[i % 3] if i % 17 else None, None if i % 41 == 0 else float("nan") if i % 43 == 0 else (i * 37 % 101 - 50) / 4) for i in range(300)]
    rows += [(i, *rows[i][1:]) for i in range(0, 300, 7)] + [(None, "x", 0.0), (900, "x", 1e9), (901, "x", 1e9 + 1.5)]
    df, again = (spark.createDataFrame(rows, "id long, g string, x double") for _ in range(2))
    pairs = lambda keep: sorted((a[0], b[0], a[2], b[2]) for a in rows for b in rows if a[1] is not None and a[1] == b[1]
                                and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= 1.5 and keep(a[0], b[0]))
    by_id = pairs(lambda a, b: None not in (a, b) and a < b)
    cols = ("id_a", "id_b", "x_a", "x_b")
    twin = P.band_join(df, df, ["g"], "x", 1.5, "id", "id")
    assert sorted(tuple(r) for r in twin.select(*cols).collect()) == by_id
    assert sorted(tuple(r) for r in P.band_join(df, again, ["g"], "x", 1.5, "id", "id").select(*cols).collect()) == by_id
    known = [r for r in P.band_join(df, again, ["g"], "x", 1.5).select(*cols).collect() if None not in (r["id_a"], r["id_b"])]
    assert sorted(tuple(r) for r in known) == pairs(lambda a, b: None not in (a, b))
    assert twin.columns == [c + s for s in ("_a", "_b") for c in df.columns]
    plan = P.band_join(*[spark.read.parquet(f"{SF}/customer.parquet")] * 2, ["c_mktsegment"], "c_acctbal", 100.0, "c_custkey", "c_custkey") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "REPARTITION_BY_NUM" in plan


def test_band_join_of_dense_rows_is_whole_and_small_on_disk(spark, tmp_dir, monkeypatch):
    """Several blocks in one bucket (repeated and null ids, equal values, more tasks than shuffle partitions), and files of less than a byte a pair."""
    rng = random.Random(3)
    rows = [(None if i % 90 == 0 else i - i % 2, "x", rng.choice([1.0, rng.random()])) for i in range(700)]
    df, again = (spark.createDataFrame(rows, "id long, g string, x double") for _ in range(2))
    want = sorted((a[0], b[0], a[2], b[2]) for a in rows for b in rows if None not in (a[0], b[0]) and a[0] < b[0] and abs(a[2] - b[2]) <= 0.75)
    monkeypatch.setattr(P, "BAND_TASK_ROWS", 200)
    for frame in (df, again):
        got = P.band_join(df, frame, ["g"], "x", 0.75, "id", "id").select("id_a", "id_b", "x_a", "x_b")
        assert sorted(tuple(r) for r in got.collect()) == want
    monkeypatch.undo()
    rows = [(i * 37, f"Customer#{i * 37:09d}", "x", round(rng.random() * 3, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, name string, g string, x double").coalesce(1)
    out = P.band_join(df, df, ["g"], "x", 1.5, "id", "id").select("name_a", "name_b", "g_a", "x_a", "x_b")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate inline") < plan.index("Coalesce") < plan.index("SortMergeJoin")  # else a task holds the pairs of a block with all its bucket
    out.write.parquet(f"{tmp_dir}/pairs")
    pairs = spark.read.parquet(f"{tmp_dir}/pairs").count()
    assert pairs == sum(abs(a[3] - b[3]) <= 1.5 for i, a in enumerate(rows) for b in rows[i + 1:])
    size = sum(os.path.getsize(f"{tmp_dir}/pairs/{f}") for f in os.listdir(f"{tmp_dir}/pairs") if f.startswith("part-"))
    assert size / pairs < 1.0


def test_trailing_window_equals_plain_range_window(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, base + dt.timedelta(seconds=i * 37 % 20000), float(i % 11))
                                for i in range(3000)], "id int, ts timestamp, v double")
    got = P.trailing_window(df, "ts", 300, {"s": F.sum("v"), "n": F.count(F.lit(1))}, bucket_seconds=900)
    w = Window.orderBy(F.unix_micros("ts")).rangeBetween(-300_000_000, 0)
    exp = df.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"))
    assert got.count() == 3000
    assert got.exceptAll(exp).count() == 0


def test_salted_join_equals_plain_join(spark):
    big = spark.range(5000).select((F.col("id") % 4).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    got = P.salted_join(big, small, "k", 5, salt_cols=["id"])
    exp = big.join(small, "k")
    assert got.columns.count("k") == 1
    assert got.exceptAll(exp.select(*got.columns)).count() == 0 and got.count() == exp.count()


def test_top_n_plan_has_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), "id")
    out = P.top_n(df, ["g"], [F.col("id").desc()], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString() or \
        "WindowGroupLimit" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 20


@pytest.mark.parametrize("width", [37, 1, 1000])
def test_chunked_windows_equal_plain_windows_on_a_hot_key(spark, width):
    """Value-band chunks of several widths (one value each, one chunk in all)."""
    from tablecheck.operators import chunked as CH
    # key 1 holds ~a third of the rows; a null key is a group too; values tie often;
    # null values form a (first) null chunk
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 97 == 5, F.lit(None)).otherwise(F.col("id") * 7919 % 500).alias("v"),
        F.col("id").alias("tie"))
    chunk = F.floor(F.col("v") / width)
    w_total = Window.partitionBy("k").orderBy("v", "tie")
    w_rank = Window.partitionBy("k").orderBy("v")
    exp = df.select("*", F.row_number().over(w_total).alias("rn"), F.rank().over(w_rank).alias("rnk"),
                    F.dense_rank().over(w_rank).alias("drnk"),
                    F.sum("v").over(w_total.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                    F.sum("v").over(w_rank).alias("rg"),
                    F.lag("v", 1, -1).over(w_total).alias("prev"), F.lead("v", 1, -1).over(w_total).alias("next"),
                    F.ntile(7).over(w_total).alias("nt"))
    got = CH.chunked_rank(df, ["k"], [F.col("v"), F.col("tie")], chunk, order_cols_for_distinct=["v"],
                          rank_order=[F.col("v")])
    got = CH.chunked_running_sum(got, ["k"], [F.col("v"), F.col("tie")], chunk, F.col("v"), "rs", "rows")
    got = CH.chunked_running_sum(got, ["k"], [F.col("v")], chunk, F.col("v"), "rg", "range")
    got = CH.chunked_lag_lead(got, ["k"], ["v", "tie"], chunk, "v", "prev", "next", default=-1)
    got = CH.chunked_ntile(got, ["k"], [F.col("v"), F.col("tie")], chunk, 7, "nt")
    cols = ["k", "v", "tie", "rn", "rnk", "drnk", "rs", "rg", "prev", "next", "nt"]
    got, exp = got.select(*cols), exp.select(*cols)
    assert got.count() == 6000
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_exact_median_equals_the_builtin(spark):
    """Ties, one hot value, nulls, a null group and single rows."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 9)).alias("g"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 4 == 0, 7.5).otherwise(F.col("id") * 7919 % 1000 - 300.25).alias("v"))
    want = df.groupBy("g").agg(F.median("v").alias("m"))
    for width in (1.0, 50.0, 1e6):
        got = P.exact_median(df, ["g"], "v", width, "m")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_join_salts_hot_keys_only(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("b"))
    small = spark.range(3000).selectExpr("id AS k", "id * 2 AS s")
    for how in ("inner", "left"):
        got, want = P.salted_join(big, small, "k", 4, how), big.join(small, "k", how)
        assert got.count() == want.count() == 3000 and got.exceptAll(want.select(*got.columns)).count() == 0
