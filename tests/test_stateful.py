"""T05, T07 and T09 as streams with state, against plain scans; sums of values as they are (T03, T04, T06, A04, W12-W15); medians."""
import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import patterns as P
from tablecheck.streaming import stateful as ST
from tablecheck.streaming import stream as S

BASE = dt.datetime(2024, 1, 1)


def _events(seed, n, hot=0.34):
    """``(k, t, e)``: one key of a third of all events, ties, gaps around the limits; times in whole milliseconds."""
    rng = random.Random(seed)
    rows, clock = [], {}
    for e in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        step = rng.choice([0, 0, 1, 7, 60, 299, 300, 301, 1799, 1800, 1801, 4000]) + rng.choice([0, 0.001, 0.25])
        clock[k] = clock.get(k, 0) + step
        rows.append((k, BASE + dt.timedelta(seconds=clock[k]), e))
    return rows


def _source(spark, tmp_dir, rows, steps, seed=0, disorder=0):
    """One file a step; events come in time order but for ``disorder`` seconds."""
    rng = random.Random(seed)
    rows = sorted(rows, key=lambda r: (r[1] + dt.timedelta(seconds=rng.uniform(0, disorder)), r[2]))
    src = os.path.join(tmp_dir, "src")
    schema = "k string, ts timestamp, e long"
    for i in range(steps):
        spark.createDataFrame(rows[i * len(rows) // steps:(i + 1) * len(rows) // steps], schema).coalesce(1).write.mode("append").parquet(src)
    return S.file_stream(spark, src, schema, max_files_per_trigger=1)


def _collect(df, tmp_dir, name):
    out = os.path.join(tmp_dir, name)
    S.run_available_now(df, f"{out}-ckpt", out)
    return df.sparkSession.read.schema(df.schema).parquet(out).collect()


def _pieces(rows, gap, most):
    """Sessions and pieces by a plain scan of each key."""
    out = []
    for k in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == k)
        start = last = None
        for t in times:
            if last is None or (t - last).total_seconds() > gap:
                start = t
            piece = int((t - start).total_seconds() // most)
            if out and out[-1][:3] == [k, start, piece]:
                out[-1][4:] = [t, out[-1][5] + 1]
            else:
                out.append([k, start, piece, t, t, 1])
            last = t
    return out


@pytest.mark.parametrize("steps, disorder", [(1, 0), (5, 1500)])
def test_t07_pieces_equal_a_plain_scan(spark, tmp_dir, steps, disorder):
    rows = _events(1, 1500)
    stream = _source(spark, tmp_dir, rows, steps, disorder=disorder)
    got = _collect(ST.sessions_max_duration_stream(stream, "ts", "k", 1800, 7200, "30 minutes"), tmp_dir, "out")
    mark = max(r[1] for r in rows) - dt.timedelta(minutes=30)
    want = _pieces([r for r in rows if r[1] <= mark], 1800, 7200)
    last = {k: max(p[4] for p in want if p[0] == k) for k in {p[0] for p in want}}
    want = [p for p in want if p[4] < last[p[0]] or p[4] + dt.timedelta(seconds=1800) < mark]
    assert sorted((r["k"] or "", r["piece_start"], r["piece_end"], r["n_events"]) for r in got) == sorted((p[0] or "", *p[3:]) for p in want)
    assert len(got) > 100


def test_t07_a_long_session_is_one_row_of_state(spark, tmp_dir):
    rows = [("k", BASE + dt.timedelta(seconds=20 * i), i) for i in range(6000)] + [("k", BASE + dt.timedelta(days=9), -1)]
    stream = _source(spark, tmp_dir, rows, 4)
    pieces = ST.sessions_max_duration_stream(stream, "ts", "k", 1800, 3600, "1 minute")
    seen = []

    def sink(batch, batch_id):
        seen.extend(batch.collect())
    q = S.run_available_now(pieces, os.path.join(tmp_dir, "ckpt"), sink)
    assert sum(r["n_events"] for r in seen) == 6000 and len(seen) == math.ceil(6000 * 20 / 3600)
    kept = [max(o["numRowsTotal"] for o in p["stateOperators"] if "transform" in o["operatorName"].lower()) for p in q.recentProgress if p["stateOperators"]]
    assert kept and max(kept) <= 4  # the session's row and its timer, not its events


@pytest.mark.parametrize("steps, disorder, bucket", [(5, 1500, None), (4, 1500, 300)])
def test_t05_counts_equal_a_plain_scan(spark, tmp_dir, steps, disorder, bucket):
    rows = _events(2, 1200)
    stream = _source(spark, tmp_dir, rows, steps, disorder=disorder)
    counts = ST.sliding_count_stream(stream, "ts", "k", 300, "30 minutes", "n", ["e"], bucket_seconds=bucket)
    got = _collect(counts, tmp_dir, "out")
    mark = max(r[1] for r in rows) - dt.timedelta(minutes=30)
    span = dt.timedelta(seconds=300)
    want = [(k, t, e, sum(k2 == k and t - span <= t2 <= t for k2, t2, _ in rows)) for k, t, e in rows if t <= mark]
    order = lambda rs: sorted((r[0] or "", *r[1:]) for r in rs)
    assert order(got) == order(want)


def test_t05_many_keys_are_few_groups(spark, tmp_dir):
    big = 2**53 + 1  # no float has it
    rows = [(k, BASE + dt.timedelta(seconds=s), big + 2 * k + s // 60) for k in range(400) for s in (0, 60)] + [(-1, BASE + dt.timedelta(days=1), 0)]
    rows += [(None, BASE + dt.timedelta(seconds=s), big - s) for s in (3, 5)]  # null is one key, and the others stay whole numbers beside it
    path = os.path.join(tmp_dir, "many")
    spark.createDataFrame(rows, "k long, ts timestamp, e long").coalesce(1).write.parquet(path)
    counts = ST.sliding_count_stream(S.file_stream(spark, path, "k long, ts timestamp, e long"), "ts", "k", 300, "1 minute", "n", ["e"], groups=3)
    seen = []
    q = S.run_available_now(counts, os.path.join(tmp_dir, "ckpt"), lambda batch, _: seen.extend(batch.collect()))
    want = [(k, big + 2 * k + i, i + 1) for k in range(400) for i in (0, 1)] + [(None, big - 3, 1), (None, big - 5, 2)]
    assert sorted((r["k"] or -9, r["e"], r["n"]) for r in seen) == sorted((k or -9, *r) for k, *r in want)
    kept = [o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"] if "transform" in o["operatorName"].lower()]
    assert kept and max(kept) <= 6  # a value and a timer for each group, not for each key


def test_t05_repeats_without_carried_columns(spark, tmp_dir):
    rows = [("k", BASE, 1), ("k", BASE, 2), ("k", BASE + dt.timedelta(seconds=300), 3), ("k", BASE + dt.timedelta(seconds=301), 4), ("z", BASE + dt.timedelta(days=1), 5)]
    got = _collect(ST.sliding_count_stream(_source(spark, tmp_dir, rows, 2), "ts", "k", 300, "0 seconds", "n"), tmp_dir, "out")
    assert sorted((r["k"], r["n"]) for r in got) == [("k", 2), ("k", 2), ("k", 2), ("k", 3), ("z", 1)]


def test_t09_three_destinations_and_replays(spark, tmp_dir):
    path = os.path.join(tmp_dir, "late")
    df = lambda *t: spark.createDataFrame([(f"2024-01-01 {x}",) for x in t], "t string").selectExpr("cast(t as timestamp) ts")
    sink = S.late_router(path, "ts", 300, 600, 300)  # watermark of batch 1: 10:13; oldest open window: 10:10
    batches = [df("10:18:00"), df("10:13:00", "10:12:59", "10:09:00", "10:03:00", "10:02:59", "10:30:00"), df("10:25:00", "10:24:59")]
    for i in (0, 1, 2, 1, 2):
        sink(batches[i], i)
    got = sorted((r["destination"], r["original_ts"].strftime("%H:%M:%S"), r["ts"].strftime("%H:%M:%S")) for r in spark.read.parquet(f"{path}/rows").collect())
    assert got == [("adjusted", "10:03:00", "10:10:00"), ("adjusted", "10:09:00", "10:10:00"), ("adjusted", "10:12:59", "10:12:59"), ("adjusted", "10:24:59", "10:25:00"),
                   ("dead_letter", "10:02:59", "10:02:59"), ("on_time", "10:13:00", "10:13:00"), ("on_time", "10:18:00", "10:18:00"), ("on_time", "10:25:00", "10:25:00"), ("on_time", "10:30:00", "10:30:00")]
    with pytest.raises(ValueError):
        S.late_router(path, "ts", 300, 600)


def test_sums_keep_small_and_large_values(spark):
    small = [(BASE + dt.timedelta(seconds=i), "a", 0.004) for i in range(1000)]
    df = spark.createDataFrame(small + [(BASE, "b", 2e17), (BASE, "b", 1.0)], "ts timestamp, k string, v double")
    for out in (S.tumbling_agg(df, "ts", "1 hour", ["k"], "v"), S.hopping_agg(df, "ts", "2 hours", "1 hour", ["k"], "v"),
                S.session_agg(df, "ts", "1 hour", ["k"], "v"), S.sessions_batch(df, "ts", ["k"], 3600, "v")):
        sums = {r["k"]: r["sum_value"] for r in out.collect()}
        assert sums["a"] == pytest.approx(4.0, abs=1e-9) and sums["b"] == 2e17 + 1.0
    total = {r["k"]: r["total"] for r in P.periodic_totals(df, "ts", F.col("v"), "month", ["k"]).collect()}
    assert total["a"] == pytest.approx(4.0, abs=1e-9) and total["b"] == 2e17 + 1.0
    for out in (S.tumbling_agg(df, "ts", "1 hour", ["k"], "v", scale=4), S.sessions_batch(df, "ts", ["k"], 3600, "v", scale=4)):
        assert {r["k"]: str(r["sum_value"]) for r in out.collect()} == {"a": "4.0000", "b": "200000000000000001.0000"}
    exact = P.periodic_totals(df, "ts", F.col("v"), "month", ["k"], scale=3).collect()
    assert {r["k"]: str(r["total"]) for r in exact} == {"a": "4.000", "b": "200000000000000001.000"}


@pytest.mark.parametrize("values, median", [([1.0, 2.0, math.inf, math.nan], math.inf), ([math.nan, 1.0, 2.0], 2.0), ([-math.inf, 5.0, 1e300, -1e300], 2.5 - 5e299), ([math.nan], math.nan), ([3.0, 4.0], 3.5)])
def test_median_of_infinities_and_nan(spark, values, median):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = P.exact_median(df, ["g"], "v", 10.0).first()["median"]
    assert got == median or (math.isnan(median) and math.isnan(got))
