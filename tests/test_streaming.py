"""Structured Streaming runs over staged files compared with the batch twins."""
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import rules as R
from tablecheck.operators.evaluate import evaluate
from tablecheck.streaming import stream as S

SF = "/root/testdata/sf0.01"


def _stage(spark, tmp_dir, tasks=1):
    """Events in shuffled order, written by ``tasks`` tasks."""
    src = os.path.join(tmp_dir, "events_src")
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartition(tasks, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("event_id", "ts")).write.parquet(src)
    return src, e.schema, e


def _run(df, tmp_dir, name, mode="append"):
    S.run_available_now(df, os.path.join(tmp_dir, f"ckpt_{name}"), None, mode, fmt="memory", query_name=name)
    return df.sparkSession.table(name)


@pytest.mark.parametrize("tasks", [1, 6])
def test_tumbling_stream_equals_batch_for_closed_windows(spark, tmp_dir, tasks):
    src, schema, e = _stage(spark, tmp_dir, tasks)
    stream = S.file_stream(spark, src, schema)
    out = _run(S.tumbling_agg(stream, "ts", "5 minutes", ["event_type"], "value", "10 minutes", scale=2),
               tmp_dir, f"tumble_out{tasks}")
    batch = S.tumbling_agg(e, "ts", "5 minutes", ["event_type"], "value", scale=2)
    wm = e.agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = batch.filter(F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=10)))
    cols = ["window_start", "window_end", "event_type", "n_events", "sum_value"]
    assert out.count() == closed.count() > 0
    assert out.select(*cols).exceptAll(closed.select(*cols)).count() == 0


def test_dedup_within_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "dup_src")
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    replay = e.filter(F.col("event_id") % 7 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    e.unionByName(replay).write.parquet(src)
    stream = S.file_stream(spark, src, e.schema)
    out = _run(S.dedup_within_watermark(stream, ["event_id"], "ts", "10 minutes"), tmp_dir, "dedup_out")
    assert out.count() == e.count()


def test_expectations_on_a_stream(spark, tmp_dir):
    src, schema, e = _stage(spark, tmp_dir)
    rules = [R.expectation("known_type", F.col("event_type").isin("click", "view"), R.DROP)]
    ok_stream, _ = S.expectations_stream(S.file_stream(spark, src, schema), rules)
    out = _run(ok_stream, tmp_dir, "exp_out")
    assert out.count() == evaluate(e, rules).ok.count()


def test_change_sink_replays_and_new_checkpoints(spark, tmp_dir):
    """A replayed batch counts once; batch 0 of another query neither replaces nor is skipped for it."""
    path = os.path.join(tmp_dir, "changes")
    df = lambda *rows: spark.createDataFrame(rows, "k int, seq int, v string, gone boolean")
    one, two = S.change_sink(path, "one"), S.change_sink(path, "two")
    one(df((1, 0, "a", False), (2, 0, "b", False)), 0)
    one(df((1, 1, "c", False), (3, 1, "d", False)), 1)
    one(df((1, 1, "c", False), (3, 1, "d", False)), 1)
    two(df((2, 2, "b", True), (4, 0, "e", False)), 0)
    state = S.change_state(spark, path, ["k"], ["seq"], "gone")
    assert sorted(map(tuple, state.collect())) == [(1, 1, "c"), (3, 1, "d"), (4, 0, "e")]


def test_folded_changes_give_the_same_state(spark, tmp_dir):
    """A state is the same before and after folding, after a replay of a folded batch, and after further batches."""
    path = os.path.join(tmp_dir, "changes")
    df = lambda *rows: spark.createDataFrame(rows, "k int, v string, gone boolean")
    sink = S.change_sink(path, "one")
    batches = [df(*[(k, f"{b}-{k}", k % 5 == 0 and b == 2) for k in range(b, 40, b + 1)]) for b in range(5)]
    state = lambda: sorted(map(tuple, S.change_state(spark, path, ["k"], [], "gone").collect()))
    for b in range(4):
        sink(batches[b], b)
    before = state()
    assert S.compact_changes(spark, path, ["k"], []) == 4 and state() == before
    assert S.compact_changes(spark, path, ["k"], []) == 0
    sink(batches[1], 1)  # a replay of a folded batch
    assert state() == before
    sink(batches[4], 4)
    after = state()
    assert after != before and S.compact_changes(spark, path, ["k"], []) == 3 and state() == after
    assert S.compact_changes(spark, os.path.join(tmp_dir, "none"), ["k"], []) == 0


def test_late_router_replays_see_the_same_watermark(spark, tmp_dir):
    path = os.path.join(tmp_dir, "late")
    df = lambda *t: spark.createDataFrame([(x,) for x in t], "t string").selectExpr("cast(t as timestamp) ts")
    sink = S.late_router(path, "ts", 300)
    batches = [df("2024-01-01 10:00:00"), df("2024-01-01 10:20:00", "2024-01-01 09:54:00"), df("2024-01-01 10:16:00", "2024-01-01 10:14:00")]
    for i in (0, 1, 2, 1, 2):
        sink(batches[i], i)
    got = {r["destination"]: r["count"] for r in spark.read.parquet(f"{path}/rows").groupBy("destination").count().collect()}
    assert got == {"on_time": 3, "dead_letter": 2}


def test_sessions_on_ntz_ignore_the_session_zone(spark):
    """Two events 58 minutes apart across a missing hour are two sessions for a gap of ten minutes."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT 'a' AS k, TIMESTAMP_NTZ '2024-03-10 02:05:00' AS ts UNION ALL SELECT 'a', TIMESTAMP_NTZ '2024-03-10 03:03:00'")
        assert S.sessions_batch(df, "ts", ["k"], 600).count() == 2 == S.session_agg(df, "ts", "10 minutes", ["k"]).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_json_body(spark):
    df = spark.createDataFrame([('{"trip_id": "t1", "fare_amount": 12.5, "trip_type": "yellow"}',)], "body string")
    out = S.parse_json_body(df, "trip_id string, fare_amount double, trip_type string").first()
    assert tuple(out) == ("t1", 12.5, "yellow")


def _sessions_brute(rows, gap_s):
    """Plain per-key scan: new session when the gap to the previous event is
    larger than ``gap_s``; rows with a null timestamp are in no session."""
    by_key = {}
    for k, ts, v in rows:
        if ts is not None:
            by_key.setdefault(k, []).append((ts, v))
    out = set()
    for k, evs in by_key.items():
        evs.sort(key=lambda e: e[0])
        start, last, n, tot = evs[0][0], evs[0][0], 0, 0.0
        for ts, v in evs:
            if (ts - last).total_seconds() > gap_s:
                out.add((k, start, last, n, round(tot, 6)))
                start, n, tot = ts, 0, 0.0
            last, n, tot = ts, n + 1, tot + v
        out.add((k, start, last, n, round(tot, 6)))
    return out


def test_t06_chunked_sessions_on_a_hot_key_equal_brute_force(spark):
    """One hot key with thousands of short sessions and sessions that
    cross many chunk borders (chunk 10 min, gap 5 min), ties, a null key and
    null timestamps: the chunk-summary stitching equals a per-key scan."""
    import datetime as dt
    import random
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows, t = [], base
    for _ in range(4000):  # hot key: mix of long runs (gaps < 5 min) and breaks
        t += dt.timedelta(seconds=rnd.choice([0, 30, 120, 290, 300, 310, 900, 4000]))
        rows.append(("hot", t, float(rnd.randint(1, 9))))
    for k in ["a", "b", None]:
        t = base
        for _ in range(200):
            t += dt.timedelta(seconds=rnd.choice([10, 200, 299, 301, 3600]))
            rows.append((k, t, 1.0))
    rows += [("hot", None, 5.0), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = S.sessions_batch(df, "ts", ["k"], 300, "v", chunk_seconds=600)
    have = {(r.k, r.session_start, r.session_end - dt.timedelta(seconds=300), r.n_events, round(r.sum_value, 6))
            for r in got.collect()}
    assert got.count() == len(have)
    assert have == _sessions_brute(rows, 300)
    pieces = S.sessions_max_duration(df, "ts", ["k"], 300, 1200, chunk_seconds=600)
    want = {}
    for k, start, last, _, _ in _sessions_brute(rows, 300):
        for kk, ts, _ in rows:
            if kk == k and ts is not None and start <= ts <= last:
                p = want.setdefault((k, start, int((ts - start).total_seconds() // 1200)), [ts, ts, 0])
                p[0], p[1], p[2] = min(p[0], ts), max(p[1], ts), p[2] + 1
    got_p = sorted((r.k or "", r.piece_start, r.piece_end, r.n_events) for r in pieces.collect())
    assert got_p == sorted((k or "", a, b, n) for (k, _, _), (a, b, n) in want.items())
