"""Batch twins of the streaming operators (T03–T10, T13) over ``events``.

The same functions run on a streaming DataFrame (see tests/test_streaming.py,
which replays ``events`` as files and compares closed windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecheck.operators import rules as R
from tablecheck.operators.evaluate import evaluate
from tablecheck.plans.fixtures import table
from tablecheck.plans.registry import query
from tablecheck.streaming import stateful
from tablecheck.streaming import stream as S

#: Values have two decimals, so a sum shown with two is the same in any order of rows.
_SUM = "round(sum(value), 2) AS sum_value"


def _events(spark, sf):
    return table(spark, sf, "events")


def _shown(df):
    return df.withColumn("sum_value", F.round("sum_value", 2))


@query("tumbling", "T03",
       "SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, "
       "time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end, event_type, "
       f"count(*) AS n_events, {_SUM} FROM events GROUP BY 1, 2, 3")
def tumbling(spark, sf):
    return _shown(S.tumbling_agg(_events(spark, sf), "ts", "5 minutes", ["event_type"], "value"))


@query("hopping", "T04",
       "WITH m AS (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS b, event_type, value FROM events "
       "UNION ALL SELECT time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL 5 MINUTES, event_type, value FROM events) "
       f"SELECT b AS window_start, b + INTERVAL 10 MINUTES AS window_end, event_type, count(*) AS n_events, {_SUM} "
       "FROM m GROUP BY 1, 2, 3")
def hopping(spark, sf):
    return _shown(S.hopping_agg(_events(spark, sf), "ts", "10 minutes", "5 minutes", ["event_type"], "value"))


_SESS = ("WITH e AS (SELECT user_id, ts, value, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL "
         "OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS nw "
         "FROM events), s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED "
         "PRECEDING AND CURRENT ROW) AS sid FROM e) ")


@query("session", "T06",
       _SESS + "SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, user_id, "
       f"count(*) AS n_events, {_SUM} FROM s GROUP BY user_id, sid")
def session(spark, sf):
    """Gap sessions per user; batch form stitched from per-day fragments, so a
    very active user is not one task (streams use ``session_window``)."""
    return _shown(S.sessions_batch(_events(spark, sf), "ts", ["user_id"], 1800, "value"))


@query("session_window_builtin", "T06", _SESS + "SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS "
       f"session_end, user_id, count(*) AS n_events, {_SUM} FROM s GROUP BY user_id, sid")
def session_window_builtin(spark, sf):
    """The same sessions with Spark's ``session_window`` (the streaming form)."""
    return _shown(S.session_agg(_events(spark, sf), "ts", "30 minutes", ["user_id"], "value"))


@query("session_max", "T07",
       "WITH e AS (SELECT event_type, ts, epoch_us(ts) AS t, CASE WHEN lag(ts) OVER (PARTITION BY event_type "
       "ORDER BY ts) IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts)) "
       "> 1800000000 THEN 1 ELSE 0 END AS nw FROM events), "
       "s AS (SELECT *, sum(nw) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING "
       "AND CURRENT ROW) AS sid FROM e), "
       "p AS (SELECT *, floor((t - min(t) OVER (PARTITION BY event_type, sid)) / 7200000000) AS piece FROM s) "
       "SELECT event_type, min(ts) AS piece_start, max(ts) AS piece_end, count(*) AS n_events FROM p "
       "GROUP BY event_type, sid, piece")
def session_max(spark, sf):
    """Gap 30 min sessions per event type, split at 2 h from the session start."""
    return S.sessions_max_duration(_events(spark, sf), "ts", ["event_type"], 1800, 7200)


_REPLAY = ("(SELECT event_id, ts, user_id, event_type, value FROM events UNION ALL "
           "SELECT event_id, ts + INTERVAL 1 MINUTE, user_id, event_type, value FROM events WHERE event_id % 7 = 0)")


@query("dedup_stream", ("T10", "W02"),
       f"SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
       f"ORDER BY ts) AS rn FROM {_REPLAY}) WHERE rn = 1")
def dedup_stream(spark, sf):
    """Replayed deliveries (same event id, later arrival time) removed, first kept."""
    e = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    replay = e.filter(F.col("event_id") % 7 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    return S.keep_first(e.unionByName(replay), ["event_id"], "ts")


_ARRIVAL = "(event_id // (SELECT max(event_id) // 20 + 1 FROM events)) + CASE WHEN event_id % 13 = 0 THEN 2 ELSE 0 END"


@query("late_split", ("T08", "T09"),
       f"WITH a AS (SELECT event_id, ts, {_ARRIVAL} AS batch FROM events), "
       "b AS (SELECT batch, max(ts) AS bmax FROM a GROUP BY batch), "
       "w AS (SELECT batch, max(bmax) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
       "- INTERVAL 300 SECONDS AS wm FROM b) "
       "SELECT CASE WHEN coalesce(a.ts < w.wm, false) THEN 'dead_letter' ELSE 'on_time' END AS destination, "
       "count(*) AS n_rows FROM a JOIN w ON a.batch = w.batch GROUP BY 1")
def late_split(spark, sf):
    """Out-of-order arrival (every 13th event two micro-batches late); rows
    older than the watermark (max event time of earlier batches - 5 min) are
    routed to the dead-letter table."""
    e = _events(spark, sf).select("event_id", "ts")
    size = e.agg(F.floor(F.max("event_id") / 20) + 1).scalar()
    batch = F.floor(F.col("event_id") / size).cast("long") + F.when(F.col("event_id") % 13 == 0, 2).otherwise(0)
    flagged = S.late_split_batch(e.withColumn("batch", batch), "ts", "batch", 300)
    return flagged.groupBy(F.when(F.col("is_late"), "dead_letter").otherwise("on_time").alias("destination")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


@query("expectations", ("Q27", "Q28", "T13"),
       "SELECT event_type, count(*) AS n_rows FROM events WHERE event_type IN ('click', 'view', 'purchase') "
       "GROUP BY event_type")
def expectations(spark, sf):
    """Expectations: warn on value <= 1 (kept), drop unknown event types."""
    rules = [R.expectation("value_above_one", "value > 1", R.REPORT),
             R.expectation("known_type", F.col("event_type").isin("click", "view", "purchase"), R.DROP)]
    ok = evaluate(_events(spark, sf), rules).ok
    return ok.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("expectation_warnings", ("Q28", "T13"),
       "SELECT 'object' AS object_name, 'value_above_one' AS check_passed, 'value_above_one' AS check_column_name, "
       "CAST(NULL AS VARCHAR) AS check_column_value, 'WARNING' AS error_type, CAST(NULL AS VARCHAR) AS idpipeline, "
       "event_id FROM events WHERE NOT coalesce(value > 1, false)")
def expectation_warnings(spark, sf):
    rules = [R.expectation("value_above_one", "value > 1", R.REPORT),
             R.expectation("known_type", F.col("event_type").isin("click", "view", "purchase"), R.DROP)]
    return evaluate(_events(spark, sf), rules, with_json=False, extra_cols=["event_id"]).fail


@query("bronze_silver_gold", ("T14", "T13", "T03"),
       "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR "
       "AS window_end, event_type, count(*) AS n_events, " + _SUM +
       " FROM events WHERE event_type IN ('click', 'view', 'purchase') AND value IS NOT NULL GROUP BY 1, 2, 3")
def bronze_silver_gold(spark, sf):
    """Bronze (raw) -> silver (expectations: drop unknown types / missing values)
    -> gold (hourly aggregates); each hop a plain function, same on streams."""
    bronze = _events(spark, sf)
    rules = [R.expectation("known_type", F.col("event_type").isin("click", "view", "purchase"), R.DROP),
             R.expectation("has_value", F.col("value").isNotNull(), R.DROP)]
    silver = evaluate(bronze, rules).ok
    return _shown(S.tumbling_agg(silver, "ts", "1 hour", ["event_type"], "value"))


@query("json_body", "T02",
       "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_body(spark, sf):
    """Message bodies (JSON text) parsed to typed columns with a declared schema."""
    return S.parse_json_body(_events(spark, sf), "k bigint", body_col="props", keep=["event_id"])


# =========================================================================== real streaming runs
def _scratch(spark, name):
    import uuid
    from tablecheck.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _stage_events(spark, sf, df=None):
    """Write events (in any order, by any number of tasks) to a fresh folder: the stream's source."""
    root = _scratch(spark, "events-src")
    e = S.event_time(_events(spark, sf) if df is None else df, "ts")
    e.write.parquet(root)
    return root, e.schema


_CLOSED = ("WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, event_type, count(*) AS n_events, "
           f"{_SUM} FROM events GROUP BY 1, 2) SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, "
           "event_type, n_events, sum_value FROM w WHERE window_start + INTERVAL 5 MINUTES <= "
           "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTES")


@query("stream_tumbling", ("T01", "T03", "T08", "T12"), _CLOSED)
def stream_tumbling(spark, sf):
    """A real Structured Streaming run: file source (available-now trigger,
    checkpoint), 10-minute watermark, append mode -> closed windows only, into files.
    The files hold no event-time order, so all that is available is one micro-batch: the watermark
    moves after it and drops nothing."""
    src, schema = _stage_events(spark, sf)
    agg = S.tumbling_agg(S.file_stream(spark, src, schema), "ts", "5 minutes", ["event_type"], "value", watermark="10 minutes")
    out = _scratch(spark, "tumbling")
    S.run_available_now(agg, f"{out}-ckpt", out)
    return _shown(spark.read.schema(agg.schema).parquet(out)).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n_events", "sum_value")


@query("stream_complete", ("T12", "T15"), "SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type")
def stream_complete(spark, sf):
    """Complete mode: every trigger's whole result replaces the one before (idempotent under replay)."""
    src, schema = _stage_events(spark, sf)
    counts = S.file_stream(spark, src, schema, max_files_per_trigger=2).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    out = _scratch(spark, "complete")
    S.run_available_now(counts, f"{out}-ckpt", lambda df, _: df.write.mode("overwrite").parquet(out), "complete")
    return spark.read.parquet(out)


@query("stream_update", ("T12", "T11"), "SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type")
def stream_update(spark, sf):
    """Update mode: each trigger emits the changed groups; the newest row per group is the state."""
    src, schema = _stage_events(spark, sf)
    counts = S.file_stream(spark, src, schema, max_files_per_trigger=2).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    out = _scratch(spark, "update")
    S.run_available_now(counts, f"{out}-ckpt", S.change_sink(out, "counts"), "update")
    return S.change_state(spark, out, ["event_type"], [])


@query("stream_fan_out", "T16",
       "SELECT event_type, count(*) AS n_raw, count(*) AS n_counted FROM events GROUP BY event_type")
def stream_fan_out(spark, sf):
    """One stream, two sinks: the raw audit copy and the aggregate of each micro-batch."""
    src, schema = _stage_events(spark, sf)
    raw, agg = _scratch(spark, "raw"), _scratch(spark, "agg")
    sink = S.fan_out_sink(raw, agg, lambda b: b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    S.run_available_now(S.file_stream(spark, src, schema, max_files_per_trigger=2), f"{raw}-ckpt", sink)
    n = spark.read.parquet(raw).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_raw"))
    return n.join(spark.read.parquet(agg).groupBy("event_type").agg(F.sum("n").alias("n_counted")), "event_type")


@query("stream_session_max", ("T07", "T06"),
       "WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events), "
       "e AS (SELECT event_type, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTES OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS nw "
       "FROM events, m WHERE ts <= mark WINDOW w AS (PARTITION BY event_type ORDER BY ts)), "
       "s AS (SELECT event_type, ts, sum(nw) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e), "
       "f AS (SELECT *, min(ts) OVER (PARTITION BY event_type, sid) AS s0 FROM s), "
       "p AS (SELECT event_type, min(ts) AS piece_start, max(ts) AS piece_end, count(*) AS n_events FROM f "
       "GROUP BY event_type, sid, floor((epoch_us(ts) - epoch_us(s0)) / 7200000000)) "
       "SELECT p.* FROM p, m WHERE piece_end < (SELECT max(piece_end) FROM p q WHERE q.event_type = p.event_type) "
       "OR piece_end + INTERVAL 30 MINUTES < mark")
def stream_session_max(spark, sf):
    """Sessions of at most two hours from a stream whose events come in any order; pieces that the watermark has closed."""
    src, schema = _stage_events(spark, sf, _events(spark, sf).repartition(5))
    out = _scratch(spark, "pieces")
    pieces = stateful.sessions_max_duration_stream(S.file_stream(spark, src, schema), "ts", "event_type", 1800, 7200, "1 hour")
    S.run_available_now(pieces, f"{out}-ckpt", out)
    return spark.read.schema(pieces.schema).parquet(out).select(
        "event_type", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("piece_start", "piece_end")], "n_events")


@query("stream_sliding_count", "T05",
       "SELECT event_id, user_id, ts, n5 FROM (SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id "
       "ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS n5 FROM events) "
       "WHERE n5 > 1 AND ts <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES")
def stream_sliding_count(spark, sf):
    """``sliding_count`` from a stream: events in any order, each user's count at every event that the watermark has passed."""
    src, schema = _stage_events(spark, sf, _events(spark, sf).repartition(5))
    out = _scratch(spark, "sliding")
    counts = stateful.sliding_count_stream(S.file_stream(spark, src, schema), "ts", "user_id", 300, "10 minutes", "n5", ["event_id"]).filter("n5 > 1")
    S.run_available_now(counts, f"{out}-ckpt", out)
    return spark.read.schema(counts.schema).parquet(out).select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "n5")


_ARRIVING = ("WITH a AS (SELECT event_id, ts, event_id // (SELECT max(event_id) // 4 + 1 FROM events) + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS batch FROM events), "
             "b AS (SELECT batch, max(ts) AS bmax FROM a GROUP BY batch), "
             "w AS (SELECT batch, max(bmax) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 300 SECONDS AS wm FROM b) ")


def _arrive(spark, sf, name, router):
    """Events land in five steps, every 13th one step late, and after each step a run routes what is new."""
    e = S.event_time(_events(spark, sf).select("event_id", "ts"), "ts")
    size = e.agg(F.floor(F.max("event_id") / 4) + 1).first()[0]
    batch = F.floor(F.col("event_id") / size) + F.when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    src, out = _scratch(spark, f"{name}-arrivals"), _scratch(spark, name)
    for b in range(5):  # each step is one micro-batch, however many files it has
        e.filter(batch == b).write.mode("append").parquet(src)
        S.run_available_now(S.file_stream(spark, src, e.schema), f"{out}-ckpt", router(out))
    return spark.read.parquet(f"{out}/rows")


@query("stream_late_split", ("T09", "T15"),
       _ARRIVING + "SELECT CASE WHEN coalesce(a.ts < w.wm, false) THEN 'dead_letter' ELSE 'on_time' END AS destination, "
       "count(*) AS n_rows FROM a JOIN w ON a.batch = w.batch GROUP BY 1")
def stream_late_split(spark, sf):
    """A ``foreachBatch`` router sends what is older than the watermark to the dead-letter table."""
    rows = _arrive(spark, sf, "routed", lambda out: S.late_router(out, "ts", 300))
    return rows.groupBy("destination").agg(F.count(F.lit(1)).alias("n_rows"))


@query("stream_late_adjust", ("T09", "T15"),
       _ARRIVING + "SELECT event_id, ts AS original_ts, CASE WHEN ts < wm - INTERVAL 3 DAYS THEN 'dead_letter' WHEN ts < wm THEN 'adjusted' ELSE 'on_time' END AS destination, "
       "CASE WHEN ts < wm AND ts >= wm - INTERVAL 3 DAYS THEN greatest(ts, time_bucket(INTERVAL 5 MINUTES, wm)) ELSE ts END AS ts "
       "FROM a JOIN w ON a.batch = w.batch")
def stream_late_adjust(spark, sf):
    """Late rows of up to three days are moved into the oldest open window and keep their own time; older ones are dead letters."""
    rows = _arrive(spark, sf, "adjusted", lambda out: S.late_router(out, "ts", 300, 3 * 86_400, 300))
    return rows.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("original_ts", "ts")], "destination")


def _change_feed(spark, sf):
    """Every event inserted, every fifth updated, every seventh deleted, in change order ``seq``."""
    e = _events(spark, sf).select("event_id", "ts", "value", F.lit(0).alias("seq"), F.lit(False).alias("deleted"))
    upd = e.filter("event_id % 5 = 0").withColumn("value", F.col("value") * 2).withColumn("seq", F.lit(1))
    gone = e.filter("event_id % 7 = 0").withColumn("seq", F.lit(2)).withColumn("deleted", F.lit(True))
    return e.unionByName(upd).unionByName(gone).repartition(6)


@query("stream_upsert", ("T11", "T15", "M01"),
       "SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN value * 2 ELSE value END AS value FROM events WHERE event_id % 7 <> 0")
def stream_upsert(spark, sf):
    """foreachBatch upsert of a feed with inserts, updates and deletes in any order; then a second query with
    a new checkpoint replays the whole feed.  The state is that of one run."""
    src, schema = _stage_events(spark, sf, _change_feed(spark, sf))
    out = _scratch(spark, "upsert")
    for writer in ("first", "second"):
        stream = S.file_stream(spark, src, schema, max_files_per_trigger=3)
        S.run_available_now(stream, f"{out}-ckpt-{writer}", S.change_sink(out, writer))
    state = S.change_state(spark, out, ["event_id"], ["seq"], "deleted")
    return state.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query("stream_changelog", ("T11", "T15", "M04"), "SELECT event_id, ts, value FROM events")
def stream_changelog(spark, sf):
    """Change folders, one for each micro-batch; a replayed batch overwrites itself, and the read folds newest-per-key."""
    src, schema = _stage_events(spark, sf)
    out = _scratch(spark, "changes")
    sink = S.change_sink(out, "events")

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)
    S.run_available_now(S.file_stream(spark, src, schema, max_files_per_trigger=10).select("event_id", "ts", "value"), f"{out}-ckpt", twice)
    return S.change_state(spark, out, ["event_id"], ["ts"]).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query("bookmarked_job", ("M08", "T01", "M07"), "SELECT event_id, event_type FROM events")
def bookmarked_job(spark, sf):
    """Two runs of one job: the second finds the files added since, by its checkpoint, and reads no old file again."""
    e = S.event_time(_events(spark, sf), "ts").select("event_id", "event_type")
    src, out = _scratch(spark, "bookmark-src"), _scratch(spark, "bookmark")
    for rest in (0, 1):
        e.filter(F.col("event_id") % 2 == rest).write.mode("append").parquet(src)
        S.run_available_now(S.file_stream(spark, src, e.schema), f"{out}-ckpt", out)
    return spark.read.parquet(out)
