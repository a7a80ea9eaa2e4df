"""Streaming operators (T01–T16) with batch twins.

Windowed aggregates use ``window``/``session_window`` + ``withWatermark``, so
Spark keeps one partial aggregate per open window in the state store and
evicts it when the watermark passes (bounded state).  Sessions with a maximum
duration (T07) and counts per event (T05) as streams are in ``stateful``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck import functions as tf
from tablecheck.operators.chunked import with_join_keys
from tablecheck.operators.evaluate import evaluate
from tablecheck.operators.rules import Rule


# --------------------------------------------------------------------------- sources
def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file source (new files only; progress in the checkpoint)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def parse_json_body(df: DataFrame, schema: T.StructType | str, body_col: str = "body",
                    keep: list[str] | None = None) -> DataFrame:
    """Broker message body (binary or text JSON) -> typed columns."""
    parsed = F.from_json(F.col(body_col).cast("string"), schema).alias("__p")
    return df.select(*(keep or []), parsed).select(*(keep or []), "__p.*")


def event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); cast in place."""
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df


# --------------------------------------------------------------------------- windowed aggregates
def _measure_aggs(value_col: str | None, scale: int | None = None) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value_col:
        aggs.append(F.sum(tf.summand(F.col(value_col), scale)).alias("sum_value"))
    return aggs


def _flatten_window(df: DataFrame, wcol: str) -> DataFrame:
    cols = [c for c in df.columns if c != wcol]
    return df.select(F.col(f"{wcol}.start").alias("window_start"), F.col(f"{wcol}.end").alias("window_end"), *cols)


def tumbling_agg(df: DataFrame, ts_col: str, size: str, keys: list[str], value_col: str | None = None,
                 watermark: str | None = None, scale: int | None = None) -> DataFrame:
    """Fixed, non-overlapping windows per key (count, sum of the values as they are; ``scale``: exact decimal sum)."""
    if watermark:
        df = event_time(df, ts_col).withWatermark(ts_col, watermark)
    g = df.groupBy(F.window(ts_col, size).alias("w"), *keys).agg(*_measure_aggs(value_col, scale))
    return _flatten_window(g, "w")


def hopping_agg(df: DataFrame, ts_col: str, size: str, slide: str, keys: list[str],
                value_col: str | None = None, watermark: str | None = None, scale: int | None = None) -> DataFrame:
    """Overlapping windows (size, slide); each event counts in size/slide windows."""
    if watermark:
        df = event_time(df, ts_col).withWatermark(ts_col, watermark)
    g = df.groupBy(F.window(ts_col, size, slide).alias("w"), *keys).agg(*_measure_aggs(value_col, scale))
    return _flatten_window(g, "w")


def session_agg(df: DataFrame, ts_col: str, gap: str, keys: list[str], value_col: str | None = None,
                watermark: str | None = None, scale: int | None = None) -> DataFrame:
    """Gap-based sessions per key; a new session starts when the gap to the
    previous event is larger than ``gap``.  session_end = last event + gap."""
    if watermark:
        df = event_time(df, ts_col).withWatermark(ts_col, watermark)
    g = df.groupBy(F.session_window(ts_col, gap).alias("w"), *keys).agg(*_measure_aggs(value_col, scale))
    return _flatten_window(g, "w").withColumnRenamed("window_start", "session_start") \
        .withColumnRenamed("window_end", "session_end")


def _session_buckets(df: DataFrame, ts_col: str, keys: list[str], gap_seconds: int, chunk_seconds: int,
                     value_col: str | None = None, scale: int | None = None) -> DataFrame:
    """Gap sessions from per-(key, gap bucket) partial aggregates.

    Time is cut into buckets as wide as the gap: events inside one bucket are
    never split by a gap, so a bucket's (first, last, count, sum) decides the
    sessions — a plain aggregate with map-side combine, so the shuffle carries
    at most one row per (key, bucket) however many events there are.  Buckets
    are grouped into chunks; inside a chunk only the *first* session fragment
    can continue a session from an earlier chunk (later fragments follow an
    in-chunk gap), so the cross-chunk stitching needs one summary row per
    (key, chunk).  Every window is bounded by time span (buckets per chunk,
    chunks per key), never by a hot key's event count.  Returns one row per
    (key, bucket) with ``__s0``, the start (µs) of its session.  Rows with a
    null timestamp belong to no session (as with ``session_window``).
    """
    gap_us = gap_seconds * 1_000_000
    per_chunk = max(1, chunk_seconds // gap_seconds)
    t = tf.micros(df, ts_col)
    aggs = [F.min("__t").alias("__lo"), F.max("__t").alias("__hi"), F.count(F.lit(1)).alias("__n"),
            F.min(ts_col).alias("__lo_ts"), F.max(ts_col).alias("__hi_ts")]  # in the input's own type
    if value_col:
        aggs.append(F.sum(tf.summand(F.col(value_col), scale)).alias("__v"))
    bk = df.select(*keys, ts_col, *([value_col] if value_col else []), t.alias("__t")) \
        .filter(F.col("__t").isNotNull()).withColumn("__b", F.floor(F.col("__t") / gap_us)) \
        .groupBy(*keys, "__b").agg(*aggs)
    bk, nk = with_join_keys(bk, keys)
    bk = bk.withColumn("__c", F.floor(F.col("__b") / per_chunk))
    w = Window.partitionBy(*nk, "__c").orderBy("__b")
    prev_hi = F.lag("__hi").over(w)
    # start (µs) of the bucket's fragment: the latest bucket that follows a gap
    mark = F.when(prev_hi.isNull() | ((F.col("__lo") - prev_hi) > gap_us), F.col("__lo"))
    bk = bk.withColumn("__lfs", F.max(mark).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    summ = bk.groupBy(*nk, "__c").agg(F.min("__lo").alias("__fs0"), F.max("__lfs").alias("__fsl"),
                                      F.max("__hi").alias("__fel"))
    ws = Window.partitionBy(*nk).orderBy("__c")
    p_fel, p_fsl, p_fs0 = F.lag("__fel").over(ws), F.lag("__fsl").over(ws), F.lag("__fs0").over(ws)
    cont = p_fel.isNotNull() & ((F.col("__fs0") - p_fel) <= gap_us)
    # A chain of continuing chunks restarts where the previous chunk's last
    # fragment began a session of its own (it had an in-chunk gap).
    summ = summ.withColumn("__head", F.when(~cont, F.col("__fs0")).when(p_fsl > p_fs0, p_fsl))
    summ = summ.withColumn("__s", F.last("__head", ignorenulls=True)
                           .over(ws.rowsBetween(Window.unboundedPreceding, 0)))
    summ = summ.select(*[F.col(c).alias(f"__j{c}") for c in nk + ["__c"]], "__fs0", "__s")
    cond = [bk[c] == summ[f"__j{c}"] for c in nk + ["__c"]]
    out = bk.join(summ, reduce(lambda a, b: a & b, cond), "inner")
    out = out.withColumn("__s0", F.when(F.col("__lfs") == F.col("__fs0"), F.col("__s")).otherwise(F.col("__lfs")))
    return out.drop(*[f"__j{c}" for c in nk + ["__c"]], *nk, "__fs0", "__s", "__lfs", "__c")


def sessions_batch(df: DataFrame, ts_col: str, keys: list[str], gap_seconds: int, value_col: str | None = None,
                   chunk_seconds: int = 86400, scale: int | None = None) -> DataFrame:
    """T06 batch twin of ``session_agg`` that stays parallel inside a hot key:
    session_start = first event, session_end = last event + gap (Spark's
    ``session_window`` values), n_events, sum — all merged from the
    per-bucket partial aggregates of ``_session_buckets``; the events
    themselves are scanned and shuffled once, pre-aggregated."""
    bk = _session_buckets(df, ts_col, keys, gap_seconds, chunk_seconds, value_col, scale)
    aggs = [F.min("__lo_ts").alias("session_start"),
            (F.max("__hi_ts") + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("session_end"),
            F.sum("__n").alias("n_events")]
    if value_col:
        aggs.append(F.sum("__v").alias("sum_value"))
    out = bk.groupBy(*keys, "__s0").agg(*aggs)
    return out.select("session_start", "session_end", *keys,
                      *[c for c in out.columns if c in ("n_events", "sum_value")])


def sessions_max_duration(df: DataFrame, ts_col: str, keys: list[str], gap_seconds: int,
                          max_seconds: int, chunk_seconds: int = 86400) -> DataFrame:
    """T07 batch: gap sessions split into pieces of at most ``max_seconds``
    measured from the session start.  Output: keys, piece_start, piece_end
    (first/last event of the piece), n_events.  Sessions come from the
    bucket stitching of ``_session_buckets``; each event gets its session
    start by a join on (key, gap bucket) — a hot key spreads over its
    buckets — and pieces are a final aggregate keyed by (key, session start,
    piece)."""
    gap_us = gap_seconds * 1_000_000
    starts = _session_buckets(df, ts_col, keys, gap_seconds, chunk_seconds).select(*keys, "__b", "__s0")
    starts, nk = with_join_keys(starts, keys)
    starts = starts.select(*[F.col(c).alias(f"__j{c}") for c in nk + ["__b"]], "__s0")
    t = tf.micros(df, ts_col)
    ev = df.select(*keys, ts_col, t.alias("__t")).filter(F.col("__t").isNotNull()) \
        .withColumn("__b", F.floor(F.col("__t") / gap_us))
    ev, _ = with_join_keys(ev, keys)
    rows = ev.join(starts, reduce(lambda a, b: a & b, [ev[c] == starts[f"__j{c}"] for c in nk + ["__b"]]), "inner")
    rows = rows.withColumn("__piece", F.floor((F.col("__t") - F.col("__s0")) / F.lit(max_seconds * 1_000_000)))
    return (rows.groupBy(*keys, "__s0", "__piece")
            .agg(F.min(ts_col).alias("piece_start"), F.max(ts_col).alias("piece_end"),
                 F.count(F.lit(1)).alias("n_events"))
            .drop("__s0", "__piece"))


# --------------------------------------------------------------------------- dedup, late data
def dedup_within_watermark(df: DataFrame, keys: list[str], ts_col: str, watermark: str) -> DataFrame:
    """T10 stream: drop repeats of a key seen within the watermark delay
    (state is evicted once the watermark passes)."""
    return event_time(df, ts_col).withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(keys)


def keep_first(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """T10 batch twin / W02: the earliest row per key, by aggregation
    (min of a struct led by the event time) — hot keys combine map-side."""
    others = [c for c in df.columns if c not in keys and c != ts_col]
    best = df.groupBy(*keys).agg(F.min(F.struct(ts_col, *others)).alias("__b"))
    return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in [ts_col, *others]])


def late_split_batch(df: DataFrame, ts_col: str, batch_col: str, delay_seconds: int) -> DataFrame:
    """T09 batch twin: with rows arriving in micro-batches ``batch_col``, the
    watermark of batch b is max(event time of batches < b) - delay.  Adds
    ``is_late`` = event time older than that watermark.

    The per-batch maxima form a small table (one row per batch); the running
    max over it is a single small window, joined back by batch id."""
    per_batch = df.groupBy(batch_col).agg(F.max(ts_col).alias("__bmax"))
    w = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    wm = per_batch.select(batch_col, (F.max("__bmax").over(w) - F.expr(f"INTERVAL {delay_seconds} SECONDS"))
                          .alias("watermark"))
    out = df.join(wm, batch_col, "left")
    return out.withColumn("is_late", F.coalesce(F.col(ts_col) < F.col("watermark"), F.lit(False)))


def late_router(path: str, ts_col: str, delay_seconds: int, adjust_seconds: int = 0,
                window_seconds: int | None = None) -> Callable[[DataFrame, int], None]:
    """T09 stream: a ``foreachBatch`` function that routes each row once, in one pass over the batch.

    The watermark of a batch is the newest event time of the batches before it, less ``delay_seconds``.  Rows not older than it
    go to ``destination=on_time``.  Of the older ones, those by at most ``adjust_seconds`` go to ``destination=adjusted``: they
    are moved to the start of the oldest open window (windows of ``window_seconds``; the one the watermark lies in), unless they lie
    in it already; the others go to ``destination=dead_letter``.  ``original_<ts>`` keeps every row's own time.  Rows and the
    batch's newest time are kept under its batch id, so a replay overwrites itself and sees the same watermark."""
    if adjust_seconds and not window_seconds:
        raise ValueError("moving late rows into the oldest open window needs window_seconds")

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = existing_parquet(spark, f"{path}/progress")
        newest = None if seen is None else seen.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        own, where = F.col(ts_col), F.lit("on_time")
        moved = own
        if newest is not None:
            mark = F.lit(newest).cast(batch.schema[ts_col].dataType) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
            where = F.when(own < mark - F.expr(f"INTERVAL {adjust_seconds} SECONDS"), "dead_letter") \
                .when(own < mark, "adjusted" if adjust_seconds else "dead_letter").otherwise("on_time")
            if adjust_seconds:
                oldest = F.window(mark.cast("timestamp"), f"{window_seconds} seconds").start.cast(batch.schema[ts_col].dataType)
                moved = F.when(where == "adjusted", F.greatest(own, oldest)).otherwise(own)
        rows = batch.select("*", where.alias("destination"), own.alias(f"original_{ts_col}")).withColumn(ts_col, moved)
        rows.write.mode("overwrite").partitionBy("destination").parquet(f"{path}/rows/batch_id={batch_id}")
        batch.agg(F.max(ts_col).alias("newest")).write.mode("overwrite").parquet(f"{path}/progress/batch_id={batch_id}")
    return sink


def existing_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet; other errors propagate."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# --------------------------------------------------------------------------- sinks
def change_sink(path: str, writer: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps each micro-batch of changes in its own folder,
    named by the writing query and the batch id: O(batch) per trigger, and a replayed batch
    overwrites only itself.  ``writer`` must be unique for each checkpoint, since a
    new checkpoint counts its batches from 0 again."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/writer={writer}/batch_id={batch_id}")
    return sink


def change_state(spark: SparkSession, path: str, keys: list[str], order_cols: list[str],
                 delete_col: str | None = None) -> DataFrame:
    """The newest row of each key over all change folders (an aggregate), without deleted keys;
    ``compact_changes`` keeps the folders few."""
    from tablecheck.operators.change import latest_per_key
    state = latest_per_key(spark.read.parquet(path), keys, [*order_cols, "batch_id"])
    if delete_col:
        state = state.filter(~F.coalesce(F.col(delete_col), F.lit(False))).drop(delete_col)
    return state.drop("writer", "batch_id")


def compact_changes(spark: SparkSession, path: str, keys: list[str], order_cols: list[str]) -> int:
    """Fold the change folders that exist into one, so reads don't grow with the history; returns how many were folded.

    The folded rows (the newest of each key, deletions too) are written under a writer name of their own and the newest batch id
    they come from, and then the folders they replace are removed.  Between the two, and where a folded batch is replayed,
    a change is there twice, which ``change_state`` doesn't mind; batches that arrive meanwhile are not touched."""
    from tablecheck.operators.change import latest_per_key
    from tablecheck.sources.ingest import remove
    rows = existing_parquet(spark, path)
    seen = [] if rows is None else rows.select("writer", "batch_id").distinct().collect()  # batches, not rows
    if len(seen) < 2:
        return 0
    own = reduce(lambda a, b: a | b, [(F.col("writer") == w) & (F.col("batch_id") == b) for w, b in seen])
    folded = latest_per_key(rows.filter(own), keys, [*order_cols, "batch_id"]).drop("writer", "batch_id")
    folded.write.parquet(f"{path}/writer=folded-{uuid.uuid4().hex[:12]}/batch_id={max(b for _, b in seen)}")
    for w, b in seen:
        remove(spark, f"{path}/writer={w}/batch_id={b}")
    return len(seen)


def fan_out_sink(raw_path: str, agg_path: str, agg: Callable[[DataFrame], DataFrame]):
    """One ``foreachBatch`` writing the raw audit copy and the aggregate
    (both partitioned by batch id, so a replayed batch overwrites itself)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            b.write.mode("overwrite").parquet(f"{raw_path}/batch_id={batch_id}")
            agg(b).write.mode("overwrite").parquet(f"{agg_path}/batch_id={batch_id}")
        finally:
            b.unpersist()
    return sink


def expectations_stream(df: DataFrame, rules: list[Rule]):
    """The rule evaluator on a streaming DataFrame (stateless):
    returns (ok stream, failure-report stream)."""
    ev = evaluate(df, rules, with_json=False)
    return ev.ok, ev.fail


def run_available_now(df: DataFrame, checkpoint: str, sink: str | Callable, output_mode: str = "append",
                      fmt: str = "parquet", query_name: str | None = None):
    """Process everything available now, then stop (any
    output mode: append, complete, update).  Progress
    lives in ``checkpoint`` (must be shared storage on a cluster)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if callable(sink):
        q = w.foreachBatch(sink).start()
    elif fmt == "memory":
        q = w.format("memory").start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()
    return q
