"""Streaming operators that keep state of their own (T05, T07), on ``transformWithState``.

Both run in two steps.  A plain streaming aggregate counts events by (key, event time) and gives each count away once, when the
watermark passes it: repeats are combined before the shuffle, events may arrive in any order within the
watermark, and the second step sees every event time once and in order from trigger to trigger.  The second step then needs
little: a session of any length is one summary row, a sliding count is the counts of one range.

``transformWithState`` keeps its state in RocksDB, so starting one of these streams names that state store in the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tablecheck.streaming.stream import event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _counts(df: DataFrame, ts_col: str, by: list[str], watermark: str) -> DataFrame:
    """``(ts, by..., __n, __us)``: events by time, each final when it is given away."""
    rows = event_time(df, ts_col).filter(F.col(ts_col).isNotNull()).withWatermark(ts_col, watermark)
    return rows.groupBy(ts_col, *by).agg(F.count(F.lit(1)).alias("__n")).withColumn("__us", F.unix_micros(ts_col))


class _KeyState(StatefulProcessor):
    """One value for each key and at most one timer, which forgets the key when ``__us`` is ``wait`` behind the watermark."""

    def __init__(self, columns: list[str], schema: str, wait_us: int):
        self.columns, self.schema, self.wait_us = columns, schema, wait_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)

    def in_order(self, frames: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
        """A key's rows by event time; None where the key has none in this trigger."""
        full = [f for f in frames if len(f)]
        if not full:
            return None
        rows = pd.concat(full, ignore_index=True)
        rows.columns = self.columns  # names that begin with an underscore don't arrive
        return rows.sort_values("__us", kind="stable", ignore_index=True)

    def keep(self, last_us: int, values: tuple) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((last_us + self.wait_us) // 1000 + 1)
        self.state.update(values)

    def close(self) -> None:
        pass


# --------------------------------------------------------------------------- T07
class _Sessions(_KeyState):
    """The open piece of a key's open session: its session's start, its number, first and last event and count."""

    def __init__(self, columns: list[str], key_col: str, gap_us: int, max_us: int):
        super().__init__(columns, "start long, piece long, first long, last long, n long", gap_us)
        self.key_col, self.gap_us, self.max_us = key_col, gap_us, max_us

    def out(self, key, pieces: list[tuple]) -> pd.DataFrame:
        first, last, n = (np.array([p[i] for p in pieces], np.int64) for i in (2, 3, 4))
        return pd.DataFrame({self.key_col: pd.Series([key[0]] * len(pieces)), "first_us": first, "last_us": last, "n_events": n})

    def handleInputRows(self, key, rows, timerValues):
        frame = self.in_order(rows)
        if frame is None:
            return
        t, n = frame["__us"].to_numpy(np.int64), frame["__n"].to_numpy(np.int64)
        held = self.state.get() if self.state.exists() else None
        before = held[3] if held else t[0] - self.gap_us - 1
        new = np.diff(t, prepend=before) > self.gap_us
        start = np.where(new, t, held[0] if held else t[0])
        start = start[np.maximum.accumulate(np.where(new, np.arange(len(t)), 0))]
        piece = (t - start) // self.max_us
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(start) != 0) | (np.diff(piece) != 0))))
        ends = np.concatenate((cut[1:], [len(t)])) - 1
        pieces = [tuple(map(int, p)) for p in zip(start[cut], piece[cut], t[cut], t[ends], np.add.reduceat(n, cut))]
        if held:
            if tuple(held[:2]) == pieces[0][:2]:
                pieces[0] = (*pieces[0][:2], held[2], pieces[0][3], held[4] + pieces[0][4])
            else:
                pieces.insert(0, tuple(held))
        self.keep(pieces[-1][3], pieces[-1])
        if len(pieces) > 1:
            yield self.out(key, pieces[:-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = tuple(self.state.get())
        self.state.clear()
        yield self.out(key, [held])


def sessions_max_duration_stream(df: DataFrame, ts_col: str, key: str, gap_seconds: int, max_seconds: int,
                                 watermark: str) -> DataFrame:
    """T07 stream: gap sessions in pieces of at most ``max_seconds`` from the session's start: key, piece_start, piece_end, n_events.

    A piece is given away once no event can join it: when a later event has opened the next piece or
    session, or the watermark has passed its last event by the gap.  State: counts by event time
    that the watermark has not passed, and one row for each key, however long its session is."""
    _state_store(df.sparkSession)
    counts = _counts(df, ts_col, [key], watermark)
    kind = df.schema[key].dataType
    shape = T.StructType([T.StructField(key, kind), *(T.StructField(c, T.LongType()) for c in ("first_us", "last_us", "n_events"))])
    pieces = counts.groupBy(key).transformWithStateInPandas(
        _Sessions(counts.columns, key, gap_seconds * 1_000_000, max_seconds * 1_000_000), shape, "append", "eventTime")
    return pieces.select(key, F.timestamp_micros("first_us").alias("piece_start"), F.timestamp_micros("last_us").alias("piece_end"), "n_events")


# --------------------------------------------------------------------------- T05
class _Sliding(_KeyState):
    """The keys, buckets, event times and counts of a group's last ``range`` of time; a group has many keys and buckets."""

    def __init__(self, columns: list[str], give: list[str], bucket_us: int, range_us: int):
        super().__init__(columns, "keys array<string>, buckets array<long>, times array<long>, counts array<long>", range_us)
        self.give, self.bucket_us, self.range_us = give, bucket_us, range_us

    def handleInputRows(self, key, rows, timerValues):
        frame = self.in_order(rows)
        if frame is None:
            return
        held = self.state.get() if self.state.exists() else ([], [], [], [])
        names = np.concatenate((np.array(held[0], object), frame["__key"].to_numpy(object)))
        b, t, n = (np.concatenate((np.array(old, np.int64), frame[c].to_numpy(np.int64)))
                   for old, c in zip(held[1:], ("__bucket", "__us", "__n")))
        code = pd.factorize(names)[0]
        order = np.lexsort((t, b, code))
        names, code, b, t, n = names[order], code[order], b[order], t[order], n[order]
        part = np.cumsum(np.concatenate(([False], (np.diff(code) != 0) | (np.diff(b) != 0))))
        # one number by (key, bucket), then time; parts are so far from each other that no range reaches into the one before
        place = part * (self.bucket_us + 2 * self.range_us + 1) + (t - b * self.bucket_us + self.range_us)
        total = np.concatenate(([0], np.cumsum(n)))
        found = np.empty(len(t), np.int64)
        found[order] = total[np.searchsorted(place, place, "right")] - total[np.searchsorted(place, place - self.range_us, "left")]
        frame["__total"] = found[len(held[0]):]
        stay = np.flatnonzero(t >= t.max() - self.range_us)  # later rows are later than all of these, whatever their key
        first = np.unique(place[stay], return_index=True)[1]
        kept = stay[first]
        self.keep(int(t.max()), (names[kept].tolist(), b[kept].tolist(), t[kept].tolist(), np.add.reduceat(n[stay], first).tolist()))
        own = frame.loc[frame["__own"], self.give]
        if len(own):
            yield own.reset_index(drop=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter(())


def sliding_count_stream(df: DataFrame, ts_col: str, key: str, range_seconds: int, watermark: str, out: str,
                         carry: list[str] | None = None, bucket_seconds: int | None = None, groups: int = 512) -> DataFrame:
    """T05 stream: for every event the number of its key's events in ``[ts - range, ts]``, as ``trailing_window`` gives it.

    Rows are ``(key, ts, carry..., out)``, given away once the watermark has passed them.  Work and state are cut by (key, time bucket):
    the last ``range_seconds`` of a bucket are copied, as counts only, into the next one, so a key of a third of all events is many
    parts.  The parts are dealt to ``groups`` groups by their hash, since each group costs some calls between Spark and Python
    in every trigger: one for each part would cost more than the counting.  State: counts by event time within one range."""
    carry = list(carry or [])
    bucket = (bucket_seconds or 12 * range_seconds) * 1_000_000
    if range_seconds * 1_000_000 > bucket:
        raise ValueError("bucket must be at least as long as the range")
    _state_store(df.sparkSession)
    rows = event_time(df, ts_col).filter(F.col(ts_col).isNotNull())
    us = F.unix_micros(ts_col)
    b = F.floor(us / F.lit(bucket))
    halo = us - b * bucket >= bucket - range_seconds * 1_000_000
    copies = F.array_compact(F.array(F.struct(b.alias("b"), F.lit(True).alias("own")), F.when(halo, F.struct((b + 1).alias("b"), F.lit(False).alias("own")))))
    rows = rows.select(key, ts_col, *carry, F.explode(copies).alias("__c")).select(
        key, ts_col, F.col("__c.b").alias("__bucket"), F.col("__c.own").alias("__own"),
        *[F.when(F.col("__c.own"), F.col(c)).alias(c) for c in carry])
    counts = _counts(rows, ts_col, [key, "__bucket", "__own", *carry], watermark)
    kinds = {f.name: f.dataType for f in counts.schema.fields}
    given = list(dict.fromkeys([key, *carry]))
    # whole numbers travel as text: beside nulls pandas would make them floats
    text = {c for c in given if isinstance(kinds[c], T.IntegralType)}
    counts = counts.select(
        ts_col, *[(F.col(c).cast("string") if c in text else F.col(c)).alias(c) for c in given if c != ts_col], "__own", "__bucket", "__n", "__us",
        F.col(key).cast("string").alias("__key"), F.pmod(F.xxhash64(key, "__bucket"), F.lit(groups)).alias("__group"))
    columns = [*given, "__us", "__n", "__total"]
    shape = T.StructType([T.StructField(c, T.LongType() if c.startswith("__") else T.StringType() if c in text else kinds[c]) for c in columns])
    totals = counts.groupBy("__group").transformWithStateInPandas(
        _Sliding(counts.columns, columns, bucket, range_seconds * 1_000_000), shape, "append", "eventTime")
    back = {c: F.col(c).cast(kinds[c]).alias(c) if c in text else F.col(c) for c in given}
    return totals.select(back[key], F.timestamp_micros("__us").alias(ts_col), *[back[c] for c in carry], F.col("__total").alias(out),
                         F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__i")).drop("__i")
