"""Maximal periodic runs of words by string synchronising sets (Kempa and Kociumaka, 2019), and their collapse.

A run is a stretch of words with smallest period ``q``, at least ``exponent * q`` long (three or more), that no
neighbouring word extends at that period.  All runs are found, in time that grows as ``n log n``:

1. Words become numbers by a dictionary (exact, no hash); the texts of a batch are laid end to end with a number of its own
   after each, so no run crosses texts and every step is a vector operation over the batch.
2. Periods under ``DIRECT`` are the separately detected highly periodic regions: stretches where the words ``q`` apart are equal.
3. For each scale ``t`` = 4, 8, 16... a position is synchronising if its run of ``t`` words has the smallest hash among the
   ``t + 1`` positions that start or end there; positions inside highly periodic regions (period at most ``t / 3``, known from
   smaller scales) take no part.  Whether a position is chosen depends on its ``2 t`` words only, so in a run of period
   ``q`` it is chosen again ``q`` further on, and a run with ``1.5 t <= q < 3 t`` holds such a pair.  Positions with
   equal contexts at such a distance propose it as a period; one context stands at most nine times in that distance.
4. A proposed period is extended both ways over the words themselves, so hashes decide nothing; stretches that a smaller
   period explains are left out.

Texts too short for a scale leave before it, and the work of one text stays in one task.

Edge cases: a null text is empty; an empty text has no runs and collapses to the empty text; rows are treated one by one, so
repeated rows and ids give equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix

#: Periods below this are compared directly; the first scale covers periods from here on.
DIRECT, FIRST_SCALE = 6, 4
#: Words worked on at once, unless one text has more.
BATCH_WORDS = 400_000
WORD = r"[^\x20\x09-\x0D]+"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the stretches of true values."""
    change = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False]))))
    return change[::2], change[1::2]


def _matches(words: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from ``i`` and ``j`` on are equal, walking by ``step`` (1 or -1); separators differ from all words."""
    total, size = 0, 16
    while True:
        size = min(size, len(words) - max(i, j) if step > 0 else min(i, j) + 1)
        if size <= 0:
            return total
        x, y = (words[i : i + size], words[j : j + size]) if step > 0 else (words[i - size + 1 : i + 1][::-1], words[j - size + 1 : j + 1][::-1])
        differ = np.flatnonzero(x != y)
        if len(differ):
            return total + int(differ[0])
        total, i, j, size = total + size, i + step * size, j + step * size, 2 * size


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima of blocks of that width."""
    n, top = len(values) - width + 1, np.iinfo(values.dtype).max
    padded = np.full(-(-len(values) // width) * width, top, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def synchronising(hashes: np.ndarray, dull: np.ndarray, t: int) -> np.ndarray:
    """Positions of the synchronising set of scale ``t``: ``hashes`` of every ``t`` words, ``dull`` where these have a period of at most ``t / 3``."""
    if len(hashes) <= t:
        return np.empty(0, np.int64)
    top = np.iinfo(hashes.dtype).max
    own = np.where(dull, top, np.minimum(hashes, top - np.uint64(1)))
    least = _smallest(own, t + 1)
    return np.flatnonzero((least != top) & ((least == own[: len(least)]) | (least == own[t : t + len(least)])))


def _dull(n: int, runs: list[tuple[int, int, int]], t: int) -> np.ndarray:
    """Which of ``n`` positions start ``t`` words of a period of at most ``t / 3``."""
    edge = np.zeros(n + 1, np.int64)
    own = [(s, e - t + 1) for s, e, p in runs if 3 * p <= t <= e - s]
    if own:
        starts, stops = np.array(own).T
        np.add.at(edge, starts, 1)
        np.add.at(edge, stops, -1)
    return np.cumsum(edge[:-1]) > 0


def _proposals(hashes: np.ndarray, at: np.ndarray, t: int) -> list[tuple[int, int]]:
    """``(period, position)`` of synchronising positions with equal ``2 t`` words at a distance of ``1.5 t`` to ``3 t``."""
    with np.errstate(over="ignore"):
        context = mix(hashes[at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + t])
    order = np.lexsort((at, context))
    context, at = context[order], at[order]
    found, step = [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (context[step:] == context[:-step]) & (apart < 3 * t)
        if not near.any():
            break
        take = near & (2 * apart >= 3 * t)
        found += zip(apart[take].tolist(), at[:-step][take].tolist())
        step += 1
    return sorted(found)


def _extended(words: np.ndarray, proposals: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(start, stop, period)`` of the stretches that sorted ``(period, position)`` pairs lie in, each once."""
    last = (0, 0, 0)
    for q, i in proposals:
        if q != last[2] or i + q >= last[1]:
            last = (i - _matches(words, i - 1, i + q - 1, -1), i + q + _matches(words, i, i + q, 1), q)
            yield last


def find_runs(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(text, start, stop, smallest period)`` of every run of exponent three or more, sorted.

    ``words`` are numbers of texts laid end to end, each followed by a number that stands nowhere else;
    ``lengths`` are the texts' words, without that number.
    """
    texts, found = np.arange(len(lengths)), {}
    begin = np.cumsum(lengths + 1) - lengths - 1

    def add(stretches) -> None:
        for s, e, q in stretches:
            if e - s >= 3 * q:
                at = int(np.searchsorted(begin, s, "right")) - 1
                found.setdefault((int(texts[at]), s - int(begin[at]), e - int(begin[at])), q)  # smaller periods come first

    for q in range(1, DIRECT):
        starts, stops = _stretches(words[q:] == words[:-q])
        long = stops - starts >= 2 * q
        add((s, e + q, q) for s, e in zip(starts[long].tolist(), stops[long].tolist()))
    with np.errstate(over="ignore"):
        hashes, size, t = mix(words.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1)), 1, FIRST_SCALE
    while True:
        long = 2 * lengths >= 9 * t  # room for a period of 1.5 t three times
        if not long.any():
            return sorted((*place, q) for place, q in found.items())
        if not long.all():
            keep = np.repeat(long, lengths + 1)
            words, hashes, texts, lengths = words[keep], hashes[keep], texts[long], lengths[long]
            begin = np.cumsum(lengths + 1) - lengths - 1
        while size < t:  # runs of words that pass a text's end hold its number and equal no other
            with np.errstate(over="ignore"):
                hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.concatenate((hashes[size:], hashes[:size])))
            size *= 2
        where = dict(zip(texts.tolist(), begin.tolist()))
        dull = _dull(len(words), [(where[x] + s, where[x] + e, q) for (x, s, e), q in found.items() if x in where], t)
        at = synchronising(hashes, dull, t)
        add(_extended(words, _proposals(hashes, at[at + 2 * t <= len(words)], t)))
        t *= 2


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, stop, period in runs:
        keep[start + period : stop] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, exponent: int = 3, text: Column | None = None) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for every row: runs as ``(start, length, period)`` by start, then period, and the text with each run cut to its first period, words joined by one space.

    ``text`` replaces the text column by an expression; ``exponent`` is at least three.
    """
    if exponent < 3:
        raise ValueError("runs are found from exponent 3 on")

    def work(ids: list[pa.Array], texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        flat = [n for i, own in enumerate(texts) for n in (*[number.setdefault(w, len(number)) for w in own], -1 - i)]
        own: list[list] = [[] for _ in texts]
        for x, s, e, q in find_runs(np.array(flat, np.int64), np.array([len(w) for w in texts], np.int64)):
            if e - s >= max(min_length, exponent * q):
                own[x].append((s, e, q))
        runs = pa.array([[{"start": s, "length": e - s, "period": q} for s, e, q in sorted(r, key=lambda r: (r[0], r[2]))] for r in own], pa.list_(RUN))
        rest = pa.array([b" ".join(collapse(w, r) if r else w) for w, r in zip(texts, own)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array([len(w) for w in texts], pa.int64()), runs, rest], names=["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                ids.append(batch.column(0).slice(i, 1))
                texts.append((value.as_py() or "").encode().split())
                held += len(texts[-1]) + 1
                if held >= BATCH_WORDS:
                    yield work(ids, texts)
                    ids, texts, held = [], [], 0
        if texts:
            yield work(ids, texts)

    kind = df.select(id_col).schema[0].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col) if text is None else text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string").withColumnRenamed("id", id_col)


def planted(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, with the tail of every tenth document (by a checksum of its id) made periodic: word ``i >= a`` becomes word ``a + (i - a) % p``."""
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))

    def tail(x: Column) -> Column:  # words and their numbers are variables here, so they are made once and not for every word
        w, a, p = x["w"], x["a"], x["p"]
        return F.array_join(F.transform(w, lambda own, i: F.when(i < a, own).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    start = lambda x: F.struct(x["w"].alias("w"), F.pmod(x["g"], F.size(x["w"])).alias("a"), x["g"].alias("g"))
    whole = lambda x: F.struct(x["w"].alias("w"), x["a"].alias("a"), (1 + F.floor((F.size(x["w"]) - x["a"]) / (3 + F.pmod(x["g"], F.lit(8))))).alias("p"))
    some = F.filter(F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g"))), lambda x: F.size(x["w"]) > 0)
    made = F.get(F.transform(F.transform(F.transform(some, start), whole), tail), 0)
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(made, F.col(text_col))).otherwise(F.col(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of runs, the run of greatest exact exponent (ties: smallest start, then period) and digests of the runs and the collapsed text."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
