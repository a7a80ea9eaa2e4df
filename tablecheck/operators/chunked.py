"""Row-level window functions that stay parallel inside a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.
Here each key is cut into *chunks* by a column that never decreases along
the window order (e.g. the month of the order date, or a bucket of the
ranked value).  The window runs per (key, chunk) — a hot key spreads over
as many tasks as it has chunks — and a small per-(key, chunk) summary
(count, sum, distinct order values, first/last value) supplies the offset
each chunk needs from the chunks before it.  Results equal the plain window
exactly:

    row_number = rows in earlier chunks + row_number in chunk
    rank       = rows in earlier chunks + rank in chunk   (ties never span chunks)
    dense_rank = distinct order values in earlier chunks + dense_rank in chunk
    running    = sum of earlier chunks + running sum in chunk (ROWS or RANGE frame)
    lag/lead   = in-chunk lag/lead, or the neighbouring chunk's last/first value
    ntile(n)   = from row_number and the key's total count

The summary has one row per (key, chunk); the join back is on (key, chunk),
the same partitioning as the chunk window, so the big side is not shuffled
again.  Every key is chunked, whatever its size: nothing is counted first and no
row count changes the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_C = "__chunk"


def with_join_keys(df: DataFrame, cols: list[str], prefix: str = "__k") -> tuple[DataFrame, list[str]]:
    """Null-safe key columns usable in plain equi-joins: per column a value
    with nulls replaced by a typed default plus an is-null flag.  Windows,
    summaries and the join back all partition on these columns, so the big
    side keeps the partitioning of its window (a null-safe ``<=>`` join would
    hash on rewritten expressions and shuffle it again)."""
    out, names = [], []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        if isinstance(dt, T.StringType):
            dflt = F.lit("")
        elif isinstance(dt, (T.NumericType, T.BooleanType)):
            dflt = F.lit(0).cast(dt)
        else:
            dflt, dt = F.lit(""), T.StringType()
        out += [F.coalesce(F.col(c).cast(dt), dflt).alias(f"{prefix}{i}"), F.col(c).isNull().alias(f"{prefix}n{i}")]
        names += [f"{prefix}{i}", f"{prefix}n{i}"]
    return df.select("*", *out), names


def _with_chunk(df: DataFrame, keys: list[str], chunk: Column) -> tuple[DataFrame, list[str], list[str]]:
    """Adds the chunk and the normalised (key, chunk) columns; returns the
    frame, the (key, chunk) partition columns and the key-only columns."""
    d, nk = with_join_keys(df.withColumn(_C, chunk), keys + [_C])
    return d, nk, nk[:-2]


def _join_summary(local: DataFrame, summary: DataFrame, part: list[str]) -> DataFrame:
    """Join the per-(key, chunk) summary back on the partition columns."""
    s = summary.select(*[F.col(c).alias(f"__s{c}") for c in part], *[c for c in summary.columns if c not in part])
    cond = reduce(lambda a, b: a & b, [local[c] == s[f"__s{c}"] for c in part])
    return local.join(s, cond, "inner").drop(*[f"__s{c}" for c in part])


def chunked_rank(df: DataFrame, keys: list[str], order: list[Column], chunk: Column,
                 row_number: str | None = "rn", rank: str | None = "rnk", dense_rank: str | None = "drnk",
                 order_cols_for_distinct: list[str] | None = None,
                 rank_order: list[Column] | None = None, total: str | None = None) -> DataFrame:
    """W03–W05 over chunks.  ``order`` orders row_number (make it total for a
    deterministic result); ``rank_order`` (default ``order``) orders rank and
    dense_rank; ``order_cols_for_distinct`` names the columns whose distinct
    combinations dense_rank counts (the rank ORDER BY columns); ``total``
    names an optional output with the key's row count (from the summary).
    All numbers are long."""
    d, part, kk = _with_chunk(df, keys, chunk)
    w = Window.partitionBy(*part).orderBy(*order)
    wr = Window.partitionBy(*part).orderBy(*(rank_order or order))
    local = d.withColumn("__lrn", F.row_number().over(w))
    if rank:
        local = local.withColumn("__lrk", F.rank().over(wr))
    if dense_rank:
        local = local.withColumn("__ldr", F.dense_rank().over(wr))
    aggs = [F.count(F.lit(1)).alias("__n")]
    if dense_rank:
        if not order_cols_for_distinct:
            raise ValueError("dense_rank needs order_cols_for_distinct")
        # struct(): a null order value is a distinct value too, as in dense_rank
        aggs.append(F.count_distinct(F.struct(*[F.col(c) for c in order_cols_for_distinct])).alias("__nd"))
    summary = d.groupBy(*part, _C).agg(*aggs)
    prev = Window.partitionBy(*kk).orderBy(_C).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*part, F.coalesce(F.sum("__n").over(prev), F.lit(0)).alias("__off_n"),
                             *([F.coalesce(F.sum("__nd").over(prev), F.lit(0)).alias("__off_d")] if dense_rank else []),
                             *([F.sum("__n").over(Window.partitionBy(*kk)).alias(total)] if total else []))
    out = _join_summary(local, summary, part)
    if row_number:
        out = out.withColumn(row_number, (F.col("__off_n") + F.col("__lrn")).cast("long"))
    if rank:
        out = out.withColumn(rank, (F.col("__off_n") + F.col("__lrk")).cast("long"))
    if dense_rank:
        out = out.withColumn(dense_rank, (F.col("__off_d") + F.col("__ldr")).cast("long"))
    return out.drop("__lrn", "__lrk", "__ldr", "__off_n", "__off_d", _C, *part)


def chunked_running_sum(df: DataFrame, keys: list[str], order: list[Column], chunk: Column, value: Column,
                        out: str, frame: str = "rows") -> DataFrame:
    """W10 (``frame='rows'``: unbounded preceding .. current row) and W11
    (``frame='range'``: peers share the sum) over chunks."""
    d, part, kk = _with_chunk(df, keys, chunk)
    d = d.withColumn("__v", value)
    w = Window.partitionBy(*part).orderBy(*order)
    if frame == "rows":
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    elif frame != "range":
        raise ValueError("frame must be 'rows' or 'range'")
    local = d.withColumn("__loc", F.sum("__v").over(w))
    summary = d.groupBy(*part, _C).agg(F.sum("__v").alias("__t"))
    prev = Window.partitionBy(*kk).orderBy(_C).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*part, F.sum("__t").over(prev).alias("__off"))
    res = _join_summary(local, summary, part)
    total = F.when(F.col("__off").isNull(), F.col("__loc")).otherwise(F.col("__off") + F.col("__loc"))
    return res.withColumn(out, total).drop("__v", "__loc", "__off", _C, *part)


def chunked_lag_lead(df: DataFrame, keys: list[str], order_cols: list[str], chunk: Column, value: str,
                     lag_out: str | None = "prev", lead_out: str | None = "next", default=None) -> DataFrame:
    """W06/W07 with offset 1 over chunks (ascending ``order_cols`` forming a
    total order).  The first row of a chunk takes the previous chunk's last
    value; the last row takes the next chunk's first value."""
    d, part, kk = _with_chunk(df, keys, chunk)
    w = Window.partitionBy(*part).orderBy(*order_cols)
    local = d.withColumn("__rn", F.row_number().over(w)).withColumn("__cnt", F.count(F.lit(1)).over(
        Window.partitionBy(*part)))
    if lag_out:
        local = local.withColumn("__lag", F.lag(value, 1).over(w))
    if lead_out:
        local = local.withColumn("__lead", F.lead(value, 1).over(w))
    ordkey = F.struct(*order_cols)
    summary = d.groupBy(*part, _C).agg(F.max_by(value, ordkey).alias("__last"),
                                       F.min_by(value, ordkey).alias("__first"))
    wc = Window.partitionBy(*kk).orderBy(_C)
    # row_number() marks a neighbouring chunk (a null chunk is a chunk too)
    summary = summary.select(*part, F.lag(F.lit(1)).over(wc).alias("__pc"), F.lag("__last").over(wc).alias("__plast"),
                             F.lead(F.lit(1)).over(wc).alias("__nc"), F.lead("__first").over(wc).alias("__nfirst"))
    res = _join_summary(local, summary, part)
    dflt = F.lit(default)
    if lag_out:
        res = res.withColumn(lag_out, F.when(F.col("__rn") > 1, F.col("__lag"))
                             .when(F.col("__pc").isNotNull(), F.col("__plast")).otherwise(dflt))
    if lead_out:
        res = res.withColumn(lead_out, F.when(F.col("__rn") < F.col("__cnt"), F.col("__lead"))
                             .when(F.col("__nc").isNotNull(), F.col("__nfirst")).otherwise(dflt))
    return res.drop("__rn", "__cnt", "__lag", "__lead", "__pc", "__plast", "__nc", "__nfirst", _C, *part)


def chunked_ntile(df: DataFrame, keys: list[str], order: list[Column], chunk: Column, n: int,
                  out: str = "ntile") -> DataFrame:
    """NTILE(n) = bucket of the row number: the first (total mod n)
    buckets hold one row more (SQL standard / Spark semantics).  The key's
    total comes with the chunk summary, so no second join by key alone."""
    j = chunked_rank(df, keys, order, chunk, row_number="__rn", rank=None, dense_rank=None, total="__tot")
    q = F.floor(F.col("__tot") / n)
    r = F.col("__tot") - q * n
    rn = F.col("__rn")
    big = (q + 1) * r
    tile = F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + r + 1)
    return j.withColumn(out, tile.cast("int")).drop("__rn", "__tot")
