"""Key-level duplicate handling.

Keys that repeat are found by a narrow count per key (hash aggregate, combined on the map
side).  Rows of other keys pass by an anti join and are never sorted; only rows of
repeated keys reach the survivor selection, an *aggregation*: ``min(struct(order key,
row))`` per key is partially aggregated on the map side, so a key holding a
third of all rows collapses to one struct per map task before the shuffle.
A ``row_number()`` window would sort that whole key inside one task.

Order of preference inside a key (reference semantics):
newest ``order_col`` first (oldest when the object name contains
``split_temp``), nulls last, then every other original column ascending
(nulls first) as a total, deterministic tie-break.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck import functions as tf
from tablecheck.operators.chunked import with_join_keys
from tablecheck.operators.evaluate import CheckContext, _idpipeline, json_row
from tablecheck.operators.rules import CRITICAL, FLAG_DUPLICATES, FLAG_NULLS, WARNING
from tablecheck.sources.ingest import file_parts

# Report texts of the duplicate check.
MULTIPLE_PKS_NAME = "Multiple PKs"
RAW_FOLDER_PREFIX = "Raw Folder : "
DUPLICATES_FOLDER_SEP = " -- Duplicates Folder : "
OLDEST_FIRST_MARKER = "split_temp"

_UP = "__k_"


def _key_exprs(df: DataFrame, keys: list[str]) -> list[Column]:
    """Case-insensitive key: upper() on string keys; nulls group together."""
    types = dict(df.dtypes)
    return [(F.upper(F.col(f"`{k}`")) if types[k] == "string" else F.col(f"`{k}`")).alias(f"{_UP}{i}")
            for i, k in enumerate(keys)]


def _order_value(df: DataFrame, c: str, descending: bool) -> list[Column]:
    """Columns that sort ascending exactly like ``c`` sorts in the wanted direction.

    Descending uses NULLS LAST (Spark's default for DESC); ascending uses
    NULLS FIRST.  Descending needs a numeric image of the value to negate."""
    dtype = df.schema[c].dataType
    v = F.col(f"`{c}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        num = tf.micros(df, c)
    elif isinstance(dtype, T.DateType):
        num = F.unix_date(v)
    elif isinstance(dtype, T.BooleanType):
        num = v.cast("int")
    elif isinstance(dtype, T.NumericType):
        num = v
    else:
        if descending:
            raise TypeError(f"order column {c} must be numeric, date or timestamp")
        num = v
    if descending:
        return [v.isNull(), -num]
    return [v]


def _rank_struct(df: DataFrame, order_col: str | None, oldest_first: bool) -> tuple[Column, dict]:
    """Struct whose ascending order is the survivor preference; it also carries
    every original column once, so the winning struct *is* the row.

    Returns the struct and {original column -> field name}."""
    original = list(df.columns)
    parts, where = [], {}
    if order_col is not None:
        parts += _order_value(df, order_col, descending=not oldest_first)
        if oldest_first:  # ascending: the field is the raw value itself
            where[order_col] = f"o{len(parts) - 1}"
    for c in original:
        if c == order_col:
            continue
        where[c] = f"o{len(parts)}"
        parts.append(F.col(f"`{c}`"))
    if order_col is not None and order_col not in where:
        where[order_col] = f"o{len(parts)}"
        parts.append(F.col(f"`{order_col}`"))
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)]), where


def _unpack(struct_col: str, where: dict, columns: list[str]) -> list[Column]:
    return [F.col(f"{struct_col}.{where[c]}").alias(c) for c in columns]


def _split_repeated(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of keys that occur once, rows of keys that repeat); case-insensitive keys,
    nulls are one key.

    In a large input the keys are dealt before they are counted, to as many partitions as its files ask for: neither
    the table of keys of a scan's task nor the rows that a task joins grow with the input."""
    names = [f"{_UP}{i}" for i in range(len(keys))]
    keyed, on = with_join_keys(df.select("*", *_key_exprs(df, keys)), names, "__j")
    parts = file_parts(df)
    counted = keyed.select(*on).repartition(parts, *on) if parts else keyed
    dup = counted.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*on)
    helpers = [*names, *on]
    return keyed.join(dup, on, "left_anti").drop(*helpers), keyed.join(dup, on, "left_semi").drop(*helpers)


def dedup_keep(df: DataFrame, keys: list[str], order_col: str | None = "_timestamp",
               object_name: str = "", folders_col: str | None = None) -> DataFrame:
    """Survivors: exactly one row per case-insensitive key, original columns.

    W01 keep-latest (default) / W02 keep-first (``object_name`` containing
    ``split_temp``)."""
    oldest = OLDEST_FIRST_MARKER in (object_name or "")
    if order_col is not None and order_col not in df.columns:
        order_col = None
    once, repeated = _split_repeated(df, keys)
    rank, where = _rank_struct(repeated, order_col, oldest)
    best = (repeated.select(*_key_exprs(repeated, keys), rank.alias("_r"))
            .groupBy(*[f"{_UP}{i}" for i in range(len(keys))])
            .agg(F.min("_r").alias("_w")))
    return once.select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(best.select(*_unpack("_w", where, list(df.columns))))


def duplicate_keys(df: DataFrame, keys: list[str], case_insensitive: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count."""
    cols = _key_exprs(df, keys) if case_insensitive else [F.col(f"`{k}`").alias(k) for k in keys]
    names = [f"{_UP}{i}" for i in range(len(keys))] if case_insensitive else keys
    out = df.select(*cols).groupBy(*[F.col(f"`{n}`") for n in names]).agg(F.count(F.lit(1)).alias("dup_count"))
    out = out.filter(F.col("dup_count") > 1)
    if case_insensitive:
        out = out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "dup_count")
    return out


def check_duplicates(df: DataFrame, keys: list[str], ctx: CheckContext | None = None,
                     uniqueness_col: str | None = None, order_col: str | None = "_timestamp",
                     is_warning: bool = False, null_pk: str = "fail",
                     all_losers: bool = False, delete_by_path: bool = False,
                     folder_col: str = "source_file_name", with_json: bool = True,
                     extra_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Q02–Q05. Returns (ok, fail).

    * ok: one survivor per case-insensitive key (original columns).
    * ``null_pk``: with ``'fail'`` every row with a null key part leaves OK and is reported
      under the null rule; with ``'group'`` nulls are one key value; with
      ``'blank'`` they are one key value and shown as '' (reference behaviour).
    * fail: one report row per duplicated key (the first loser), or every
      loser with ``all_losers=True``.  ``delete_by_path`` adds
      ``source_file_name_agg`` = "Raw Folder : a -- Duplicates Folder : b"
      over the sorted distinct folders of the whole key.
    """
    ctx = ctx or CheckContext()
    keys = list(keys)
    if uniqueness_col is not None and uniqueness_col not in keys:
        keys = keys + [uniqueness_col]
    uniq = uniqueness_col or keys[-1]
    colname = MULTIPLE_PKS_NAME if len(keys) > 1 else uniq
    oldest = OLDEST_FIRST_MARKER in ctx.name
    if order_col is not None and order_col not in df.columns:
        order_col = None
    if null_pk not in ("fail", "group", "blank"):
        raise ValueError("null_pk must be 'fail', 'group' or 'blank'")
    kcols = [f"{_UP}{i}" for i in range(len(keys))]
    original = list(df.columns)
    no_key = None
    if null_pk == "fail":
        missing = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
        no_key, df = df.filter(missing), df.filter(~missing)
    once, repeated = _split_repeated(df, keys)

    rank, where = _rank_struct(df, order_col, oldest)
    ranked = repeated.select(*_key_exprs(df, keys), rank.alias("_r"),
                             *([F.col(f"`{folder_col}`")] if delete_by_path and folder_col in df.columns else []))
    aggs = [F.min("_r").alias("_w"), F.count(F.lit(1)).alias("_n")]
    if delete_by_path and folder_col in df.columns:
        # distinct folders per key: bounded by the number of files, not rows
        aggs.append(F.array_sort(F.collect_set(F.col(f"`{folder_col}`"))).alias("_folders"))
    best = ranked.groupBy(*kcols).agg(*aggs)

    every = [F.col(f"`{c}`") for c in original]
    ok = once.select(*every).unionByName(best.select(*_unpack("_w", where, original)))
    if null_pk == "blank":
        types = dict(df.dtypes)
        ok = ok.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c)
                         if c in keys[:-1] and types[c] == "string" else F.col(f"`{c}`")
                         for c in original])

    if all_losers:
        dups = best.filter(F.col("_n") > 1).select(*[F.col(k).alias(f"_d{k}") for k in kcols],
                                                   *[c for c in best.columns if c not in kcols])
        # rows of duplicated keys only; null keys form a group (null-safe join);
        # the join is keyed, and AQE splits the big side of a hot key
        cond = [ranked[k].eqNullSafe(dups[f"_d{k}"]) for k in kcols]
        joined = ranked.join(dups, cond, "inner").drop(*[f"_d{k}" for k in kcols])
        # every row except one winner instance
        losers = (joined.groupBy(*kcols, "_r")
                  .agg(F.count(F.lit(1)).alias("_c"), F.first("_w").alias("_w"),
                       *([F.first("_folders").alias("_folders")] if "_folders" in dups.columns else []))
                  .withColumn("_c", F.when(F.col("_r") == F.col("_w"), F.col("_c") - 1).otherwise(F.col("_c")))
                  .filter(F.col("_c") > 0)
                  .withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("_c"))))
                  .withColumn("_l", F.col("_r")))
    else:
        # The first loser per key is the second row in preference order: a
        # row_number window filtered to 2, which Spark limits on the map side
        # (WindowGroupLimit) — each task forwards at most two rows per key, so
        # a hot key never lands whole in one task, and no join is needed.
        # Identical rows are interchangeable, so ties need no further order.
        w2 = Window.partitionBy(*kcols).orderBy("_r")
        losers = ranked.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") == 2) \
            .withColumnRenamed("_r", "_l")
        if delete_by_path and folder_col in df.columns:
            folders = best.filter(F.col("_n") > 1).select(*[F.col(k).alias(f"_d{k}") for k in kcols], "_folders")
            cond = [losers[k].eqNullSafe(folders[f"_d{k}"]) for k in kcols]
            losers = losers.join(folders, cond, "inner")
    row = _unpack("_l", where, original)
    lrow = losers.select(*row, *([F.col("_folders")] if "_folders" in losers.columns else []),
                         F.lit(FLAG_DUPLICATES).alias("_flag"))
    if no_key is not None:
        lrow = lrow.unionByName(no_key.select(*every, F.lit(FLAG_NULLS).alias("_flag")), allowMissingColumns=True)
    report = [
        F.lit(ctx.name).alias("object_name"),
        F.col("_flag").alias("check_passed"),
        F.lit(colname).alias("check_column_name"),
        F.col(f"`{uniq}`").cast("string").alias("check_column_value"),
        F.lit(WARNING if is_warning else CRITICAL).alias("error_type"),
        _idpipeline(df).alias("idpipeline"),
    ]
    if with_json:
        report.append(json_row(original).alias("json_row_data"))
    report += [F.col(f"`{c}`") for c in (extra_cols or [])]
    if "_folders" in lrow.columns:
        folders = F.concat(F.lit(RAW_FOLDER_PREFIX), F.concat_ws(DUPLICATES_FOLDER_SEP, F.col("_folders")))
        report.append(F.when(F.col("_folders").isNotNull(), folders).alias("source_file_name_agg"))
    fail = lrow.select(*report)
    return ok, fail


def dedup_exact(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """dropDuplicates on all or a subset of columns (hash aggregate)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()
