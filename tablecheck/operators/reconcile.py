"""Quarantine, thresholds, reconciliation and layer comparison (Q29–Q33).

All of these are single aggregates over the data (map-side combined); the
driver only ever sees one small result row per layer/destination.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.operators.evaluate import ok_predicate
from tablecheck.operators.rules import Rule

QUARANTINE = "quarantine"
SILVER = "silver"


def tag_destination(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Q29: add ``destination`` = silver | quarantine.  A null predicate counts
    as failing (``coalesce(pred, false)``), so no row goes to neither side."""
    return df.withColumn("destination", F.when(ok_predicate(rules), F.lit(SILVER)).otherwise(F.lit(QUARANTINE)))


def write_quarantine(df: DataFrame, rules: list[Rule], silver_path: str, quarantine_path: str,
                     mode: str = "append", persist: bool = False) -> None:
    """Q29 sink: two appends from one tagged plan (persist optional)."""
    tagged = tag_destination(df, rules)
    if persist:
        tagged = tagged.persist()
    try:
        tagged.filter(F.col("destination") == SILVER).drop("destination").write.mode(mode).parquet(silver_path)
        tagged.filter(F.col("destination") == QUARANTINE).drop("destination").write.mode(mode).parquet(quarantine_path)
    finally:
        if persist:
            tagged.unpersist()


def quarantine_split(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows per destination (one scan, one tiny aggregate)."""
    return tag_destination(df, rules).groupBy("destination").agg(F.count(F.lit(1)).alias("n_rows"))


def threshold_status(df: DataFrame, rules: list[Rule], max_bad_pct: float = 1.0) -> DataFrame:
    """Q30: bad-row share and an alert flag when it exceeds ``max_bad_pct``."""
    bad = (~ok_predicate(rules)).cast("long")
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bad).alias("n_bad"))
    pct = F.try_divide(F.col("n_bad") * F.lit(100.0), F.col("n_rows"))
    return agg.select("n_rows", F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
                      F.round(pct, 4).alias("bad_pct"), (pct > F.lit(max_bad_pct)).alias("alert"))


def assert_not_empty(df: DataFrame, what: str = "output") -> None:
    """Raise if ``df`` has no rows (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")


def reconcile_counts(source: DataFrame, target: DataFrame, tolerance_pct: float = 5.0) -> DataFrame:
    """Q32: source vs target row counts; FAIL when the difference exceeds the
    tolerance.  A zero source gives a null ratio (no division error)."""
    side = source.select(F.lit(1).alias("__s")).unionByName(target.select(F.lit(0).alias("__s")))
    counts = side.agg(F.sum("__s").alias("source_count"), F.sum(1 - F.col("__s")).alias("target_count"))
    counts = counts.select(F.coalesce("source_count", F.lit(0)).cast("long").alias("source_count"),
                           F.coalesce("target_count", F.lit(0)).cast("long").alias("target_count"))
    diff = F.try_divide(F.abs(F.col("source_count") - F.col("target_count")) * F.lit(100.0), F.col("source_count"))
    return (counts
            .select("source_count", "target_count", F.round(diff, 4).alias("diff_pct"),
                    F.when(diff > F.lit(tolerance_pct), F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status")))


def checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q32 (checksums): order-insensitive content hash = sum of per-row xxhash64
    as decimal (no overflow) plus the row count."""
    cols = columns or df.columns
    h = F.xxhash64(*[F.col(f"`{c}`") for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).alias("row_hash_sum"))


def layer_stats(layers: dict[str, DataFrame], key: Column | None = None,
                measure: Column | None = None) -> DataFrame:
    """Q33: per-layer row count (+ distinct keys, + measure sum), one row per layer."""
    parts = []
    for name, df in layers.items():
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        if key is not None:
            aggs.append(F.count_distinct(key).alias("n_keys"))
        if measure is not None:
            aggs.append(F.sum(measure).alias("sum_measure"))
        parts.append(df.agg(*aggs).select(F.lit(name).alias("layer"), "*"))
    return reduce(DataFrame.unionByName, parts)
