"""Declarative dataset rules (Q27): IsComplete, IsUnique, ColumnValues,
ColumnCount, ColumnLength — as Python objects, no rule-text parser.

Every rule contributes aggregate expressions to ONE ``agg`` over the data
(map-side combined); the outcome table has one row per rule:
rule, column, metric, status (PASS/FAIL).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v, "=": lambda c, v: c == v, "!=": lambda c, v: c != v}


@dataclass(frozen=True)
class DatasetRule:
    name: str
    column: str
    metric: Column | None          # aggregate expression (None: schema-only rule)
    passes: object                 # python callable(metric_value) -> bool, or a bool for schema rules
    by_value: bool = False         # needs its own aggregate over the column's value counts


def is_complete(column: str) -> DatasetRule:
    """No nulls in the column."""
    return DatasetRule("IsComplete", column, F.sum(F.col(column).isNull().cast("long")), lambda v: (v or 0) == 0)


def is_unique(column: str) -> DatasetRule:
    """Every non-null value occurs once; metric = repeats (rows less distinct values)."""
    return DatasetRule("IsUnique", column, None, lambda v: (v or 0) == 0, by_value=True)


def column_values(column: str, op: str, value) -> DatasetRule:
    """Every non-null value satisfies ``column <op> value``; metric = violations."""
    bad = ~F.coalesce(_OPS[op](F.col(column), F.lit(value)), F.lit(True))
    return DatasetRule(f"ColumnValues {op} {value}", column, F.sum(bad.cast("long")), lambda v: (v or 0) == 0)


def column_length_between(column: str, lo: int, hi: int) -> DatasetRule:
    """Text length of every non-null value within [lo, hi]; metric = violations."""
    n = F.length(F.col(column).cast("string"))
    bad = ~F.coalesce(n.between(lo, hi), F.lit(True))
    return DatasetRule(f"ColumnLength between {lo} and {hi}", column, F.sum(bad.cast("long")),
                       lambda v: (v or 0) == 0)


def column_count(n: int) -> DatasetRule:
    """The frame has exactly ``n`` columns (schema rule, no data read)."""
    return DatasetRule(f"ColumnCount = {n}", "*", None, n)


def evaluate_ruleset(df: DataFrame, rules: list[DatasetRule]) -> DataFrame:
    """Q27: one aggregate for all data rules, and a narrow one for each uniqueness rule (metric = violations, PASS when 0),
    unpivoted with ``stack``; schema rules are literal rows.  Lazy: nothing
    is collected to the driver."""
    parts = []
    data_rules = [r for r in rules if r.metric is not None]
    if data_rules:
        wide = df.agg(*[F.coalesce(r.metric.cast("long"), F.lit(0)).alias(f"m{i}")
                        for i, r in enumerate(data_rules)])
        rows = ", ".join(f"'{r.name}', '{r.column}', m{i}" for i, r in enumerate(data_rules))
        long = wide.selectExpr(f"stack({len(data_rules)}, {rows}) AS (rule, column_name, metric)")
        parts.append(long.withColumn("status", F.when(F.col("metric") == 0, "PASS").otherwise("FAIL")))
    for r in rules:
        if r.by_value:  # counted per value first: no row is copied for each distinct count
            counts = df.filter(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("n"))
            metric = counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("metric"))
            parts.append(metric.select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"), "metric",
                                       F.when(F.col("metric") == 0, "PASS").otherwise("FAIL").alias("status")))
    spark = df.sparkSession
    for r in rules:
        if r.metric is None and not r.by_value:
            n = len(df.columns)
            parts.append(spark.range(1).select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                                               F.lit(n).cast("long").alias("metric"),
                                               F.lit("PASS" if n == r.passes else "FAIL").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
