"""Allowed-value lookups and master-data filters.

Lookups are joins, never ``collect()`` + ``isin``: the allowed values can be a
whole dimension.  They are plain equi-joins on distinct keys: Catalyst and AQE
choose a broadcast or a sort-merge join from the sizes they know or measure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck import functions as tf
from tablecheck.operators.evaluate import CheckContext, _idpipeline, free_name, json_row
from tablecheck.operators.rules import CRITICAL, FLAG_ISIN, FLAG_MASTER, Rule, marker_rule

def add_lookup_marker(df: DataFrame, columns: str | list[str], lookup: DataFrame,
                      lookup_columns: str | list[str] | None = None, marker: str = "_m_0") -> DataFrame:
    """Add boolean ``marker``: the row's (tuple of) column value(s) is in ``lookup``.

    Null in any key part never matches (D11/D12).  The lookup is reduced to
    distinct keys first, so the left join cannot multiply rows.
    """
    if marker in df.columns:
        raise ValueError(f"column {marker!r} exists already; pass another marker name")
    cols = [columns] if isinstance(columns, str) else list(columns)
    lcols = cols if lookup_columns is None else ([lookup_columns] if isinstance(lookup_columns, str)
                                                 else list(lookup_columns))
    keys = (lookup.select(*[F.col(c).alias(f"__lk{i}") for i, c in enumerate(lcols)])
            .where(reduce(lambda a, b: a & b, [F.col(f"__lk{i}").isNotNull() for i in range(len(lcols))]))
            .distinct()
            .withColumn(marker, F.lit(True)))
    cond = reduce(lambda a, b: a & b, [df[c] == keys[f"__lk{i}"] for i, c in enumerate(cols)])
    out = df.join(keys, cond, "left")
    return out.drop(*[f"__lk{i}" for i in range(len(lcols))]) \
              .withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def lookup_rule(columns: str | list[str], marker: str = "_m_0", is_warning: bool = False,
                keep_in_successful_output: bool = False) -> Rule:
    """Q07/Q08 rule over the marker added by ``add_lookup_marker``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    name = tf.COMPOSITE_VALUE_SEP.join(cols)
    value = F.concat_ws(tf.COMPOSITE_VALUE_SEP, *[F.col(c).cast("string") for c in cols]) \
        if len(cols) > 1 else F.col(cols[0])
    return marker_rule(FLAG_ISIN, name, marker, value, is_warning, keep_in_successful_output)


def rows_lookup(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Q09: allowed values given as typed rows."""
    if not isinstance(schema, T.StructType):
        raise ValueError("schema-typed allowed values need a StructType")
    return spark.createDataFrame(rows, schema)


def semi_anti(df: DataFrame, column: str, lookup: DataFrame, lookup_column: str | None = None,
              condition: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with a match, rows without) — no row multiplication.

    ``condition`` may name columns of either side (D22): it becomes part of
    the semi/anti join condition.
    """
    lk = lookup.alias("__m")
    cond = df[column] == F.col(f"__m.{lookup_column or column}")
    if condition is not None:
        cond = cond & (F.expr(condition) if isinstance(condition, str) else condition)
    return df.join(lk, cond, "left_semi"), df.join(lk, cond, "left_anti")


def master_filters(df: DataFrame, rules: list[dict], ctx: CheckContext | None = None,
                   with_json: bool = True, extra_cols: list[str] | None = None,
                   observations: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Q20 (and Q19 without the report). Sequential master filters.

    Each rule is a dict: ``filtered_column``, ``master`` (DataFrame),
    ``curated_column``, optional ``where`` (SQL text on master and/or data
    columns).  Rows surviving rule i go on to rule i+1; rows losing at rule i
    are reported under that rule.  Returns (ok, fail report).
    """
    ctx = ctx or CheckContext()
    original = list(df.columns)
    current, fails, step = df, [], 0
    while step < len(rules):
        # Rules whose masters stand alone become markers of one pass: one join per master, and the first marker that is missing names
        # the rule.  A condition on columns of both sides is a step of its own.
        alone = step
        while alone < len(rules) and not _two_sided(rules[alone], current):
            alone += 1
        if alone == step:
            rule = rules[step]
            current = _counted(current, ctx, step, F.lit(True), observations)
            current, lose = semi_anti(current, rule["filtered_column"], rule["master"], rule["curated_column"], rule["where"])
            fails.append(_master_report(lose, F.lit(rule["filtered_column"]), F.col(rule["filtered_column"]), df, original, ctx, with_json, extra_cols))
            step += 1
            continue
        flagged, markers = current, []
        for i in range(step, alone):
            rule, marker = rules[i], free_name(flagged, f"_m_master{i}")
            master = rule["master"].filter(rule["where"]) if rule.get("where") else rule["master"]
            flagged = add_lookup_marker(flagged, rule["filtered_column"], master, rule["curated_column"], marker)
            markers.append(marker)
        for i in range(step, alone):
            before = reduce(lambda a, b: a & b, [F.col(m) for m in markers[:i - step]], F.lit(True))
            flagged = _counted(flagged, ctx, i, before, observations)
        passed = reduce(lambda a, b: a & b, [F.col(m) for m in markers])
        name = reduce(lambda a, x: a.when(~F.col(x[1]), F.lit(x[0]["filtered_column"])), zip(rules[step:alone], markers), F.when(F.lit(False), ""))
        value = reduce(lambda a, x: a.when(~F.col(x[1]), F.col(x[0]["filtered_column"]).cast("string")), zip(rules[step:alone], markers), F.when(F.lit(False), ""))
        fails.append(_master_report(flagged.filter(~passed), name, value, df, original, ctx, with_json, extra_cols))
        current, step = flagged.filter(passed).drop(*markers), alone
    fail = reduce(DataFrame.unionByName, fails) if fails else None
    return current, fail


def _two_sided(rule: dict, data: DataFrame) -> bool:
    return bool(rule.get("where")) and _names_other_side(rule["where"], data, rule["master"])


def _counted(df: DataFrame, ctx: CheckContext, i: int, entering: Column, observations: list | None) -> DataFrame:
    """The rows that enter rule ``i``, counted by the job that runs anyway."""
    if observations is None:
        return df
    from pyspark.sql import Observation
    obs = Observation(f"master_{ctx.name}_{i}_{id(observations)}")
    observations.append(obs)
    return df.observe(obs, F.count(F.when(entering, F.lit(1))).alias("rows_in"))


def _master_report(rows: DataFrame, name: Column, value: Column, df: DataFrame, original: list[str], ctx: CheckContext,
                   with_json: bool, extra_cols: list[str] | None) -> DataFrame:
    return rows.select(
        F.lit(ctx.name).alias("object_name"),
        F.lit(FLAG_MASTER).alias("check_passed"),
        name.alias("check_column_name"),
        value.cast("string").alias("check_column_value"),
        F.lit(CRITICAL).alias("error_type"),
        _idpipeline(df).alias("idpipeline"),
        *([json_row(original).alias("json_row_data")] if with_json else []),
        *[F.col(c) for c in (extra_cols or [])])


def _names_other_side(condition: str, data: DataFrame, master: DataFrame) -> bool:
    """True if the condition mentions a data column the master does not have."""
    import re
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", re.sub(r"'[^']*'", "", condition)))
    only_data = set(data.columns) - set(master.columns)
    return bool(words & only_data)


def config_lookup(spark: SparkSession, config_row: dict, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """One allowed-values set from a config row = lookup table values ∪ literals.

    ``allowed_values`` is a ', '-separated list; it becomes rows through
    ``explode(split())`` — never spliced into SQL text (D25)."""
    bronze_col = config_row["bronze_column"]
    parts = []
    lookup_name = config_row.get("lookup_object_against")
    if lookup_name:
        src = (tables or {}).get(lookup_name)
        if src is None:
            src = spark.table(lookup_name)
        where = config_row.get("object_where_condition")
        if where:
            src = src.filter(where)
        parts.append(src.select(F.col(config_row["lookup_column"]).cast("string").alias(bronze_col)))
    allowed = config_row.get("allowed_values")
    if allowed:
        lit_df = spark.range(1).select(F.explode(F.split(F.lit(allowed), ", ")).alias(bronze_col))
        parts.append(lit_df)
    if not parts:
        raise ValueError(f"config row for {bronze_col} has neither lookup nor allowed values")
    return reduce(DataFrame.unionByName, parts).distinct()


def config_isin(df: DataFrame, spark: SparkSession, config: DataFrame, ctx: CheckContext,
                tables: dict[str, DataFrame] | None = None, with_json: bool = True,
                extra_cols: list[str] | None = None):
    """Q21. Config-driven allowed-values checks for the object ``ctx.name``.

    The config is small (rule metadata) and is collected; the data never is.
    All lookups become markers on one pass and one fused evaluation."""
    from tablecheck.operators.evaluate import evaluate

    rows = [r.asDict() for r in config.filter(F.col("bronze_sink_table_name") == ctx.name).collect()]
    if not rows:
        return df, None
    data = df
    rules = []
    for i, row in enumerate(rows):
        lk = config_lookup(spark, row, tables)
        m = free_name(data, f"_m_cfg{i}")
        data = add_lookup_marker(data.withColumn("__cast", F.col(row["bronze_column"]).cast("string")),
                                 "__cast", lk, row["bronze_column"], m).drop("__cast")
        rules.append(lookup_rule(row["bronze_column"], m))
    ev = evaluate(data, rules, ctx, with_json=with_json, extra_cols=extra_cols)
    return ev.ok, ev.fail
