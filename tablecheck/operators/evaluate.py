"""Fused rule evaluation (Q23–Q26): many rules, one scan, OK rows + FAIL report.

Plan shape for k row rules over one input:

* OK   = ``Filter(NOT (bad_1 AND blocking_1) AND ...)`` + projection applying
  value fixes — a single codegen stage over the scan, no array, no shuffle.
* FAIL = ``Filter(bad_1 OR ... OR bad_k)`` then ``inline`` of an array of the
  violated rules — the array is only built for failing rows.

Both are lazy DataFrames over the same input; writing both scans the input
twice unless ``persist=True`` (a column-pruned Parquet scan is usually cheaper
than caching 100 TB).  ``Observation`` gives per-rule counts without extra
actions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablecheck.operators.rules import BLOCK, DROP, REPORT, Rule

REPORT_COLUMNS = ["object_name", "check_passed", "check_column_name", "check_column_value",
                  "error_type", "idpipeline", "json_row_data"]
SYSTEM_ID_COLUMNS = ("_temp_unique_id",)


@dataclass
class CheckContext:
    """Who is being checked: object name, layer and (for the report) file/path."""
    name: str = "object"
    layer: str = "Silver"
    file_name: str | None = None
    folder_path: str | None = None

    def __post_init__(self):
        if self.layer not in ("Silver", "Bronze"):
            raise ValueError("layer must be 'Silver' or 'Bronze'")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def _idpipeline(df: DataFrame) -> Column:
    return F.col("idpipeline").cast("string") if "idpipeline" in df.columns else F.lit(None).cast("string")


def json_row(columns: list[str]) -> Column:
    """JSON text of the row's original columns (nulls written as null)."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def with_row_id(df: DataFrame, name: str = SYSTEM_ID_COLUMNS[0]) -> DataFrame:
    """A random UUID per row, for joins back within one run.  It is a system column: the
    evaluator leaves it out of OK, of the report's JSON and of every comparison of rows."""
    return df.withColumn(name, F.expr("uuid()"))


def _violation_struct(r: Rule) -> Column:
    """Q25: the check tag of one violation (rule flag, column, value as text, severity)."""
    return F.struct(
        F.lit(r.flag).alias("check_passed"),
        F.lit(r.column).alias("check_column_name"),
        r.value.cast("string").alias("check_column_value"),
        F.lit(r.error_type).alias("error_type"),
    )


def _bad(r: Rule) -> Column:
    return F.coalesce(r.bad, F.lit(False))


def ok_predicate(rules: list[Rule]) -> Column:
    """True where no blocking/dropping rule is violated."""
    stoppers = [~_bad(r) for r in rules if r.action in (BLOCK, DROP)]
    return reduce(and_, stoppers) if stoppers else F.lit(True)


def fail_predicate(rules: list[Rule]) -> Column:
    reported = [_bad(r) for r in rules if r.action in (BLOCK, REPORT)]
    return reduce(or_, reported) if reported else F.lit(False)


def apply_fixes(df: DataFrame, rules: list[Rule], columns: list[str]) -> DataFrame:
    """Value edits (warning dummy, marker removal) on OK rows, keeping column order.

    Rules never see edits.  Fixes of one column compose in rule order: a fix is a
    function of the column, and a later one works on what the earlier ones left."""
    fixed: dict[str, Column] = {}
    for r in rules:
        for name, fix in r.fixes:
            fixed[name] = fix(fixed.get(name, F.col(f"`{name}`")))
    return df.select(*[fixed[c].alias(c) if c in fixed else F.col(f"`{c}`") for c in columns])


@dataclass
class Evaluation:
    ok: DataFrame
    fail: DataFrame
    tagged: DataFrame
    observation: Observation | None = None


def evaluate(df: DataFrame, rules: list[Rule], ctx: CheckContext | None = None,
             observe: bool = False, with_json: bool = True, persist: bool = False,
             extra_cols: list[str] | None = None, fence: bool = True) -> Evaluation:
    """Evaluate all rules in one pass (``observe`` counts rows and
    violations per rule with an Observation instead of extra count jobs).

    OK has exactly the input columns (minus system ids) in input order.
    FAIL has the report schema ``REPORT_COLUMNS``: one row per (row, violated rule).
    """
    ctx = ctx or CheckContext()
    if not rules:
        raise ValueError("evaluate() needs at least one rule")
    columns = [c for c in df.columns if c not in SYSTEM_ID_COLUMNS]
    markers = {r.marker for r in rules if r.marker}
    data_columns = [c for c in columns if c not in markers]

    src = df
    if fence:
        # Optimisation fence: the rule flags are computed in one projection
        # together with a nondeterministic column that the filters reference,
        # so Catalyst cannot push the predicates below the input's projection.
        # Each flag (and each computed input column, and each parse shared by
        # several rules) is then evaluated once per row — the projection gets
        # common-subexpression elimination — instead of once per reference.
        # Costs one int per row; filters meant for the scan belong before evaluate().
        src = src.select("*", F.spark_partition_id().alias("__fence"),
                         *[_bad(r).alias(f"__b{i}") for i, r in enumerate(rules)])
        flags = [F.col(f"__b{i}") for i in range(len(rules))]
    else:
        flags = [_bad(r) for r in rules]
    obs = None
    if observe:
        obs = Observation(f"tablecheck_{ctx.name}")
        aggs = [F.count(F.lit(1)).alias("rows")]
        aggs += [F.sum(f.cast("long")).alias(f"{i}:{r.flag}:{r.column}") for i, (r, f) in enumerate(zip(rules, flags))]
        src = src.observe(obs, *aggs)
    if persist:
        src = src.persist()

    gate = (F.col("__fence") >= 0) if fence else F.lit(True)
    stop = [~f for r, f in zip(rules, flags) if r.action in (BLOCK, DROP)]
    ok_pred = reduce(and_, stop) if stop else F.lit(True)
    ok = apply_fixes(src.filter(ok_pred & gate), rules, data_columns)

    reported = [(r, f) for r, f in zip(rules, flags) if r.action in (BLOCK, REPORT)]
    # One array slot per reported rule, null where the rule holds; exploded
    # and null-filtered (plain Generate + Filter, no higher-order function).
    if reported:
        vio = F.array(*[F.when(f, _violation_struct(r)) for r, f in reported])
        fail_pred = reduce(or_, [f for _, f in reported])
    else:  # only DROP rules: the report is empty but keeps its schema
        vio = F.array(F.lit(None).cast("struct<check_passed:string,check_column_name:string,"
                                       "check_column_value:string,error_type:string>"))
        fail_pred = F.lit(False)
    failing = src.filter(fail_pred & gate)
    carried = [_idpipeline(df).alias("idpipeline")]
    if with_json:  # built once per failing row, before the explode
        carried.append(json_row(data_columns).alias("json_row_data"))
    carried += [F.col(f"`{c}`") for c in (extra_cols or [])]
    report_cols = [
        F.lit(ctx.name).alias("object_name"),
        F.col("v.check_passed"), F.col("v.check_column_name"), F.col("v.check_column_value"),
        F.col("v.error_type"), "idpipeline",
    ]
    if with_json:
        report_cols.append("json_row_data")
    report_cols += [F.col(f"`{c}`") for c in (extra_cols or [])]
    fail = (failing
            .select(*carried, F.explode(vio).alias("v"))
            .filter(F.col("v").isNotNull())
            .select(*report_cols))
    return Evaluation(ok=ok, fail=fail, tagged=src, observation=obs)


def rule_fail_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One aggregate row: total rows + violations per rule, in one scan.

    This is the flagship single-pass summary; with k rules it costs one scan
    and one partial aggregate (map-side combine), whatever k is.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for r in rules:
        aggs.append(F.sum(_bad(r).cast("long")).alias(f"{r.flag}__{_safe(r.column)}"))
    aggs.append(F.sum((~ok_predicate(rules)).cast("long")).alias("n_blocked"))
    return df.agg(*aggs)


def fail_counts_long(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per-rule failure counts as rows (check_passed, check_column_name, n_fail).

    Computed as one wide aggregate then unpivoted with ``stack`` — still one
    scan, never an explode of the data."""
    wide = df.agg(*[F.sum(_bad(r).cast("long")).alias(f"c{i}") for i, r in enumerate(rules)])
    parts = ", ".join(f"'{r.flag}', '{r.column}', coalesce(c{i}, 0L)" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {parts}) AS (check_passed, check_column_name, n_fail)")


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def enrich_report(fail: DataFrame, file_name: str | None, folder_path: str | None) -> DataFrame:
    """Q24 enrichment: add ``file`` and ``path`` keys to json_row_data.

    Existing ``file``/``path`` keys are replaced (the enriched value wins);
    values go in as literals, never spliced into SQL text."""
    m = F.from_json(F.col("json_row_data"), "map<string,string>")
    m = F.map_filter(m, lambda k, v: ~k.isin("file", "path"))
    extra = F.create_map(F.lit("file"), F.lit(file_name).cast("string"),
                         F.lit("path"), F.lit(folder_path).cast("string"))
    return fail.withColumn("json_row_data", F.to_json(F.map_concat(m, extra)))


def build_final_fail(*fails: DataFrame, file_name: str | None = None,
                     folder_path: str | None = None) -> DataFrame:
    """Q24 (U03, U05). Union of reports by name, duplicates dropped, JSON enriched."""
    if not fails:
        raise ValueError("build_final_fail needs at least one report")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fails)
    out = out.dropDuplicates()
    return enrich_report(out, file_name, folder_path)


def build_final_output(*oks: DataFrame, distinct: bool = True) -> DataFrame:
    """Q23 set form (U01): intersection of OK outputs (set semantics when ``distinct``).

    Prefer ``evaluate(...).ok`` (one pass, row semantics).  This helper is kept
    for callers that combine outputs of separate checks."""
    drop = ["check_value", "check_passed", "check_column_name", *SYSTEM_ID_COLUMNS]
    out = oks[0].drop(*drop)
    for other in oks[1:]:
        other = other.drop(*drop)
        out = out.intersect(other) if distinct else out.intersectAll(other)
    return out


def rows_of_all(sides: list[DataFrame], n_partitions: int | None = None) -> DataFrame:
    """The distinct rows of the first side that every other side holds too (columns by name, nulls equal): their intersection, by one
    shuffle of all sides instead of a distinct and a join of whole rows for each.

    The rows are dealt before they are counted: whole rows hardly repeat within a task of the scan, whose table of them would hold
    all that it reads."""
    columns, side = sides[0].columns, free_name(sides[0], "_m_side")
    every = [F.col(f"`{c}`") for c in columns]
    rows = reduce(DataFrame.unionByName, [d.select(*every, F.lit(i).alias(side)) for i, d in enumerate(sides)])
    dealt = rows.repartition(n_partitions, *every) if n_partitions else rows.repartition(*every)
    held = [F.max(F.col(side) == i).alias(f"{side}{i}") for i in range(len(sides))]
    return dealt.groupBy(*every).agg(*held).filter(reduce(and_, [F.col(f"{side}{i}") for i in range(len(sides))])).select(*every)


def split_ok_fail(tagged: DataFrame, flag_col: str = "check_value"):
    """Q26. Two filters over one plan on a tagged ``check_value`` column."""
    return tagged.filter(F.col(flag_col) == "OK"), tagged.filter(F.col(flag_col) == "FAIL")
