"""A rule-by-rule facade with the reference's method names (Q01–Q28).

Each ``check_*`` returns ``(ok, fail)`` lazily.  Calls are also recorded, so
``evaluate_all()`` can run every recorded row rule fused in one scan; that is
the recommended way to check many rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck import functions as tf
from tablecheck.operators import rules as R
from tablecheck.operators.dedup import check_duplicates
from tablecheck.operators.evaluate import (CheckContext, Evaluation, build_final_fail, build_final_output,
                                           evaluate, free_name, rows_of_all)
from tablecheck.operators.lookup import (add_lookup_marker, config_isin, lookup_rule, master_filters,
                                         rows_lookup)
from tablecheck.sources.ingest import file_parts


def rows_to_delete(df: DataFrame, marker: str = tf.ROW_TO_DELETE_MARKER) -> DataFrame:
    """Q22: rows where any string cell equals the marker (empty DataFrame if none)."""
    return df.filter(tf.any_cell_equals(df.dtypes, marker))


class TableChecker:
    """Checks on one named object.  ``layer`` is 'Silver' or 'Bronze'."""

    def __init__(self, df: DataFrame, name: str, layer: str = "Silver", file_name: str | None = None,
                 folder_path: str | None = None, pk_config: DataFrame | None = None):
        self.ctx = CheckContext(name, layer, file_name, folder_path)
        self.data = df
        self.pk_config = pk_config
        self.recorded: list[R.Rule] = []
        self.lookups: list[tuple] = []            # (marker, columns, lookup, its columns) of recorded lookup rules
        self.set_checks: list[tuple] = []         # (ok, fail) of recorded duplicate and master checks

    @property
    def name(self) -> str:
        return self.ctx.name

    def _run(self, rule: R.Rule, data: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        self.recorded.append(rule)
        ev = evaluate(self.data if data is None else data, [rule], self.ctx)
        return ev.ok, ev.fail

    def _set_check(self, ok: DataFrame, fail: DataFrame) -> tuple[DataFrame, DataFrame]:
        self.set_checks.append((ok, fail))
        return ok, fail

    # -- row rules -----------------------------------------------------------
    def check_nulls(self, is_warning: bool, cols_null: list, dummy: str = ""):
        return self._run(R.null_check(cols_null[0], is_warning, dummy))

    def check_is_number(self, spec: list):
        col, nullable = spec[0], spec[1] == "YES"
        allow_neg = len(spec) > 2 and spec[2] == "YES"
        return self._run(R.number_check(col, nullable, allow_neg))

    def check_is_date(self, spec: list, regex: str | None = None):
        col, nullable = spec[0], spec[1] == "YES"
        fmt = spec[2] if len(spec) > 2 else tf.DATE_FORMAT_DEFAULT
        return self._run(R.date_check(col, nullable, fmt, regex))

    def check_funny_characters(self, cols: list):
        return self._run(R.chars_check(cols[0]))

    def check_correct_pattern(self, column: str, pattern: str, mode: str = "match_correct",
                              remove_marker: bool = False):
        return self._run(R.pattern_check(column, pattern, mode, remove_marker))

    def check_date_generic(self, rule_type: str, column_name: str | None = None, start_col: str | None = None,
                           end_col: str | None = None, months: int = 36, date_format: str = tf.DATE_FORMAT_DEFAULT,
                           as_of=None):
        """Q16/Q17/Q18: a missing column -> all rows pass, empty FAIL."""
        kinds = {"single": ((column_name,), lambda: R.date_single_check(column_name, months, date_format, as_of)),
                 "pair": ((start_col, end_col), lambda: R.date_pair_check(start_col, end_col, date_format))}
        if rule_type not in kinds:
            raise ValueError(f"rule_type is {rule_type!r}; known types: {', '.join(kinds)}")
        columns, rule = kinds[rule_type]
        if not all(columns):
            raise ValueError(f"a {rule_type} date rule names {len(columns)} column(s); got {columns}")
        if not set(columns) <= set(self.data.columns):
            return self.data, self._empty_report()
        return self._run(rule())

    # -- set rules -------------------------------------------------------------
    def check_isin_value(self, is_warning: bool, spec: list, keep_in_successful_output: bool = False):
        """Q06–Q10: spec[0] = [column(s), values] or [column, rows, StructType]."""
        item = spec[0]
        column, values = item[0], item[1]
        if len(item) == 3:
            values = rows_lookup(self.data.sparkSession, values, item[2])
            if len(values.columns) != 1:
                raise ValueError("schema-typed values need exactly one field")
            lookup_cols = values.columns[0]
        elif len(item) > 3:
            raise ValueError("isin spec has at most three items")
        else:
            lookup_cols = None
        if isinstance(values, DataFrame):
            marker = free_name(self.data, f"_m_isin{len(self.lookups)}")
            self.lookups.append((marker, column, values, lookup_cols))
            data = add_lookup_marker(self.data, column, values, lookup_cols, marker)
            return self._run(lookup_rule(column, marker, is_warning, keep_in_successful_output), data)
        return self._run(R.isin_check(column, values, is_warning, keep_in_successful_output))

    def check_duplicates_with_PKs(self, is_warning: bool, cols_uniqueness: list, PK_values: list | None = None,
                                  delete_by_path: bool = False, order_col: str = "_timestamp",
                                  null_pk: str = "fail", all_losers: bool = False):
        keys = list(PK_values or self._pks_from_config())
        return self._set_check(*check_duplicates(
            self.data, keys, self.ctx, uniqueness_col=cols_uniqueness[0], order_col=order_col,
            is_warning=is_warning, null_pk=null_pk, all_losers=all_losers, delete_by_path=delete_by_path))

    def _pks_from_config(self) -> list[str]:
        """Q03: PK list from the (small) config table for this object."""
        if self.pk_config is None:
            return []
        rows = self.pk_config.filter(F.col("object_name") == self.name).select("PK").collect()
        return [r["PK"] for r in rows]

    def apply_master_prefilter(self, rules: list[dict], env_col: str = "environment"):
        """Q19: keep only rows present in every configured master — applied only
        when the object carries an ``environment`` column (as the reference
        gates it).  Row counts per step come from Observations, not counts."""
        if env_col not in self.data.columns or not rules:
            return self.data, []
        observations: list = []
        ok, _ = master_filters(self.data, rules, self.ctx, with_json=False, observations=observations)
        self.data = ok
        return ok, observations

    def check_master_filters(self, rules: list[dict]):
        if not rules:
            return self.data, self._empty_report()
        return self._set_check(*master_filters(self.data, rules, self.ctx))

    def apply_bronze_isin_checks(self, spark: SparkSession, config: DataFrame, tables: dict | None = None):
        return config_isin(self.data, spark, config, self.ctx, tables)

    def check_row_to_delete(self) -> DataFrame:
        return rows_to_delete(self.data)

    # -- assembly ----------------------------------------------------------------
    def evaluate_all(self, **kw) -> Evaluation:
        """Everything recorded: row and lookup rules fused in one pass; duplicate and master checks
        narrow the rows that may pass (set semantics, as the intersection of their outputs) and
        add their reports.  A recorded rule whose column is gone is an error."""
        marked, markers = self.data, set()
        for marker, column, lookup, lookup_cols in self.lookups:
            marked = add_lookup_marker(marked, column, lookup, lookup_cols, marker)
            markers.add(marker)
        if not self.recorded and not self.set_checks:
            raise ValueError("no rule was recorded")
        for r in self.recorded:
            if unknown := set(r.needs) - set(marked.columns):
                raise ValueError(f"rule {r.flag} on {r.column} needs {sorted(unknown)}")
        rules = self.recorded or [R.expectation("none", F.lit(True))]
        ev = evaluate(marked, rules, self.ctx, **kw)
        if not self.set_checks:
            return ev
        passed = rows_of_all([self.data, *[ok for ok, _ in self.set_checks]], file_parts(self.data))
        for marker, column, lookup, lookup_cols in self.lookups:
            passed = add_lookup_marker(passed, column, lookup, lookup_cols, marker)
        fail = ev.fail
        for _, f in self.set_checks:
            if f is not None:
                fail = fail.unionByName(f.select(*[c for c in fail.columns if c in f.columns]), allowMissingColumns=True)
        return Evaluation(ok=evaluate(passed, rules, self.ctx, **kw).ok, fail=fail, tagged=ev.tagged,
                          observation=ev.observation)

    def build_final_output(self, *oks: DataFrame, distinct: bool = True) -> DataFrame:
        return build_final_output(*oks, distinct=distinct)

    def build_final_fail(self, *fails: DataFrame) -> DataFrame:
        return build_final_fail(*fails, file_name=self.ctx.file_name, folder_path=self.ctx.folder_path)

    def _empty_report(self) -> DataFrame:
        ev = evaluate(self.data.limit(0), [R.expectation("none", F.lit(True))], self.ctx)
        return ev.fail
