"""Golden rows for the row rules (FIXTURES.md §D) and the fused evaluator."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import rules as R
from tablecheck.operators.evaluate import (CheckContext, build_final_fail, evaluate, fail_counts_long,
                                           rule_fail_counts)
from tablecheck.operators.checker import TableChecker, rows_to_delete


def _flags(spark, values, rule_fn, col="c"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {col} string")
    ev = evaluate(df, [rule_fn(col)], CheckContext("t"))
    bad_ids = {r["id"] for r in df.filter(~F.coalesce(rule_fn(col).bad, F.lit(False))).select("id").collect()}
    ok_ids = {r["id"] for r in ev.ok.select("id").collect()}
    assert ok_ids == bad_ids  # OK output = rows without violation
    return ["OK" if i in ok_ids else "FAIL" for i in range(len(values))], ev


def test_q01_null_blank(spark):
    flags, ev = _flags(spark, [None, "", " ", "x"], R.null_check)
    assert flags == ["FAIL", "FAIL", "OK", "OK"]
    assert ev.fail.count() == 2


def test_q01_warning_keeps_rows_and_does_not_touch_data(spark):
    df = spark.createDataFrame([(1, None), (2, "FAIL")], "id int, c string")
    ev = evaluate(df, [R.null_check("c", is_warning=True, dummy="N/A")], CheckContext("t"))
    assert sorted(tuple(r) for r in ev.ok.collect()) == [(1, "N/A"), (2, "FAIL")]
    rep = ev.fail.collect()
    assert len(rep) == 1 and rep[0]["error_type"] == "WARNING" and rep[0]["check_passed"] == "check_nulls_warning"


def test_q06_isin(spark):
    flags, _ = _flags(spark, ["a", "z", None], lambda c: R.isin_check(c, ["a", "b"]))
    assert flags == ["OK", "FAIL", "FAIL"]


def test_q10_keep_in_successful_output(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z")], "id int, c string")
    ev = evaluate(df, [R.isin_check("c", ["a"], keep_in_successful_output=True)])
    assert ev.ok.count() == 2 and ev.fail.count() == 1


def test_q11_number(spark):
    vals = ["1", "1.", ".5", "-1", "+1", "1e3", ".", "1,000", " 1"]
    flags, _ = _flags(spark, vals, lambda c: R.number_check(c, nullable=True, allow_negative=False))
    assert flags == ["OK", "OK", "OK", "FAIL", "FAIL", "FAIL", "FAIL", "FAIL", "FAIL"]
    flags, _ = _flags(spark, ["-.5", "-1"], lambda c: R.number_check(c, allow_negative=True))
    assert flags == ["OK", "OK"]


def test_q11_nullable_switch(spark):
    flags, _ = _flags(spark, [None, ""], lambda c: R.number_check(c, nullable=True))
    assert flags == ["OK", "OK"]
    flags, _ = _flags(spark, [None, ""], lambda c: R.number_check(c, nullable=False))
    assert flags == ["FAIL", "FAIL"]


def test_q12_date(spark):
    flags, _ = _flags(spark, ["2024.01.05", "2024.13.40", "2024-01-05", "0999.01.01"], R.date_check)
    assert flags == ["OK", "FAIL", "FAIL", "FAIL"]


def test_q12_custom_format_is_not_a_regex(spark):
    flags, _ = _flags(spark, ["05/01/2024", "2024.01.05"], lambda c: R.date_check(c, fmt="dd/MM/yyyy"))
    assert flags == ["OK", "FAIL"]


def test_q13_forbidden_chars(spark):
    flags, _ = _flags(spark, ["a^b", "a;b", "a,b", "a|b", "a\\b", None], R.chars_check)
    assert flags == ["FAIL"] * 4 + ["OK", "OK"]


def test_q14_pattern_null(spark):
    flags, _ = _flags(spark, [None], lambda c: R.pattern_check(c, "x", "match_correct"))
    assert flags == ["FAIL"]
    flags, _ = _flags(spark, [None], lambda c: R.pattern_check(c, "x", "match_incorrect"))
    assert flags == ["OK"]


def test_q15_marker_removed_once(spark):
    df = spark.createDataFrame([("2024.01.05",)], "c string")
    ev = evaluate(df, [R.pattern_check("c", r"(\d+)\.", remove_marker=True)])
    assert ev.ok.first()["c"] == "20240105"


def test_q16_single_date(spark):
    rule = lambda c: R.date_single_check(c, months=1, as_of=dt.date(2024, 1, 31))
    flags, _ = _flags(spark, ["2024.02.29", "2024.03.01", None], rule)
    assert flags == ["OK", "FAIL", "FAIL"]


def test_q17_date_pair(spark):
    df = spark.createDataFrame([(0, "2024.01.01", "2024.01.02"), (1, "2024.01.02", "2024.01.02"),
                                (2, "2024.01.03", "2024.01.02"), (3, None, "2024.01.02")], "id int, s string, e string")
    ev = evaluate(df, [R.date_pair_check("s", "e")])
    assert sorted(r["id"] for r in ev.ok.collect()) == [0, 1]
    vals = sorted(r["check_column_value"] for r in ev.fail.collect())
    assert vals == ["2024.01.02", "2024.01.03 | 2024.01.02"]


def test_q18_missing_column_passes_all(spark):
    df = spark.createDataFrame([(1,)], "id int")
    ok, fail = TableChecker(df, "t").check_date_generic("single", column_name="nope")
    assert ok.count() == 1 and fail.count() == 0
    with pytest.raises(ValueError):
        TableChecker(df, "t").check_date_generic("weird", column_name="id")


def test_q22_only_string_cells_match(spark):
    df = spark.createDataFrame([(1, "row_to_delete"), (2, "keep")], "n int, s string")
    assert [r["n"] for r in rows_to_delete(df).collect()] == [1]


def test_q24_existing_file_key_replaced(spark):
    df = spark.createDataFrame([("x", None)], "file string, c string")
    ev = evaluate(df, [R.null_check("c")], CheckContext("t"))
    out = build_final_fail(ev.fail, file_name="f.parquet", folder_path="/p").first()["json_row_data"]
    assert '"file":"f.parquet"' in out and '"path":"/p"' in out and '"x"' not in out


def test_empty_input_keeps_schemas(spark):
    df = spark.createDataFrame([], "a string, b string")
    ev = evaluate(df, [R.null_check("a"), R.chars_check("b")])
    assert ev.ok.count() == 0 and ev.fail.count() == 0
    assert ev.ok.columns == ["a", "b"]
    assert ev.fail.columns[:6] == ["object_name", "check_passed", "check_column_name", "check_column_value",
                                   "error_type", "idpipeline"]


def test_fused_equals_rule_by_rule(spark):
    from tablecheck.plans.fixtures import f1
    from tablecheck.plans.dq_queries import _rules_main
    df = f1(spark, "/root/testdata/sf0.001")
    rules = _rules_main()
    fused = evaluate(df, rules).fail.groupBy("check_passed").count()
    single = {r.flag: evaluate(df, [r]).fail.count() for r in rules}
    assert {r["check_passed"]: r["count"] for r in fused.collect()} == single
    # property: every input row is in OK or has at least one blocking violation
    ok = evaluate(df, rules).ok.count()
    blocked = rule_fail_counts(df, rules).first()["n_blocked"]
    assert ok + blocked == df.count() == 1529


def test_fail_counts_match_fixture_table(spark):
    from tablecheck.plans.fixtures import f1
    df = f1(spark, "/root/testdata/sf0.001")
    rules = [R.null_check("cust_id"), R.isin_check("status", ["F", "O", "P"]), R.number_check("price_txt"),
             R.number_check("price_txt", nullable=False, allow_negative=True), R.date_check("order_date"),
             R.date_check("order_date", nullable=False), R.date_pair_check("order_date", "end_date"),
             R.chars_check("note")]
    got = [r["n_fail"] for r in fail_counts_long(df, rules).collect()]
    assert got == [34, 35, 67, 67, 39, 78, 99, 26]


def test_checker_facade(spark):
    df = spark.createDataFrame([("a", "1"), ("", "x")], "k string, n string")
    chk = TableChecker(df, "obj")
    ok1, f1_ = chk.check_nulls(False, ["k"])
    ok2, f2 = chk.check_is_number(["n", "YES"])
    assert ok1.count() == 1 and f2.count() == 1
    assert chk.evaluate_all().ok.count() == 1
    assert chk.build_final_output(ok1, ok2).count() == 1
    assert chk.build_final_fail(f1_, f2).count() == 2
