"""Q02–Q05 duplicates and Q07–Q09, Q19–Q21 lookups."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.operators.dedup import check_duplicates, dedup_keep, duplicate_keys
from tablecheck.operators.evaluate import CheckContext, evaluate
from tablecheck.operators.lookup import add_lookup_marker, lookup_rule, master_filters, rows_lookup

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def _dups(spark):
    return spark.createDataFrame([("a", T1, "f1"), ("A", T2, "f2"), ("A", T3, "f3"), (None, T1, "f1"),
                                  (None, T2, "f2")], "k string, _timestamp timestamp, source_file_name string")


def test_q02_keep_latest_case_insensitive(spark):
    ok, fail = check_duplicates(_dups(spark), [], CheckContext("obj"), uniqueness_col="k", null_pk="group")
    got = sorted((r["k"] or "", r["_timestamp"]) for r in ok.collect())
    assert got == [("", T2), ("A", T3)]
    assert fail.count() == 2  # one report row per duplicated key
    vals = sorted((r["check_column_value"] or "") for r in fail.collect())
    assert vals == ["", "A"]


def test_q02_split_temp_keeps_oldest(spark):
    ok, _ = check_duplicates(_dups(spark), [], CheckContext("x_split_temp"), uniqueness_col="k", null_pk="group")
    got = sorted((r["k"] or "", r["_timestamp"]) for r in ok.collect())
    assert got == [("", T1), ("a", T1)]


def test_q02_blank_null_pk_option(spark):
    df = spark.createDataFrame([(None, "u", T1), (None, "u", T2)], "pk string, k string, _timestamp timestamp")
    ok, _ = check_duplicates(df, ["pk"], uniqueness_col="k", null_pk="blank")
    assert [r["pk"] for r in ok.collect()] == [""]


def test_q02_all_losers_and_identical_rows(spark):
    df = spark.createDataFrame([("a", T1)] * 3 + [("b", T1)], "k string, _timestamp timestamp")
    ok, fail = check_duplicates(df, [], uniqueness_col="k", all_losers=True)
    assert ok.count() == 2 and fail.count() == 2
    ok, fail = check_duplicates(df, [], uniqueness_col="k")
    assert fail.count() == 1


def test_q05_folders_of_a_duplicate(spark):
    _, fail = check_duplicates(_dups(spark), [], uniqueness_col="k", delete_by_path=True)
    got = {(r["check_column_value"] or ""): r["source_file_name_agg"] for r in fail.collect()}
    assert got["A"] == "Raw Folder : f1 -- Duplicates Folder : f2 -- Duplicates Folder : f3"


def test_hot_key_dedup_matches_window(spark):
    # one key holds most rows: result equals the row_number definition
    df = spark.range(20000).select((F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))).alias("k"),
                                   (F.col("id") * 7 % 1000).alias("_timestamp"), F.col("id").alias("v"))
    got = dedup_keep(df, ["k"], "_timestamp")
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy(F.col("_timestamp").desc(), "v")
    exp = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_q04_duplicate_keys(spark):
    d = duplicate_keys(_dups(spark), ["k"], case_insensitive=True)
    assert sorted((r["k"] or "", r["dup_count"]) for r in d.collect()) == [("", 2), ("A", 3)]


def test_q07_q08_lookup_and_tuple_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("z", "b")], "c1 string, c2 string")
    lk = spark.createDataFrame([("a", "b"), ("a", "b")], "c1 string, c2 string")  # repeated key: no fan-out
    data = add_lookup_marker(df, ["c1", "c2"], lk, None, "_m_0")
    ev = evaluate(data, [lookup_rule(["c1", "c2"], "_m_0")])
    assert [tuple(r) for r in ev.ok.collect()] == [("a", "b")]
    assert sorted(r["check_column_value"] for r in ev.fail.collect()) == ["a", "z / b"]
    assert ev.ok.columns == ["c1", "c2"]


def test_q09_schema_rows(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    allowed = rows_lookup(spark, [("x",)], T.StructType([T.StructField("v", T.StringType())]))
    data = add_lookup_marker(df, "c", allowed, "v", "_m_0")
    ev = evaluate(data, [lookup_rule("c", "_m_0")])
    assert [r["c"] for r in ev.ok.collect()] == ["x"] and ev.fail.count() == 2


def test_q20_master_repeat_key_no_multiplication_and_mixed_where(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A")], "k int, flag string")
    master = spark.createDataFrame([(1, 0), (1, 0), (2, 5), (3, 9)], "mk int, lvl int")
    ok, fail = master_filters(df, [dict(filtered_column="k", master=master, curated_column="mk"),
                                   dict(filtered_column="k", master=master, curated_column="mk",
                                        where="lvl < 5 OR flag = 'A'")], CheckContext("o"))
    assert sorted(r["k"] for r in ok.collect()) == [1, 3]
    assert [r["check_column_value"] for r in fail.collect()] == ["2"]


def test_q03_pk_from_config_and_q19_gate_with_observations(spark):
    from tablecheck.operators.checker import TableChecker
    df = spark.createDataFrame([(1, "a", "prod", T1), (1, "a", "prod", T2), (2, "b", "prod", T1)],
                               "k int, u string, environment string, _timestamp timestamp")
    cfg = spark.createDataFrame([("obj", "k"), ("other", "x")], "object_name string, PK string")
    chk = TableChecker(df, "obj", pk_config=cfg)
    ok, fail = chk.check_duplicates_with_PKs(False, ["u"])
    assert ok.count() == 2 and [r["check_column_name"] for r in fail.collect()] == ["Multiple PKs"]
    master = spark.createDataFrame([(1,)], "mk int")
    ok, obs = chk.apply_master_prefilter([dict(filtered_column="k", master=master, curated_column="mk")])
    assert ok.count() == 2 and obs[0].get["rows_in"] == 3
    no_env = TableChecker(df.drop("environment"), "obj")
    same, obs = no_env.apply_master_prefilter([dict(filtered_column="k", master=master, curated_column="mk")])
    assert same.count() == 3 and obs == []


def test_a14_observed_rule_counts(spark):
    from tablecheck.operators import rules as R
    df = spark.createDataFrame([("a",), (None,), ("",)], "c string")
    ev = evaluate(df, [R.null_check("c")], observe=True)
    assert ev.ok.count() == 1
    vals = ev.observation.get
    assert vals["rows"] == 3 and vals["0:check_nulls:c"] == 2


def test_q27_ruleset_schema_and_data_rules(spark):
    from tablecheck.operators import ruleset as RS
    df = spark.createDataFrame([(1, "ab"), (1, None), (2, "abcdef")], "k int, s string")
    out = {r["rule"] + ":" + r["column_name"]: (r["metric"], r["status"]) for r in RS.evaluate_ruleset(df, [
        RS.is_complete("s"), RS.is_unique("k"), RS.column_values("k", ">=", 1),
        RS.column_length_between("s", 1, 3), RS.column_count(2)]).collect()}
    assert out == {"IsComplete:s": (1, "FAIL"), "IsUnique:k": (1, "FAIL"), "ColumnValues >= 1:k": (0, "PASS"),
                   "ColumnLength between 1 and 3:s": (1, "FAIL"), "ColumnCount = 2:*": (2, "PASS")}


def test_lookup_join_is_left_to_the_planner(spark):
    """No hint and no probe: a lookup of unknown size is a plain equi-join."""
    big = spark.range(100).selectExpr("id AS k")
    lookup = spark.range(50).selectExpr("id AS k").repartition(3)
    plan = add_lookup_marker(big, "k", lookup)._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan and "strategy=broadcast" not in plan and "Limit" not in plan


def test_columns_named_like_markers_stay(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, _m_price int")
    data = add_lookup_marker(df, "id", spark.createDataFrame([(1,)], "v int"), "v", "_m_0")
    ev = evaluate(data, [lookup_rule("id", "_m_0")])
    assert ev.ok.columns == ["id", "_m_price"] and [tuple(r) for r in ev.ok.collect()] == [(1, 5)]
    assert '"_m_price":6' in ev.fail.first()["json_row_data"]
    with pytest.raises(ValueError):
        add_lookup_marker(data, "id", df, "id", "_m_0")


def test_q02_null_pk_modes(spark):
    df = spark.createDataFrame([("a", 1), ("A", 2), (None, 1), (None, 2)], "k string, _timestamp int")
    ok, fail = check_duplicates(df, [], uniqueness_col="k", null_pk="fail")
    assert [tuple(r) for r in ok.collect()] == [("A", 2)]
    assert sorted((r["check_passed"], r["check_column_value"]) for r in fail.collect() if r["check_column_value"]) == [("check_duplicates", "a")]
    assert [r["check_passed"] for r in fail.collect() if r["check_column_value"] is None] == ["check_nulls"] * 2
    ok, fail = check_duplicates(df, [], uniqueness_col="k", null_pk="group")
    assert ok.count() == 2 and fail.count() == 2


def test_dedup_order_on_ntz_ignores_the_session_zone(spark):
    """02:30 does not exist in this zone on that day; it is still before 03:30."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT 'a' AS k, TIMESTAMP_NTZ '2024-03-10 02:30:00.000001' AS _timestamp UNION ALL SELECT 'a', TIMESTAMP_NTZ '2024-03-10 03:30:00'")
        got = dedup_keep(df, ["k"]).select(F.col("_timestamp").cast("string")).first()[0]
        ok, _ = check_duplicates(df, [], uniqueness_col="k")
        assert got == "2024-03-10 03:30:00" == ok.select(F.col("_timestamp").cast("string")).first()[0]
        from tablecheck.functions import micros
        assert df.select(micros(df, "_timestamp")).first()[0] == 1710037800000001
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_evaluate_all_equals_the_rule_by_rule_intersection(spark):
    from tablecheck.operators.checker import TableChecker
    df = spark.createDataFrame([("x", "1", 1), ("y", "2", 2), ("z", None, 3), ("x", "3", 4), ("w", "4", 5)], "k string, n string, _timestamp int")
    c = TableChecker(df, "t")
    parts = [c.check_nulls(False, ["n"]), c.check_isin_value(False, [["k", spark.createDataFrame([("x",), ("y",), ("z",)], "k string")]]),
             c.check_duplicates_with_PKs(False, ["k"]), c.check_master_filters([dict(filtered_column="n", master=spark.createDataFrame([("2",), ("3",)], "m string"), curated_column="m")])]
    ev = c.evaluate_all()
    want = c.build_final_output(*[ok for ok, _ in parts])
    assert sorted(map(tuple, ev.ok.collect())) == sorted(map(tuple, want.collect())) == [("x", "3", 4), ("y", "2", 2)]
    got = sorted((r["check_passed"], r["check_column_value"] or "") for r in ev.fail.collect())
    assert got == sorted((r["check_passed"], r["check_column_value"] or "") for _, f in parts for r in f.collect())
    with pytest.raises(ValueError):
        TableChecker(df.drop("n"), "t").evaluate_all()


def test_two_fixes_of_one_column_compose(spark):
    from tablecheck.operators import rules as R
    df = spark.createDataFrame([("",), ("<b>x</b>",), ("y",)], "c string")
    dummy = R.null_check("c", is_warning=True, dummy="N/A")
    fix = R.pattern_check("c", "<b>(.*)</b>", "match_incorrect", remove_marker=True).with_action(R.REPORT)
    assert sorted(r[0] for r in evaluate(df, [dummy, fix]).ok.collect()) == ["N/A", "x", "y"]
    assert sorted(r[0] for r in evaluate(df, [fix, dummy]).ok.collect()) == ["N/A", "x", "y"]


def test_rows_of_all_is_the_intersection(spark):
    """Nulls are equal, repeats of one side count once, columns go by name."""
    from tablecheck.operators.evaluate import rows_of_all
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, 2), ("y", None), (None, None), ("z", 9)], "k string, `n.1` int")
    b = spark.createDataFrame([(1, "x"), (2, None), (None, "y"), (None, None), (8, "z"), (8, "z")], "`n.1` int, k string")
    c = spark.createDataFrame([("x", 1), ("y", None), (None, None), (None, None), ("only", 3)], "k string, `n.1` int")
    want = sorted(map(tuple, a.intersect(b.select("k", "`n.1`")).intersect(c).collect()), key=str)
    for n in (None, 5):
        assert sorted(map(tuple, rows_of_all([a, b, c], n).collect()), key=str) == want == [("x", 1), ("y", None), (None, None)]
    assert rows_of_all([a]).count() == 5 and rows_of_all([a, b.limit(0)]).count() == 0


def test_evaluate_all_deals_a_large_input(spark, tmp_dir, monkeypatch):
    """Keys and whole rows are dealt to as many partitions as the files ask for before a task counts them; the rows stay the same."""
    from tablecheck.operators import checker, dedup
    from tablecheck.sources import ingest
    spark.sql("SELECT IF(id % 7 = 0, NULL, concat(IF(id % 2 = 0, 'k', 'K'), id DIV 2 % 40)) AS k, CAST(id % 5 AS STRING) AS n, id DIV 3 AS _timestamp "
              "FROM range(300)").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    size, cores = ingest.file_bytes(df), spark.sparkContext.defaultParallelism
    assert ingest.file_parts(df) is None and ingest.file_parts(spark.range(9), 1) is None
    assert ingest.file_parts(df, 10) == -(-size // 10) > cores and ingest.file_parts(df, -(-size // cores)) is None
    seen = []
    for parts in (None, 61):
        monkeypatch.setattr(checker, "file_parts", lambda d: parts)
        monkeypatch.setattr(dedup, "file_parts", lambda d: parts)
        c = checker.TableChecker(df, "t")
        c.check_nulls(False, ["n"])
        ok, _ = c.check_duplicates_with_PKs(False, ["k"])
        c.check_master_filters([dict(filtered_column="n", master=spark.createDataFrame([("1",), ("3",)], "m string"), curated_column="m")])
        out = c.evaluate_all().ok
        seen.append((sorted(map(tuple, ok.collect())), sorted(map(tuple, out.collect()))))
        keys, whole = (d._jdf.queryExecution().sparkPlan().toString() for d in (ok, out))
        assert ("61), REPARTITION_BY_NUM" in keys) == (parts == 61) and "REPARTITION_BY" in whole and "<=>" not in whole
        assert [p for p in out._jdf.queryExecution().executedPlan().toString().split("Exchange ") if "REPARTITION_BY_NUM" in p and " 61)" not in p] == []
    assert seen[0] == seen[1] and len(seen[0][0]) > len(seen[0][1]) > 0
