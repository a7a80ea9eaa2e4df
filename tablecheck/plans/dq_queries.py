"""Data-quality queries (Q01–Q34) over the dirty order feed F1 and the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.operators import rules as R
from tablecheck.operators.dedup import check_duplicates, duplicate_keys
from tablecheck.operators.evaluate import CheckContext, evaluate, fail_counts_long
from tablecheck.operators.lookup import (add_lookup_marker, config_isin, lookup_rule, master_filters,
                                         rows_lookup)
from tablecheck.operators.reconcile import layer_stats, quarantine_split, reconcile_counts, threshold_status
from tablecheck.plans.fixtures import F1_COLUMNS, f1, f1_cte, table
from tablecheck.plans.registry import query

OBJ = "orders_feed"
CTX = CheckContext(OBJ)
F1 = f1_cte()
JSON = "json_object(" + ", ".join(f"'{c}', {c}" for c in F1_COLUMNS) + ")"
COLS = ", ".join(F1_COLUMNS)


def _report_sql(flag: str, colname: str, value: str, where: str, sev: str = "CRITICAL") -> str:
    return (f"SELECT '{OBJ}' AS object_name, '{flag}' AS check_passed, '{colname}' AS check_column_name, "
            f"CAST({value} AS VARCHAR) AS check_column_value, '{sev}' AS error_type, "
            f"CAST(NULL AS VARCHAR) AS idpipeline, {JSON} AS json_row_data FROM f1 WHERE {where}")


# DuckDB texts of each rule's violation predicate (mirror of tablecheck.operators.rules)
SQL_NULL = "(cust_id IS NULL OR cust_id = '')"
SQL_ISIN = "NOT coalesce(status IN ('F', 'O', 'P'), false)"
SQL_NUMBER = ("(NOT (price_txt IS NULL OR price_txt = '') AND NOT coalesce(regexp_matches(price_txt, "
              "'^(\\d+(\\.\\d*)?|\\.\\d+)$'), false))")
SQL_NUMBER_STRICT = ("(price_txt IS NULL OR price_txt = '' OR NOT coalesce(regexp_matches(price_txt, "
                     "'^-?(\\d+(\\.\\d*)?|\\.\\d+)$'), false))")
_DATE_OK = ("coalesce(regexp_matches(order_date, '^[1-9]\\d{3}\\.\\d{2}\\.\\d{2}$') "
            "AND try_strptime(order_date, '%Y.%m.%d') IS NOT NULL, false)")
SQL_DATE = f"(NOT (order_date IS NULL OR order_date = '') AND NOT {_DATE_OK})"
SQL_DATE_STRICT = f"(order_date IS NULL OR order_date = '' OR NOT {_DATE_OK})"
SQL_CHARS = "coalesce(regexp_matches(note, '[\\^;,|]'), false)"
SQL_PATTERN = "NOT coalesce(regexp_matches(order_id, '^ORD\\d+$'), false)"
_PD = "CAST(try_strptime({c}, '%Y.%m.%d') AS DATE)"
SQL_DATE_SINGLE = (f"NOT coalesce({_PD.format(c='order_date')} IS NOT NULL AND "
                   f"{_PD.format(c='order_date')} <= DATE '2001-01-01', false)")
SQL_DATE_PAIR = (f"NOT coalesce({_PD.format(c='order_date')} IS NOT NULL AND {_PD.format(c='end_date')} IS NOT NULL "
                 f"AND {_PD.format(c='order_date')} <= {_PD.format(c='end_date')}, false)")
PAIR_VALUE = "concat_ws(' | ', order_date, end_date)"

AS_OF = "1998-01-01"


def _rules_main():
    return [R.null_check("cust_id"), R.isin_check("status", ["F", "O", "P"]), R.number_check("price_txt"),
            R.date_check("order_date"), R.chars_check("note"), R.pattern_check("order_id", r"^ORD\d+$"),
            R.date_pair_check("order_date", "end_date")]


_MAIN_SQL = [("check_nulls", "cust_id", "cust_id", SQL_NULL), ("check_isin_value", "status", "status", SQL_ISIN),
             ("check_is_number", "price_txt", "price_txt", SQL_NUMBER),
             ("check_is_date", "order_date", "order_date", SQL_DATE),
             ("check_funny_characters", "note", "note", SQL_CHARS),
             ("check_correct_pattern", "order_id", "order_id", SQL_PATTERN),
             ("check_date_pair", "order_date <= end_date", PAIR_VALUE, SQL_DATE_PAIR)]


def _single(rule_fn, sql_where, flag, colname, value=None, sev="CRITICAL"):
    def run(spark, sf_dir):
        return evaluate(f1(spark, sf_dir), [rule_fn()], CTX).fail
    return run, F1 + _report_sql(flag, colname, value or colname, sql_where, sev)


for _name, _ids, _fn, _where, _flag, _col, _val in [
    ("dq_null", "Q01", lambda: R.null_check("cust_id"), SQL_NULL, "check_nulls", "cust_id", None),
    ("dq_isin_list", "Q06", lambda: R.isin_check("status", ["F", "O", "P"]), SQL_ISIN, "check_isin_value",
     "status", None),
    ("dq_number", "Q11", lambda: R.number_check("price_txt", nullable=True, allow_negative=False), SQL_NUMBER,
     "check_is_number", "price_txt", None),
    ("dq_number_strict", "Q11", lambda: R.number_check("price_txt", nullable=False, allow_negative=True),
     SQL_NUMBER_STRICT, "check_is_number", "price_txt", None),
    ("dq_date", "Q12", lambda: R.date_check("order_date", nullable=True), SQL_DATE, "check_is_date",
     "order_date", None),
    ("dq_date_strict", "Q12", lambda: R.date_check("order_date", nullable=False), SQL_DATE_STRICT,
     "check_is_date", "order_date", None),
    ("dq_chars", "Q13", lambda: R.chars_check("note"), SQL_CHARS, "check_funny_characters", "note", None),
    ("dq_pattern", "Q14", lambda: R.pattern_check("order_id", r"^ORD\d+$"), SQL_PATTERN,
     "check_correct_pattern", "order_id", None),
    ("dq_date_single", "Q16", lambda: R.date_single_check("order_date", months=36, as_of=AS_OF),
     SQL_DATE_SINGLE, "check_date_range", "order_date", None),
    ("dq_date_pair", "Q17", lambda: R.date_pair_check("order_date", "end_date"), SQL_DATE_PAIR,
     "check_date_pair", "order_date <= end_date", PAIR_VALUE),
]:
    _run, _sql = _single(_fn, _where, _flag, _col, _val)
    query(_name, _ids, _sql)(_run)


@query("dq_null_warning", ("Q01", "Q10"),
       F1 + "SELECT order_id, CASE WHEN cust_id IS NULL OR cust_id = '' THEN 'N/A' ELSE cust_id END AS cust_id, "
       "status, price_txt, order_date, end_date, note, action, ts_rank, source_file_name FROM f1")
def dq_null_warning(spark, sf_dir):
    """Warning mode: every row stays in OK, blanks resolved to the dummy."""
    return evaluate(f1(spark, sf_dir), [R.null_check("cust_id", is_warning=True, dummy="N/A")], CTX).ok


@query("dq_null_warning_report", "Q01",
       F1 + _report_sql("check_nulls_warning", "cust_id", "cust_id", SQL_NULL, "WARNING"))
def dq_null_warning_report(spark, sf_dir):
    return evaluate(f1(spark, sf_dir), [R.null_check("cust_id", is_warning=True, dummy="N/A")], CTX).fail


@query("dq_isin_keep", ("Q06", "Q10"), F1 + f"SELECT {COLS} FROM f1")
def dq_isin_keep(spark, sf_dir):
    """keep_in_successful_output: failures reported, all rows stay in OK."""
    rule = R.isin_check("status", ["F", "O", "P"], keep_in_successful_output=True)
    return evaluate(f1(spark, sf_dir), [rule], CTX).ok


@query("dq_pattern_marker", "Q15",
       F1 + "SELECT order_id, cust_id, status, price_txt, regexp_replace(order_date, '(\\d+)\\.', '\\1', 'g') "
       "AS order_date, end_date, note, action, ts_rank, source_file_name FROM f1 "
       "WHERE coalesce(regexp_matches(order_date, '(\\d+)\\.'), false)")
def dq_pattern_marker(spark, sf_dir):
    """Marker removal: matches replaced by group 1 in the OK output."""
    rule = R.pattern_check("order_date", r"(\d+)\.", "match_correct", remove_marker=True)
    return evaluate(f1(spark, sf_dir), [rule], CTX).ok


@query("dq_pattern_incorrect", "Q14",
       F1 + _report_sql("check_correct_pattern", "note", "note",
                        "coalesce(regexp_matches(note, 'URGENT'), false)"))
def dq_pattern_incorrect(spark, sf_dir):
    return evaluate(f1(spark, sf_dir), [R.pattern_check("note", "URGENT", "match_incorrect")], CTX).fail


@query("dq_row_to_delete", "Q22", F1 + f"SELECT {COLS} FROM f1 WHERE action = 'row_to_delete' "
       "OR order_id = 'row_to_delete' OR cust_id = 'row_to_delete' OR status = 'row_to_delete' "
       "OR price_txt = 'row_to_delete' OR order_date = 'row_to_delete' OR end_date = 'row_to_delete' "
       "OR note = 'row_to_delete' OR source_file_name = 'row_to_delete'")
def dq_row_to_delete(spark, sf_dir):
    from tablecheck.operators.checker import rows_to_delete
    return rows_to_delete(f1(spark, sf_dir))


@query("dq_fused_report", ("Q23", "Q25", "Q26"),
       F1 + "\nUNION ALL\n".join(_report_sql(fl, cn, v, w) for fl, cn, v, w in _MAIN_SQL))
def dq_fused_report(spark, sf_dir):
    """Seven rules, one scan: the FAIL report (one row per row x violated rule)."""
    return evaluate(f1(spark, sf_dir), _rules_main(), CTX).fail


@query("dq_final_ok", "Q23",
       F1 + f"SELECT {COLS} FROM f1 WHERE NOT (" + " OR ".join(w for _, _, _, w in _MAIN_SQL) + ")")
def dq_final_ok(spark, sf_dir):
    return evaluate(f1(spark, sf_dir), _rules_main(), CTX).ok


@query("dq_rule_counts", "Q23",
       F1 + "\nUNION ALL\n".join(
           f"SELECT '{fl}' AS check_passed, '{cn}' AS check_column_name, "
           f"CAST(count(*) FILTER (WHERE {w}) AS BIGINT) AS n_fail FROM f1" for fl, cn, _, w in _MAIN_SQL))
def dq_rule_counts(spark, sf_dir):
    """Per-rule failure counts from one wide aggregate (one scan, map-side combine)."""
    return fail_counts_long(f1(spark, sf_dir), _rules_main())


# ---------------------------------------------------------------- duplicates
_F1_TIE = ", ".join(f"{c} ASC NULLS FIRST" for c in F1_COLUMNS if c != "ts_rank")


@query("dq_duplicates_ok", ("Q02", "W01"),
       F1 + f"SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY upper(order_id) "
       f"ORDER BY ts_rank DESC NULLS LAST, {_F1_TIE}) AS rn FROM f1) WHERE rn = 1")
def dq_duplicates_ok(spark, sf_dir):
    ok, _ = check_duplicates(f1(spark, sf_dir), [], CTX, uniqueness_col="order_id", order_col="ts_rank")
    return ok


@query("dq_duplicates_fail", ("Q02", "Q05"),
       F1 + "SELECT 'orders_feed' AS object_name, 'check_duplicates' AS check_passed, "
       "'order_id' AS check_column_name, order_id AS check_column_value, 'CRITICAL' AS error_type, "
       f"CAST(NULL AS VARCHAR) AS idpipeline, {JSON} AS json_row_data, "
       "'Raw Folder : ' || folders AS source_file_name_agg FROM ("
       f"SELECT *, row_number() OVER (PARTITION BY upper(order_id) ORDER BY ts_rank DESC NULLS LAST, {_F1_TIE}) AS rn, "
       "array_to_string(list_sort(list_distinct(list(source_file_name) OVER (PARTITION BY upper(order_id)))), "
       "' -- Duplicates Folder : ') AS folders FROM f1) WHERE rn = 2")
def dq_duplicates_fail(spark, sf_dir):
    _, fail = check_duplicates(f1(spark, sf_dir), [], CTX, uniqueness_col="order_id", order_col="ts_rank",
                               delete_by_path=True)
    return fail


@query("dq_duplicates_oldest", ("Q02", "W02"),
       F1 + f"SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY upper(order_id) "
       f"ORDER BY ts_rank ASC NULLS FIRST, {_F1_TIE}) AS rn FROM f1) WHERE rn = 1")
def dq_duplicates_oldest(spark, sf_dir):
    """Object names containing ``split_temp`` keep the oldest row."""
    ok, _ = check_duplicates(f1(spark, sf_dir), [], CheckContext("orders_split_temp"),
                             uniqueness_col="order_id", order_col="ts_rank")
    return ok


_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
       "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_TIE = ", ".join(f"{c} ASC NULLS FIRST" for c in _LI if c != "l_shipdate")


@query("dq_duplicates_multi_pk", "Q02",
       "SELECT 'lineitem' AS object_name, 'check_duplicates' AS check_passed, 'Multiple PKs' AS check_column_name, "
       "CAST(l_linenumber AS VARCHAR) AS check_column_value, 'CRITICAL' AS error_type, "
       "CAST(NULL AS VARCHAR) AS idpipeline, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM ("
       f"SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, "
       f"{_LI_TIE}) AS rn FROM lineitem) WHERE rn = 2")
def dq_duplicates_multi_pk(spark, sf_dir):
    """Two-column primary key on lineitem, newest ship date wins; report of first losers."""
    _, fail = check_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey"], CheckContext("lineitem"),
                               uniqueness_col="l_linenumber", order_col="l_shipdate", with_json=False,
                               extra_cols=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return fail


@query("dup_keys", ("Q04", "Q34", "A01"),
       "SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem "
       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- lookups
def _lookup_report(name, colname, value, where, extra):
    return (f"SELECT '{name}' AS object_name, 'check_isin_value' AS check_passed, '{colname}' AS check_column_name, "
            f"CAST({value} AS VARCHAR) AS check_column_value, 'CRITICAL' AS error_type, "
            f"CAST(NULL AS VARCHAR) AS idpipeline, {extra} FROM {where}")


@query("dq_lookup", ("Q07", "J02", "J05"),
       _lookup_report("orders", "o_custkey", "o_custkey",
                      "orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey "
                      "AND c.c_mktsegment = 'BUILDING')", "o_orderkey"))
def dq_lookup(spark, sf_dir):
    """Allowed values from a dimension DataFrame (distinct keys, plain equi-join)."""
    cust = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    data = add_lookup_marker(table(spark, sf_dir, "orders"), "o_custkey", cust, "c_custkey", "_m_0")
    return evaluate(data, [lookup_rule("o_custkey", "_m_0")], CheckContext("orders"),
                    with_json=False, extra_cols=["o_orderkey"]).fail


@query("dq_lookup_composite", "Q08",
       F1 + _lookup_report(OBJ, "cust_id / status", "concat_ws(' / ', cust_id, status)",
                           "f1 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_custkey AS VARCHAR) = f1.cust_id "
                           "AND o.o_orderstatus = f1.status AND o.o_orderpriority = '1-URGENT')", "order_id"))
def dq_lookup_composite(spark, sf_dir):
    """Tuple lookup (cust_id, status); a null in any part fails."""
    lk = (table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
          .select(F.col("o_custkey").cast("string").alias("cust_id"), F.col("o_orderstatus").alias("status")))
    data = add_lookup_marker(f1(spark, sf_dir), ["cust_id", "status"], lk, None, "_m_0")
    return evaluate(data, [lookup_rule(["cust_id", "status"], "_m_0")], CTX, with_json=False,
                    extra_cols=["order_id"]).fail


@query("dq_isin_schema", "Q09",
       F1 + _lookup_report(OBJ, "status", "status", "f1 WHERE status IS NULL OR status NOT IN ('F', 'O')",
                           "order_id"))
def dq_isin_schema(spark, sf_dir):
    """Allowed values given as schema-typed rows."""
    allowed = rows_lookup(spark, [("F",), ("O",)], T.StructType([T.StructField("status", T.StringType())]))
    data = add_lookup_marker(f1(spark, sf_dir), "status", allowed, "status", "_m_0")
    return evaluate(data, [lookup_rule("status", "_m_0")], CTX, with_json=False, extra_cols=["order_id"]).fail


_MASTER_ORACLE = """
WITH k1 AS (SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)),
l1 AS (SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)),
l2 AS (SELECT * FROM k1 o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey
       AND (c.c_nationkey < 20 OR o.o_orderstatus = 'F')))
SELECT 'orders' AS object_name, 'check_master_filters' AS check_passed, 'o_custkey' AS check_column_name,
       CAST(o_custkey AS VARCHAR) AS check_column_value, 'CRITICAL' AS error_type,
       CAST(NULL AS VARCHAR) AS idpipeline, o_orderkey FROM l1
UNION ALL
SELECT 'orders', 'check_master_filters', 'o_custkey', CAST(o_custkey AS VARCHAR), 'CRITICAL', NULL, o_orderkey FROM l2
"""


def _master_rules(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return [dict(filtered_column="o_custkey", master=cust, curated_column="c_custkey", where="c_acctbal >= 0"),
            dict(filtered_column="o_custkey", master=cust, curated_column="c_custkey",
                 where="c_nationkey < 20 OR o_orderstatus = 'F'")]


@query("dq_master_filters", ("Q20", "J01", "J03", "J04"), _MASTER_ORACLE)
def dq_master_filters(spark, sf_dir):
    """Sequential master filters; the second condition names both sides (semi/anti join, no fan-out)."""
    _, fail = master_filters(table(spark, sf_dir, "orders"), _master_rules(spark, sf_dir), CheckContext("orders"),
                             with_json=False, extra_cols=["o_orderkey"])
    return fail


@query("dq_master_prefilter", "Q19",
       "SELECT o.* FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey "
       "AND c.c_acctbal >= 0) AND EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey "
       "AND (c.c_nationkey < 20 OR o.o_orderstatus = 'F'))")
def dq_master_prefilter(spark, sf_dir):
    ok, _ = master_filters(table(spark, sf_dir, "orders"), _master_rules(spark, sf_dir), CheckContext("orders"),
                           with_json=False)
    return ok


_CONFIG_ROWS = [
    dict(bronze_sink_table_name="orders", bronze_column="o_orderpriority", lookup_column=None,
         lookup_object_against=None, allowed_values="1-URGENT, 2-HIGH, 3-MEDIUM", object_where_condition=None,
         lookup_object_is_in_dbr_catalog=1, lookup_object_is_in_sql_server=0),
    dict(bronze_sink_table_name="orders", bronze_column="o_custkey", lookup_column="c_custkey",
         lookup_object_against="customer", allowed_values=None, object_where_condition="c_mktsegment <> 'MACHINERY'",
         lookup_object_is_in_dbr_catalog=1, lookup_object_is_in_sql_server=0),
    dict(bronze_sink_table_name="lineitem", bronze_column="l_returnflag", lookup_column=None,
         lookup_object_against=None, allowed_values="A, N", object_where_condition=None,
         lookup_object_is_in_dbr_catalog=1, lookup_object_is_in_sql_server=0),
]
CONFIG_SCHEMA = ("bronze_sink_table_name string, bronze_column string, lookup_column string, "
                 "lookup_object_against string, allowed_values string, object_where_condition string, "
                 "lookup_object_is_in_dbr_catalog int, lookup_object_is_in_sql_server int")


@query("dq_config_isin", ("Q21", "U04"),
       _lookup_report("orders", "o_orderpriority", "o_orderpriority",
                      "orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "o_orderkey")
       + "\nUNION ALL\n" +
       _lookup_report("orders", "o_custkey", "o_custkey",
                      "orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey "
                      "AND c.c_mktsegment <> 'MACHINERY')", "o_orderkey"))
def dq_config_isin(spark, sf_dir):
    """Config-driven allowed values: each config row = lookup table ∪ literal list."""
    config = spark.createDataFrame([tuple(r.values()) for r in _CONFIG_ROWS], CONFIG_SCHEMA)
    _, fail = config_isin(table(spark, sf_dir, "orders"), spark, config, CheckContext("orders"),
                          tables={"customer": table(spark, sf_dir, "customer")}, with_json=False,
                          extra_cols=["o_orderkey"])
    return fail


# ---------------------------------------------------------------- quarantine / reconcile
_ALL_BAD = " OR ".join(w for _, _, _, w in _MAIN_SQL)


@query("dq_quarantine", "Q29",
       F1 + f"SELECT CASE WHEN {_ALL_BAD} THEN 'quarantine' ELSE 'silver' END AS destination, "
       "count(*) AS n_rows FROM f1 GROUP BY 1")
def dq_quarantine(spark, sf_dir):
    """Valid rows to silver, invalid to quarantine; counted per destination in one pass."""
    return quarantine_split(f1(spark, sf_dir), _rules_main())


@query("dq_threshold", "Q30",
       F1 + f"SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE {_ALL_BAD}) AS BIGINT) AS n_bad, "
       f"round(100.0 * count(*) FILTER (WHERE {_ALL_BAD}) / count(*), 4) AS bad_pct, "
       f"(100.0 * count(*) FILTER (WHERE {_ALL_BAD}) / count(*)) > 1.0 AS alert FROM f1")
def dq_threshold(spark, sf_dir):
    return threshold_status(f1(spark, sf_dir), _rules_main(), max_bad_pct=1.0)


@query("dq_reconcile", "Q32",
       "WITH s AS (SELECT count(*) AS n FROM orders), "
       "t AS (SELECT count(DISTINCT o_custkey) AS n FROM orders) "
       "SELECT s.n AS source_count, t.n AS target_count, "
       "round(100.0 * abs(s.n - t.n) / s.n, 4) AS diff_pct, "
       "CASE WHEN 100.0 * abs(s.n - t.n) / s.n > 5.0 THEN 'FAIL' ELSE 'PASS' END AS status FROM s, t")
def dq_reconcile(spark, sf_dir):
    """Source vs target counts with a 5 % tolerance (source = orders, target = one row per customer)."""
    orders = table(spark, sf_dir, "orders")
    return reconcile_counts(orders, orders.select("o_custkey").distinct(), tolerance_pct=5.0)


@query("dq_layer_debug", "Q33",
       F1 + "SELECT 'bronze' AS layer, count(*) AS n_rows, count(DISTINCT upper(order_id)) AS n_keys FROM f1 "
       "UNION ALL SELECT 'silver', count(*), count(DISTINCT upper(order_id)) FROM f1 WHERE NOT (" + _ALL_BAD + ")")
def dq_layer_debug(spark, sf_dir):
    """Row and key counts per layer, side by side (bronze = raw feed, silver = checked)."""
    raw = f1(spark, sf_dir)
    silver = evaluate(raw, _rules_main(), CTX).ok
    return layer_stats({"bronze": raw, "silver": silver}, key=F.upper(F.col("order_id")))


@query("ruleset", "Q27",
       "SELECT *, CASE WHEN metric = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'IsComplete' AS rule, 'o_custkey' AS column_name, CAST(count(*) - count(o_custkey) AS BIGINT) AS metric "
       "FROM orders UNION ALL SELECT 'IsUnique', 'o_orderkey', CAST(count(o_orderkey) - count(DISTINCT o_orderkey) AS "
       "BIGINT) FROM orders UNION ALL SELECT 'ColumnValues > 1000', 'o_totalprice', CAST(count(*) FILTER (WHERE "
       "o_totalprice <= 1000) AS BIGINT) FROM orders UNION ALL SELECT 'ColumnLength between 8 and 15', "
       "'o_orderpriority', CAST(count(*) FILTER (WHERE length(o_orderpriority) NOT BETWEEN 8 AND 15) AS BIGINT) "
       "FROM orders UNION ALL SELECT 'IsUnique', 'o_custkey', CAST(count(o_custkey) - count(DISTINCT o_custkey) AS "
       "BIGINT) FROM orders)")
def ruleset(spark, sf):
    """Declarative dataset rules evaluated in one aggregate (status PASS when the metric is 0)."""
    from tablecheck.operators import ruleset as RS
    rules = [RS.is_complete("o_custkey"), RS.is_unique("o_orderkey"), RS.column_values("o_totalprice", ">", 1000),
             RS.column_length_between("o_orderpriority", 8, 15), RS.is_unique("o_custkey")]
    return RS.evaluate_ruleset(table(spark, sf, "orders"), rules)
