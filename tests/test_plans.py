"""Plan-shape checks: fused rules scan once, no Python in the row path,
filters and projections reach the Parquet scan."""
from tablecheck.operators.evaluate import evaluate, fail_counts_long
from tablecheck.plans.catalog import QUERIES
from tablecheck.plans import load_queries, report_queries
from tablecheck.plans.dq_queries import _rules_main
from tablecheck.plans.fixtures import f1

SF = "/root/testdata/sf0.001"
# queries that write tables while they are built
REPORTS = {n for n, f in QUERIES.items() if f.__module__ in (report_queries.__name__, load_queries.__name__) and not n.startswith("dq_")} | {"dq_row_counts", "dq_quarantine_write"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_rules_read_the_input_once(spark):
    df = f1(spark, SF)
    for out in (evaluate(df, _rules_main()).ok, evaluate(df, _rules_main()).fail, fail_counts_long(df, _rules_main())):
        plan = _plan(out)
        # F1 is a UNION ALL of two branches over orders: one scan per branch, whatever the rule count
        assert plan.count("FileScan parquet") == 2, plan


def test_no_python_in_row_path(spark):
    for name in ["dq_fused_report", "dq_final_ok", "dq_duplicates_fail", "dq_lookup", "anomaly_5min",
                 "band_self_join", "session_max", "pii_scan", "scd2"]:
        plan = _plan(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_pushdown_and_pruning(spark):
    plan = _plan(QUERIES["semi"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in plan
    plan = _plan(QUERIES["month_range"](spark, SF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_dedup_is_an_aggregate_not_a_window(spark):
    plan = _plan(QUERIES["dq_duplicates_ok"](spark, SF))
    assert "Window" not in plan and "HashAggregate" in plan and "LeftAnti" in plan and "LeftSemi" in plan


# Queries whose single-partition exchange only carries a global aggregate's
# partial results or a window over per-period / per-batch totals.
SMALL_GLOBAL = {"dq_rule_counts", "dq_threshold", "dq_reconcile", "dq_layer_debug", "pii_scan", "column_stats",
                "latest_month", "latest_month_fallback", "done_marker", "size_report", "incremental_load",
                "scalar_subquery", "null_semantics", "describe", "moving_avg7", "mom_change", "mom_drop",
                "late_split", "schema_evolution", "current_slice", "historical_slice", "ruleset", "salted_join", "dq_missing_column", "row_identity"}
WRITES = {*(n for n in QUERIES if n.startswith("stream_")), *REPORTS, "bookmarked_job", "time_travel", "version_latest", "schema_evolution",
          "partition_projection", "reference_csv", "generic_ingest"}


def test_no_cross_products_python_or_single_task_row_work(spark):
    for name, fn in QUERIES.items():
        if name in WRITES:
            continue
        plan = _plan(fn(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
        if name not in SMALL_GLOBAL:
            assert "SinglePartition" not in plan, name
