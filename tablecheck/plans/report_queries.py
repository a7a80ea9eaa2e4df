"""Report assembly, configuration, snapshots and catalog tables (Q03, Q18, Q23, Q24, Q29, Q31, A14, S03, S04, S10–S12, S14,
S17, S19, S21, S23, S25, S26, M04, M07, G01, G02, G05, G06, J12).

Written tables go below the shared folder; catalog tables get fresh names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablecheck.operators import change as C
from tablecheck.operators import rules as R
from tablecheck.operators.checker import TableChecker
from tablecheck.operators.dedup import check_duplicates
from tablecheck.operators.evaluate import CheckContext, build_final_fail, evaluate, with_row_id
from tablecheck.operators.lookup import master_filters
from tablecheck.operators.reconcile import assert_not_empty, write_quarantine
from tablecheck.plans.dq_queries import _ALL_BAD, _F1_TIE, _LI, _MAIN_SQL, COLS, CTX, F1, OBJ, SQL_NULL, _rules_main
from tablecheck.plans.fixtures import f1, table
from tablecheck.plans.registry import query
from tablecheck.session import scratch_path
from tablecheck.sources import ingest as I
from tablecheck.sources import readers as RD
from tablecheck.sources import versions as V


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


# =========================================================================== checks together
_DUP = F1 + f", d AS (SELECT *, row_number() OVER (PARTITION BY upper(order_id) ORDER BY ts_rank DESC NULLS LAST, {_F1_TIE}) AS rn FROM f1) "
_MASTER = "EXISTS (SELECT 1 FROM customer c WHERE CAST(c.c_custkey AS VARCHAR) = d.cust_id AND c.c_acctbal >= 0)"


@query("dq_checker_all", ("Q23", "Q02", "Q07", "Q20", "U01"),
       _DUP + f"SELECT DISTINCT {COLS} FROM d WHERE rn = 1 AND NOT {SQL_NULL} AND status IN ('F', 'O') AND {_MASTER}")
def dq_checker_all(spark, sf):
    """Null, lookup, duplicate and master checks recorded one by one, evaluated together: the intersection of their outputs."""
    c = TableChecker(f1(spark, sf), OBJ)
    c.check_nulls(False, ["cust_id"])
    allowed = table(spark, sf, "orders").filter("o_orderstatus IN ('F', 'O')").select(F.col("o_orderstatus").alias("status"))
    c.check_isin_value(False, [["status", allowed]])
    c.check_duplicates_with_PKs(False, ["order_id"], order_col="ts_rank")
    master = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_acctbal")
    c.check_master_filters([dict(filtered_column="cust_id", master=master, curated_column="c_custkey", where="c_acctbal >= 0")])
    return c.evaluate_all().ok


@query("dq_two_fixes", ("Q01", "Q15"),
       F1 + f"SELECT order_id, CASE WHEN {SQL_NULL} THEN 'N/A' ELSE regexp_replace(cust_id, '^1(.*)$', '\\1') END AS cust_id FROM f1")
def dq_two_fixes(spark, sf):
    """A blank's dummy and a marker's removal on one column: both apply, in rule order."""
    marker = R.pattern_check("cust_id", "^1(.*)$", "match_incorrect", remove_marker=True).with_action(R.REPORT)
    return evaluate(f1(spark, sf), [R.null_check("cust_id", is_warning=True, dummy="N/A"), marker], CTX).ok.select("order_id", "cust_id")


@query("dq_null_pk", ("Q02", "Q01"),
       F1 + f"SELECT 'check_duplicates' AS check_passed, cust_id AS check_column_value, order_id FROM (SELECT *, row_number() OVER "
       f"(PARTITION BY upper(cust_id) ORDER BY ts_rank DESC NULLS LAST, {_F1_TIE}) AS rn FROM f1 WHERE cust_id IS NOT NULL) WHERE rn = 2 "
       "UNION ALL SELECT 'check_nulls', NULL, order_id FROM f1 WHERE cust_id IS NULL")
def dq_null_pk(spark, sf):
    """Null keys fail: each such row is reported, and none of them survives as a key."""
    _, fail = check_duplicates(f1(spark, sf), [], CTX, uniqueness_col="cust_id", order_col="ts_rank", null_pk="fail",
                               with_json=False, extra_cols=["order_id"])
    return fail.select("check_passed", "check_column_value", "order_id")


@query("dq_pk_config", ("Q03", "Q02"),
       "SELECT 'Multiple PKs' AS check_column_name, CAST(l_linenumber AS VARCHAR) AS check_column_value, CAST(l_orderkey AS VARCHAR) AS order_key FROM ("
       f"SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in _LI)}) AS rn FROM lineitem) WHERE rn = 2")
def dq_pk_config(spark, sf):
    """The key columns come from the configuration table by object name."""
    config = spark.createDataFrame([("lineitem", "l_orderkey"), ("orders", "o_orderkey")], "object_name string, PK string")
    checker = TableChecker(table(spark, sf, "lineitem").select(*_LI), "lineitem", pk_config=config)
    _, fail = checker.check_duplicates_with_PKs(False, ["l_linenumber"])
    return fail.select("check_column_name", "check_column_value", F.get_json_object("json_row_data", "$.l_orderkey").alias("order_key"))


@query("dq_missing_column", "Q18", F1 + "SELECT count(*) AS n_ok, CAST(0 AS BIGINT) AS n_fail FROM f1")
def dq_missing_column(spark, sf):
    """A date rule on a column the object does not have: every row passes, the report is empty."""
    ok, fail = TableChecker(f1(spark, sf), OBJ).check_date_generic("single", column_name="no_such_column")
    side = ok.select(F.lit(1).alias("x")).unionAll(fail.select(F.lit(0).alias("x")))
    return side.agg(F.sum("x").alias("n_ok"), F.sum(1 - F.col("x")).alias("n_fail"))


@query("dq_final_fail", ("Q24", "U03", "U05"),
       F1 + " UNION ".join(
           f"SELECT '{OBJ}' AS object_name, '{fl}' AS check_passed, '{cn}' AS check_column_name, CAST({v} AS VARCHAR) AS check_column_value, "
           f"order_id, 'feed.csv' AS file, 'landing/x' AS path FROM f1 WHERE {w}" for fl, cn, v, w in _MAIN_SQL))
def dq_final_fail(spark, sf):
    """Reports of two runs united by name, duplicates dropped, file and path added to the row's JSON."""
    rules = _rules_main()
    one, two = evaluate(f1(spark, sf), rules, CTX).fail, evaluate(f1(spark, sf), rules[:4], CTX).fail
    final = build_final_fail(one, two, file_name="feed.csv", folder_path="landing/x")
    part = lambda k: F.get_json_object("json_row_data", f"$.{k}").alias(k)
    return final.select("object_name", "check_passed", "check_column_name", "check_column_value", part("order_id"), part("file"), part("path"))


@query("dq_row_counts", "A14",
       F1 + f"SELECT 'rows' AS name, count(*) AS n FROM f1 UNION ALL SELECT 'ok', count(*) FILTER (NOT ({_ALL_BAD})) FROM f1 UNION ALL "
       + " UNION ALL ".join(f"SELECT '{fl}', count(*) FILTER ({w}) FROM f1" for fl, _, _, w in _MAIN_SQL))
def dq_row_counts(spark, sf):
    """Rows before and after the checks, from an Observation on the job that writes the good rows: no extra count."""
    ev = evaluate(f1(spark, sf), _rules_main(), CheckContext(_name("feed")), observe=True)
    out = _scratch(spark, "ok")
    ev.ok.write.parquet(out)
    seen = ev.observation.get
    rows = [(k.split(":")[1] if ":" in k else k, int(v or 0)) for k, v in seen.items()]
    return spark.createDataFrame(rows, "name string, n long").unionAll(
        spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n")).select(F.lit("ok").alias("name"), "n"))


@query("dq_quarantine_write", "Q29",
       F1 + f"SELECT CASE WHEN {_ALL_BAD} THEN 'quarantine' ELSE 'silver' END AS destination, order_id, ts_rank FROM f1")
def dq_quarantine_write(spark, sf):
    """Good rows and quarantined rows written to two tables, read back."""
    silver, bad = _scratch(spark, "silver"), _scratch(spark, "quarantine")
    write_quarantine(f1(spark, sf), _rules_main(), silver, bad)
    return spark.read.parquet(silver).select(F.lit("silver").alias("destination"), "order_id", "ts_rank").unionAll(
        spark.read.parquet(bad).select(F.lit("quarantine"), "order_id", "ts_rank"))


@query("row_identity", "Q23", F1 + f"SELECT count(*) AS n_rows, count(*) AS n_ids, 36 AS id_length, (SELECT count(*) FROM f1 WHERE NOT ({_ALL_BAD})) AS n_ok FROM f1")
def row_identity(spark, sf):
    """Every row gets its own id, and the id does not reach the OK rows."""
    rows = with_row_id(f1(spark, sf))
    ok = evaluate(rows, _rules_main(), CTX).ok.select(*COLS.split(", "))
    n_ok = ok.agg(F.count(F.lit(1))).scalar()
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_temp_unique_id").alias("n_ids"),
                    F.max(F.length("_temp_unique_id")).alias("id_length"), n_ok.alias("n_ok"))


@query("empty_guard", ("Q31", "O03"), "SELECT o_orderstatus, count(*) = 0 AS stopped FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'none', true")
def empty_guard(spark, sf):
    """Each status's output is guarded; the empty one stops its job."""
    o, rows = table(spark, sf, "orders"), []
    for status in [r[0] for r in o.select("o_orderstatus").distinct().collect()] + ["none"]:
        try:
            assert_not_empty(o.filter(F.col("o_orderstatus") == status), status)
            rows.append((status, False))
        except ValueError:
            rows.append((status, True))
    return spark.createDataFrame(rows, "o_orderstatus string, stopped boolean")


# =========================================================================== lookups and configuration
@query("lookup_load", "S12", "SELECT DISTINCT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def lookup_load(spark, sf):
    """A lookup from Spark SQL; an empty one would be None."""
    view = _name("customer")
    table(spark, sf, "customer").createOrReplaceTempView(view)
    if RD.load_lookup(spark, f"SELECT c_nationkey FROM {view} WHERE c_mktsegment = 'no such segment'") is not None:
        raise ValueError("an empty lookup is None")
    return RD.load_lookup(spark, f"SELECT DISTINCT c_nationkey FROM {view} WHERE c_mktsegment = 'BUILDING'")


@query("master_config", ("S14", "Q20"),
       "SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0) "
       "AND EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey < 15)")
def master_config(spark, sf):
    """The active master filters of an object, read from the configuration, then applied."""
    config = spark.createDataFrame(
        [("orders", "o_custkey", "c_custkey", "c_acctbal > 0", 1), ("orders", "o_custkey", "c_custkey", "c_acctbal < 0", 0),
         ("orders", "o_custkey", "c_custkey", "c_nationkey < 15", 1), ("parts", "p", "p", "false", 1)],
        "object_name string, filtered_column string, curated_column string, where string, filter_in_silver int")
    master = table(spark, sf, "customer")
    rules = [r | {"master": master} for r in RD.active_master_filters(config, "orders")]
    ok, _ = master_filters(table(spark, sf, "orders"), rules, CheckContext("orders"), with_json=False)
    return ok.select("o_orderkey")


# =========================================================================== snapshots, files
_CUST = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query("silver_snapshot", "S10", f"SELECT {_CUST} FROM customer")
def silver_snapshot(spark, sf):
    """A managed table overwritten with the frame and read back."""
    snap, _ = V.save_snapshot(table(spark, sf, "customer"), _name("silver"))
    return snap.select(*_CUST.split(", "))


@query("bronze_snapshot", ("S11", "G06"), "SELECT count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_nations FROM customer")
def bronze_snapshot(spark, sf):
    """A frame kept for the length of a block, used twice, then released."""
    with V.bronze_snapshot(table(spark, sf, "customer")) as snap:
        row = (snap.count(), snap.select("c_nationkey").distinct().count())
    return spark.createDataFrame([row], "n_rows long, n_nations long")


@query("isolated_read", "S04",
       "SELECT status, count(*) AS n_folders, sum(n_rows) AS n_rows FROM (SELECT 'SUCCESS' AS status, count(*) AS n_rows FROM customer GROUP BY c_custkey % 3 "
       "UNION ALL SELECT 'FAILED', 0) GROUP BY status")
def isolated_read(spark, sf):
    """Three folders of good files and one of a file that is no Parquet file: its failure is in the ledger, the others are read whole."""
    root = _scratch(spark, "isolated")
    c = table(spark, sf, "customer")
    for rest in range(3):
        c.filter(F.col("c_custkey") % 3 == rest).write.parquet(f"{root}/good-{rest}")
    c.limit(1).select("c_name").write.text(f"{root}/bad")
    data, ledger = I.read_isolating_failures(spark, root, "run-1", glob="part-*", schema=c.schema)
    rows = data.groupBy(F.lit("SUCCESS").alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))
    files = ledger.groupBy("status").agg(F.count_distinct(F.regexp_extract("path", "(good-[0-9]|bad)/", 1)).alias("n_folders"))
    return files.join(rows, "status", "left").select("status", "n_folders", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("incremental_files", ("M07", "S03"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 >= 2")
def incremental_files(spark, sf):
    """Only files that the ledger does not have yet are read."""
    root = _scratch(spark, "feed")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o.withColumn("part", F.col("o_orderkey") % 4).write.partitionBy("part").parquet(root)
    inv = I.file_inventory(spark, root)
    ledger = I.ledger_rows(inv.filter("path rlike 'part=[01]/'"), "run-1")
    return spark.read.parquet(*[r["path"] for r in I.new_files(inv, ledger).collect()])  # file names only


@query("compaction", "G01", "SELECT count(*) AS n_rows, round(sum(o_totalprice), 2) AS total, 1 AS n_files FROM orders")
def compaction(spark, sf):
    """Twenty small files copied into files of the target size (one, for tables of this size)."""
    small, large = _scratch(spark, "small"), _scratch(spark, "large")
    table(spark, sf, "orders").repartition(20).write.parquet(small)
    V.compact_files(spark, small, large, 1 << 30)
    back = spark.read.parquet(large).withColumn("file", F.input_file_name())
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                    F.count_distinct("file").alias("n_files"))


@query("formats", ("S26", "S15"), " UNION ALL ".join(f"SELECT '{f}' AS format, n_nationkey, n_name FROM nation" for f in ("csv", "json", "orc", "parquet")))
def formats(spark, sf):
    """The built-in formats, written and read with a declared schema."""
    n, parts = table(spark, sf, "nation").select("n_nationkey", "n_name"), []
    for fmt in ("csv", "json", "orc", "parquet"):
        path = _scratch(spark, fmt)
        n.write.format(fmt).save(path)
        parts.append(RD.read_table(spark, path, fmt, n.schema).select(F.lit(fmt).alias("format"), "*"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query("zorder_layout", "G02", "SELECT l_orderkey, l_linenumber, true AS narrow FROM lineitem")
def zorder_layout(spark, sf):
    """The table written in Z-order: each file covers a narrow part of the key, so the files' key ranges do not overlap."""
    from tablecheck.functions import morton_key
    path = _scratch(spark, "zorder")
    V.zorder(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], 6).write.parquet(path)
    back = spark.read.parquet(path).select("l_orderkey", "l_linenumber", morton_key(["l_partkey", "l_suppkey"]).alias("z"), F.input_file_name().alias("file"))
    ranges = back.groupBy("file").agg(F.min("z").alias("lo"), F.max("z").alias("hi"))
    after = F.lead("lo").over(Window.orderBy("lo", "hi"))  # one row per written file
    crossing = ranges.withColumn("next", after).filter("next < hi").select("file")
    return back.join(crossing.withColumn("narrow", F.lit(False)), "file", "left").select("l_orderkey", "l_linenumber", F.coalesce("narrow", F.lit(True)).alias("narrow"))


# =========================================================================== catalog tables
_YM = "year(o_orderdate) AS year, month(o_orderdate) AS month"


@query("external_table", ("S17", "S01"), f"SELECT {_YM}, count(*) AS n_rows FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1, 2")
def external_table(spark, sf):
    """An external table over landed months, its partitions registered from storage."""
    root, o = _scratch(spark, "external"), table(spark, sf, "orders")
    year = o.filter(I.month_range_predicate(o, "o_orderdate", 1997, 1, 12))
    I.land(I.with_month_partitions(year, "o_orderdate").select("o_orderkey", "year", "month"), root)
    t = RD.create_external_table(spark, _name("orders_ext"), root, "o_orderkey BIGINT, year INT, month INT", ["year", "month"])
    return t.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("bulk_load", "S19", "SELECT n_name, 2 AS n FROM nation")
def bulk_load(spark, sf):
    """Loaded twice: the first load makes the table, the second adds to it."""
    name, n = _name("nation_load"), table(spark, sf, "nation").select("n_nationkey", "n_name")
    RD.bulk_load(n, name)
    RD.bulk_load(n, name)
    return spark.table(name).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


@query("table_as_select", ("S21", "S23"), "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def table_as_select(spark, sf):
    """CREATE TABLE AS SELECT over a view, and an aggregate view for reports over that table."""
    src, name, view = _name("customer"), _name("segments"), _name("report")
    table(spark, sf, "customer").createOrReplaceTempView(src)
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT c_custkey, c_mktsegment FROM {src}")
    spark.sql(f"CREATE TEMP VIEW {view} AS SELECT c_mktsegment, count(*) AS n FROM {name} GROUP BY c_mktsegment")
    return spark.table(view)


@query("lake_to_warehouse", "S25", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def lake_to_warehouse(spark, sf):
    """Files in the lake joined to a table of the catalog."""
    name = _name("nation_wh")
    table(spark, sf, "nation").write.saveAsTable(name)
    c, n = RD.read_table(spark, f"{sf}/customer.parquet"), RD.read_table(spark, name, "table")
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


@query("bucketed_join", "J12", "SELECT o_orderkey, l_linenumber, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def bucketed_join(spark, sf):
    """Two tables bucketed alike on the join key: no exchange on either side."""
    o = RD.bucketed_copy(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), _name("orders_b"), "o_orderkey", 8)
    li = RD.bucketed_copy(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), _name("lineitem_b"), "l_orderkey", 8)
    return o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey).select("o_orderkey", "l_linenumber", "o_totalprice")


# =========================================================================== change images
@query("cdc_images", "M04",
       f"SELECT {_CUST} FROM customer WHERE c_custkey % 10 > 1 UNION ALL "
       "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 5, c_mktsegment FROM customer WHERE c_custkey % 10 = 1 UNION ALL "
       "SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 25 = 0")
def cdc_images(spark, sf):
    """Change records with before and after images: deletes, updates (an older and a newer one) and inserts."""
    c = table(spark, sf, "customer").select(*_CUST.split(", "))
    image = lambda add=0, key=0: F.struct((F.col("c_custkey") + key).alias("c_custkey"), "c_name", "c_nationkey", (F.col("c_acctbal") + add).alias("c_acctbal"), "c_mktsegment")
    none = F.lit(None).cast(c.select(image().alias("i")).schema["i"].dataType)

    def records(op, at, before, after):
        return F.struct(F.lit(op).alias("operation"), F.lit(at).alias("timestamp")).alias("metadata"), before.alias("before-image"), after.alias("after-image")
    feed = c.filter("c_custkey % 10 = 0").select(*records("D", 3, image(), none)) \
        .unionAll(c.filter("c_custkey % 10 = 1").select(*records("U", 2, image(1), image(5)))) \
        .unionAll(c.filter("c_custkey % 10 = 1").select(*records("U", 1, image(), image(1)))) \
        .unionAll(c.filter("c_custkey % 25 = 0").select(*records("I", 1, none, image(0, 10_000_000))))
    return C.cdc_apply(c, C.flatten_cdc(feed, "c_custkey"), ["c_custkey"])
