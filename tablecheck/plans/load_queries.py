"""Queries for loads over time: padded months, incremental loads, modified files, widened files, retention, column classes,
catalog statistics and split joins (S01, S18, M06, S22, M07, M11, M12, G03, G04, G10, J07).  They write tables below the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tablecheck.operators import govern as G
from tablecheck.plans.fixtures import table
from tablecheck.plans.registry import query
from tablecheck.session import scratch_path
from tablecheck.sources import ingest as I
from tablecheck.sources.readers import read_month_range
from tablecheck.sources.versions import VersionedTable


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("padded_months", ("S01", "S18", "S20", "M12"),
       "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderkey, o_custkey FROM orders "
       "WHERE year(o_orderdate) = 1996 AND month(o_orderdate) BETWEEN 1 AND 11")
def padded_months(spark, sf):
    """The reference's layout ``month=01``: a year is landed month by month as another program would, three months are landed again,
    and eleven months are read by their folders."""
    o = table(spark, sf, "orders").filter(F.year("o_orderdate") == 1996).select("o_orderkey", "o_custkey", "o_orderdate")
    parts = I.with_month_partitions(o, "o_orderdate").drop("o_orderdate")
    root = _scratch(spark, "padded")
    parts.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")).write.partitionBy("year", "month").parquet(root)
    I.land(parts, root, I.months_predicate(1996, 2, 3), months=[(1996, m) for m in (2, 3, 4)])
    return read_month_range(spark, root, I.month_sequence(spark, 1996, 1, 11)).select("year", "month", "o_orderkey", "o_custkey")


_HALF = "(SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND ts <= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events))"


@query("watermark_loads", ("M06", "S22"),
       f"SELECT CASE WHEN ts <= {_HALF} THEN 0 ELSE 1 END AS batch, event_id, ts, value FROM events WHERE event_id % 3 = 0 OR ts > {_HALF}")
def watermark_loads(spark, sf):
    """Two loads under a persisted watermark; a third finds nothing, and a folder without a control row is not read.  The first
    load sees every third event of the first half of the time; later rows below its watermark are not new."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    half = e.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("t")).scalar()
    load = I.IncrementalLoad(spark, _scratch(spark, "loads"), "ts")
    load.load(e.filter((F.col("event_id") % 3 == 0) & (F.col("ts") <= half)))
    e.limit(5).write.parquet(f"{load.root}/batches/batch=1")  # what a crashed load left
    load.load(e)
    load.load(e)
    return load.read().select(F.col("batch").cast("int").alias("batch"), "event_id", "ts", "value")


@query("modified_files", "M07", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 >= 2")
def modified_files(spark, sf):
    """Files found by modification time and ledger: two of four folders have been landed, the others are as young."""
    root = _scratch(spark, "modified")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o.withColumn("part", F.col("o_orderkey") % 4).write.partitionBy("part").parquet(root)
    done = I.ledger_rows(I.file_inventory(spark, root).filter("path rlike 'part=[01]/'"), "run-1")
    new = I.files_modified_since(spark, root, done, overlap_seconds=3600)
    return spark.read.parquet(*[r["path"] for r in new.select("path").collect()])  # file names only


@query("widened_files", ("M11", "S20"),
       "SELECT CASE WHEN o_orderkey % 3 = 2 THEN 'K' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS k, "
       "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS price FROM orders")
def widened_files(spark, sf):
    """Three loads whose key was int, then long, then text, with a column that came later, as one table."""
    root, o = _scratch(spark, "widened"), table(spark, sf, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice").alias("price")
    o.filter("o_orderkey % 3 = 0").select(k.cast("int").alias("k"), price).write.parquet(f"{root}/load0")
    o.filter("o_orderkey % 3 = 1").select(k.cast("long").alias("k"), F.col("o_orderstatus").alias("status"), price).write.parquet(f"{root}/load1")
    o.filter("o_orderkey % 3 = 2").select(F.concat(F.lit("K"), k).alias("k"), F.col("o_orderstatus").alias("status"), price).write.parquet(f"{root}/load2")
    return I.read_widened(spark, root).select("k", "status", "price")


@query("schema_overwrite", ("M11", "M10"), "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer")
def schema_overwrite(spark, sf):
    """A version with another schema replaces the one before, which stays readable with its own."""
    vt, c = VersionedTable(spark, _scratch(spark, "overwrite")), table(spark, sf, "customer")
    vt.publish(c.select("c_custkey", "c_acctbal"))
    vt.publish(c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment"), "OVERWRITE SCHEMA")
    if vt.read(0).columns != ["c_custkey", "c_acctbal"]:
        raise AssertionError("the first version changed")
    return vt.read()


@query("retention", "G03", "SELECT v AS version, count(*) FILTER (c_custkey % 3 <= v) AS n_rows FROM customer, (VALUES (1), (2)) t(v) GROUP BY v")
def retention(spark, sf):
    """Three versions, of which the oldest has expired; the others are read whole."""
    vt, c = VersionedTable(spark, _scratch(spark, "retention")), table(spark, sf, "customer")
    for v in range(3):
        vt.publish(c.filter(F.col("c_custkey") % 3 <= v))
    vt.expire(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1), keep_last=2)
    parts = [vt.read(r["version"]).agg(F.lit(r["version"]).cast("int").alias("version"), F.count(F.lit(1)).alias("n_rows")) for r in vt.history().collect()]
    return parts[0].unionAll(parts[1])


_CARD = "lpad(CAST((c_custkey * 7919 + 400000000000000) % 1000000000000000 AS VARCHAR), 15, '0')"
_LUHN = ("list_sum(list_transform(string_split(reverse({0}), ''), lambda x, i: CASE WHEN i % 2 = {1} THEN CASE WHEN 2 * x::INT > 9 THEN 2 * x::INT - 9 ELSE 2 * x::INT END ELSE x::INT END))")


@query("column_classes", "G10",
       f"WITH d AS (SELECT *, {_CARD} AS body FROM customer), "
       f"c AS (SELECT *, body || ((10 - {_LUHN.format('body', 1)} % 10) % 10) AS card, body || '7' AS order_no FROM d), "
       f"h AS (SELECT count(*) AS n, count(*) FILTER ({_LUHN.format('card', 0)} % 10 = 0) AS cards, count(*) FILTER ({_LUHN.format('order_no', 0)} % 10 = 0) AS orders FROM c) "
       "SELECT 'email' AS column_name, n AS n_values, 'email' AS class, 'PII' AS kind, 1.0::DOUBLE AS share FROM h UNION ALL "
       "SELECT 'card', n, 'card_number', 'financial', round(cards / n, 6) FROM h UNION ALL "
       "SELECT 'order_no', n, NULL, NULL, round(orders / n, 6) FROM h UNION ALL "
       "SELECT 'phone', n, 'phone', 'PII', 1.0 FROM h UNION ALL SELECT 'c_mktsegment', n, NULL, NULL, 0.0 FROM h")
def column_classes(spark, sf):
    """A class for each column of a customer table with e-mails, card numbers (valid check digits), order numbers of the same form
    and phone numbers."""
    c = table(spark, sf, "customer")
    body = F.lpad(((F.col("c_custkey") * 7919 + 400000000000000) % 1000000000000000).cast("string"), 15, "0")
    twice = F.aggregate(F.transform(F.regexp_extract_all(F.reverse("body"), F.lit("[0-9]"), F.lit(0)), lambda x, i: x.cast("int") * (2 - i % 2)), F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    d = c.withColumn("body", body).select(
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("email"),
        F.concat("body", ((10 - twice % 10) % 10).cast("string")).alias("card"), F.concat("body", F.lit("7")).alias("order_no"),
        F.concat(F.lit("+1 555 "), F.lpad((F.col("c_custkey") % 10_000_000).cast("string"), 7, "0")).alias("phone"), "c_mktsegment")
    return G.classify_columns(d)


@query("catalog_statistics", "G04",
       "SELECT 'c_custkey' AS column_name, count(*) AS n_rows, 0 AS n_null, CAST(min(c_custkey) AS VARCHAR) AS min_value, CAST(max(c_custkey) AS VARCHAR) AS max_value FROM customer UNION ALL "
       "SELECT 'c_nationkey', count(*), 0, CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM customer")
def catalog_statistics(spark, sf):
    """Column statistics that the planner reads, from the catalog (distinct counts are estimates and not shown)."""
    name = f"customer_stats_{uuid.uuid4().hex[:12]}"
    table(spark, sf, "customer").write.saveAsTable(name)
    return G.analyze_table(spark, name, ["c_custkey", "c_nationkey"]).drop("n_distinct")


@query("aqe_skew_join", "J07",
       "SELECT count(*) AS n_rows, count(DISTINCT k) AS n_keys, sum(c_custkey) AS keys FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END AS k FROM lineitem) l "
       "JOIN (SELECT o_orderkey, o_custkey AS c_custkey FROM orders) o ON l.k = o.o_orderkey")
def aqe_skew_join(spark, sf):
    """A join whose first key holds a third of the rows, as AQE plans it (the split is asserted on an executed plan in the tests)."""
    lines = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_orderkey")).alias("k"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    return lines.join(orders.hint("merge"), "k").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("k").alias("n_keys"), F.sum("o_custkey").alias("keys"))


