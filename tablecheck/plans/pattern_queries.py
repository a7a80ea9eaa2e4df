"""Join / aggregation / window / set / projection queries (J, A, W, U, P, O).

Table mapping of the reference's pattern schemas onto the driver tables:
employees -> customer (dept = c_mktsegment, salary = c_acctbal);
orders/purchases -> orders; logins -> events (user_id, day of ts);
trip_revenue -> lineitem (year of ship date, type = l_returnflag);
metrics -> daily order totals.

Sums keep the columns' own type; measures have two decimals, so queries and oracles show sums with
two, which are the same in any order of rows.  Running totals name a decimal type of their own.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablecheck.operators import chunked as CH
from tablecheck.operators import patterns as P
from tablecheck.plans.fixtures import table
from tablecheck.plans.registry import query


def _t(spark, sf, name):
    return table(spark, sf, name)


def _money(c):
    return F.round(F.sum(c), 2)


# =========================================================================== joins
@query("semi", "J03", "SELECT c.* FROM customer c WHERE EXISTS (SELECT 1 FROM orders o "
       "WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')")
def semi(spark, sf):
    urgent = _t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    c = _t(spark, sf, "customer")
    return c.join(urgent, c.c_custkey == urgent.o_custkey, "left_semi")


@query("anti", "J04", "SELECT c.* FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o "
       "WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')")
def anti(spark, sf):
    urgent = _t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    c = _t(spark, sf, "customer")
    return c.join(urgent, c.c_custkey == urgent.o_custkey, "left_anti")


@query("exists", "J10", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN "
       "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def exists(spark, sf):
    """IN-subquery: Catalyst rewrites it to a left-semi join."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    o.createOrReplaceTempView("__orders_j10")
    c.createOrReplaceTempView("__customer_j10")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM __orders_j10 WHERE o_custkey IN "
                     "(SELECT c_custkey FROM __customer_j10 WHERE c_acctbal < 0)")


@query("broadcast_dim", ("J05", "A04"),
       "SELECT n.n_name, r.r_name, count(*) AS n_customers, "
       "round(sum(c.c_acctbal), 2) AS total_acctbal "
       "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey "
       "GROUP BY n.n_name, r.r_name")
def broadcast_dim(spark, sf):
    """Fact x small dimensions: the planner broadcasts them by their known file size."""
    nation, region = _t(spark, sf, "nation"), _t(spark, sf, "region")
    c = _t(spark, sf, "customer")
    j = c.join(nation, c.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    return j.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("n_customers"),
                                             _money("c_acctbal").alias("total_acctbal"))


@query("salted_join", "J06",
       "SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o "
       "JOIN customer c ON o.o_custkey = c.c_custkey")
def salted_join(spark, sf):
    """Skew join by deterministic salting (same rows as the plain join)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return P.salted_join(o, c, "o_custkey", n_salts=8, salt_cols=["o_orderkey"])


@query("band_self_join", "J08",
       "SELECT a.c_name AS c_name_a, b.c_name AS c_name_b, a.c_mktsegment AS c_mktsegment_a, "
       "a.c_acctbal AS c_acctbal_a, b.c_acctbal AS c_acctbal_b FROM customer a JOIN customer b "
       "ON a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey AND abs(a.c_acctbal - b.c_acctbal) <= 100")
def band_self_join(spark, sf):
    """Same segment, a.id < b.id, balances within 100: bucketed band join."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    out = P.band_join(c, c, ["c_mktsegment"], "c_acctbal", 100.0, "c_custkey", "c_custkey")
    return out.select("c_name_a", "c_name_b", "c_mktsegment_a", "c_acctbal_a", "c_acctbal_b")


@query("full_outer", "J09",
       "SELECT coalesce(s.n, c.n) AS nationkey, s.n_suppliers, c.n_customers FROM "
       "(SELECT s_nationkey AS n, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s "
       "FULL OUTER JOIN (SELECT c_nationkey AS n, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 "
       "GROUP BY 1) c ON s.n = c.n")
def full_outer(spark, sf):
    s = (_t(spark, sf, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("n"))
         .agg(F.count(F.lit(1)).alias("n_suppliers")))
    c = (_t(spark, sf, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n"))
         .agg(F.count(F.lit(1)).alias("n_customers")))
    j = s.join(c, s.n == c.n, "full_outer")
    return j.select(F.coalesce(s.n, c.n).alias("nationkey"), "n_suppliers", "n_customers")


@query("right_outer", "J09",
       "SELECT n.n_name, count(s.s_suppkey) AS n_suppliers FROM supplier s RIGHT OUTER JOIN nation n "
       "ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name")
def right_outer(spark, sf):
    s, n = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "right_outer").groupBy("n_name") \
        .agg(F.count("s_suppkey").alias("n_suppliers"))


@query("scalar_subquery", ("J11", "P07"),
       "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > "
       "(SELECT avg(o_totalprice) * 1.5 FROM orders)")
def scalar_subquery(spark, sf):
    """Rows above 1.5x the global average: the average is a scalar subquery
    (one aggregate evaluated once), compared in the scan's filter."""
    o = _t(spark, sf, "orders")
    limit = o.agg(F.avg("o_totalprice") * 1.5).scalar()
    return o.filter(F.col("o_totalprice") > limit).select("o_orderkey", "o_totalprice")


# =========================================================================== aggregates
@query("agg_multi", "A04",
       "SELECT l_returnflag, l_linestatus, count(*) AS n_lines, "
       "round(sum(l_extendedprice), 2) AS revenue, "
       "round(sum(l_quantity), 2) AS sum_qty, "
       "round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_multi(spark, sf):
    return (_t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n_lines"), _money("l_extendedprice").alias("revenue"),
                 _money("l_quantity").alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc")))


@query("median_exact", "A06",
       "SELECT o_orderstatus, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS median_price "
       "FROM orders GROUP BY o_orderstatus")
def median_exact(spark, sf):
    """Exact median from counts per price band, then per price inside the middle bands."""
    return P.exact_median(_t(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", 1000.0, "median_price")


@query("median_approx", "A05",
       "SELECT o_orderstatus, quantile_disc(o_totalprice, 0.5) AS median_price FROM orders GROUP BY o_orderstatus")
def median_approx(spark, sf):
    """Approximate median (sketch, bounded memory); the accuracy asked for makes it exact up to a million rows a group."""
    return _t(spark, sf, "orders").groupBy("o_orderstatus") \
        .agg(F.percentile_approx("o_totalprice", 0.5, 1_000_000).alias("median_price"))


@query("pivot", "A07",
       "SELECT year(l_shipdate) AS year, "
       "round(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A'), 2) AS A, "
       "round(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'N'), 2) AS N, "
       "round(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 2) AS R "
       "FROM lineitem GROUP BY 1")
def pivot(spark, sf):
    """Pivot with an explicit value list (no extra distinct job)."""
    li = _t(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    out = li.groupBy("year").pivot("l_returnflag", ["A", "N", "R"]) \
        .agg(F.sum("l_extendedprice"))
    return out.select("year", *[F.round(c, 2).alias(c) for c in ["A", "N", "R"]])


@query("min_max", "A08",
       "SELECT o_orderpriority, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, "
       "min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1")
def min_max(spark, sf):
    return _t(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


@query("collect_distinct", "A09",
       "SELECT c_nationkey, list_sort(list_distinct(list(c_mktsegment))) AS segments FROM customer GROUP BY 1")
def collect_distinct(spark, sf):
    """Distinct values per group, sorted (bounded by distinct values, not rows)."""
    return _t(spark, sf, "customer").groupBy("c_nationkey") \
        .agg(F.array_sort(F.collect_set("c_mktsegment")).alias("segments"))


_ROLLUP_SQL = ("SELECT l_returnflag, l_linestatus, count(*) AS n_lines, "
               "round(sum(l_quantity), 2) AS sum_qty FROM lineitem GROUP BY {} ")


@query("rollup", "A10", _ROLLUP_SQL.format("ROLLUP (l_returnflag, l_linestatus)"))
def rollup(spark, sf):
    return _t(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus") \
        .agg(F.count(F.lit(1)).alias("n_lines"), _money("l_quantity").alias("sum_qty"))


@query("cube", "A10", _ROLLUP_SQL.format("CUBE (l_returnflag, l_linestatus)"))
def cube(spark, sf):
    return _t(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus") \
        .agg(F.count(F.lit(1)).alias("n_lines"), _money("l_quantity").alias("sum_qty"))


@query("grouping_sets", "A10",
       _ROLLUP_SQL.format("GROUPING SETS ((l_returnflag), (l_linestatus), ())"))
def grouping_sets(spark, sf):
    li = _t(spark, sf, "lineitem")
    li.createOrReplaceTempView("__lineitem_gs")
    return spark.sql(_ROLLUP_SQL.format("GROUPING SETS ((l_returnflag), (l_linestatus), ())")
                     .replace("FROM lineitem", "FROM __lineitem_gs"))


@query("distinct_threshold", "A12",
       "SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_type) AS n_types FROM events "
       "GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 3")
def distinct_threshold(spark, sf):
    """Entities active in more than 3 categories per day."""
    e = _t(spark, sf, "events")
    return (e.groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.count_distinct("event_type").alias("n_types")).filter(F.col("n_types") > 3))


@query("null_semantics", "A13",
       "SELECT count(*) AS n_all, count(v) AS n_values, sum(v) AS sum_values FROM "
       "(SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS v FROM orders)")
def null_semantics(spark, sf):
    """COUNT(*) counts every row, COUNT(x)/SUM(x) skip nulls."""
    v = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey"))
    o = _t(spark, sf, "orders").select(v.alias("v"))
    return o.agg(F.count(F.lit(1)).alias("n_all"), F.count("v").alias("n_values"), F.sum("v").alias("sum_values"))


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount")


@query("describe", "A11",
       " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, "
                          f"round(stddev({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
                          for c in _DESCRIBED))
def describe(spark, sf):
    """``summary`` of three columns, turned to one row per column."""
    s = _t(spark, sf, "lineitem").select(*_DESCRIBED).summary("count", "mean", "stddev", "min", "max")
    long = s.unpivot("summary", list(_DESCRIBED), "column_name", "value")
    wide = long.groupBy("column_name").pivot("summary", ["count", "mean", "stddev", "min", "max"]).agg(F.first("value"))
    return wide.select("column_name", F.col("count").cast("long").alias("n"),
                       *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("mean", "stddev")],
                       *[F.col(c).cast("double").alias(c) for c in ("min", "max")])


# =========================================================================== windows
_ORD = "orders"


def _month():
    return F.year("o_orderdate") * 12 + F.month("o_orderdate")


@query("rank_row_number", ("W03", "W04", "W05"),
       "SELECT o_orderkey, o_custkey, o_totalprice, "
       "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn, "
       "rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rnk, "
       "dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS drnk FROM orders")
def rank_row_number(spark, sf):
    """Every customer chunked by 10000-wide price bands (descending), so a hot
    customer's rows spread over tasks."""
    o = _t(spark, sf, _ORD).select("o_orderkey", "o_custkey", "o_totalprice")
    chunk = -F.floor(F.col("o_totalprice") / 10000)
    out = CH.chunked_rank(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")],
                          chunk, order_cols_for_distinct=["o_totalprice"], rank_order=[F.col("o_totalprice").desc()])
    return out


@query("lag_lead", ("W06", "W07"),
       "SELECT o_orderkey, o_custkey, o_totalprice, "
       "lag(o_totalprice, 1, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_price, "
       "lead(o_totalprice, 1, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price "
       "FROM orders")
def lag_lead(spark, sf):
    """Customers chunked by order month: in-chunk lag/lead, neighbour chunks
    at the edges."""
    o = _t(spark, sf, _ORD).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    chunk = _month()
    out = CH.chunked_lag_lead(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], chunk,
                              "o_totalprice", "prev_price", "next_price", default=0.0)
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "prev_price", "next_price")


@query("ntile", "W08",
       "SELECT c_custkey, c_mktsegment, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) "
       "AS quartile FROM customer")
def ntile(spark, sf):
    """Quartiles inside 5 large segments, chunked by balance (10-wide bands), so a
    segment is not one task."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    chunk = F.floor(F.col("c_acctbal") / 10)
    out = CH.chunked_ntile(c, ["c_mktsegment"], [F.col("c_acctbal"), F.col("c_custkey")], chunk, 4, "quartile")
    return out.select("c_custkey", "c_mktsegment", "quartile")


@query("first_last", "W09",
       "SELECT DISTINCT o_custkey, "
       "first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_order, "
       "last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order FROM orders")
def first_last(spark, sf):
    """First/last per key as an aggregate (min_by/max_by): partial aggregation,
    no full-partition sort, same answer as the unbounded window."""
    o = _t(spark, sf, _ORD)
    k = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(F.min_by("o_orderkey", k).alias("first_order"),
                                      F.max_by("o_orderkey", k).alias("last_order"))


@query("running_rows", "W10",
       "SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey "
       "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total "
       "FROM orders")
def running_rows(spark, sf):
    """Running total per customer, chunked by order month (offset = earlier months' sum)."""
    o = _t(spark, sf, _ORD).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    chunk = _month()
    out = CH.chunked_running_sum(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], chunk,
                                 F.col("o_totalprice").cast("decimal(18,2)"), "running_total", "rows")
    return out.select("o_orderkey", "o_custkey", F.col("running_total").cast("double").alias("running_total"))


@query("running_range", "W11",
       "SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey "
       "ORDER BY o_orderdate) AS DOUBLE) AS running_total FROM orders")
def running_range(spark, sf):
    """Default frame = RANGE: rows with the same order date share the sum
    (customers chunked by month, so ties never span chunks)."""
    o = _t(spark, sf, _ORD).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    chunk = _month()
    out = CH.chunked_running_sum(o, ["o_custkey"], [F.col("o_orderdate")], chunk,
                                 F.col("o_totalprice").cast("decimal(18,2)"), "running_total", "range")
    return out.select("o_orderkey", "o_custkey", F.col("running_total").cast("double").alias("running_total"))


_DAILY = ("WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, "
          "round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ")


@query("moving_avg7", "W12",
       _DAILY + "SELECT day, total, round(avg(total) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) "
       "AS ma7 FROM d")
def moving_avg7(spark, sf):
    """7-row moving average over daily totals (one row per day: the window's
    single partition is calendar-sized, not data-sized)."""
    d = P.periodic_totals(_t(spark, sf, _ORD), "o_orderdate", F.col("o_totalprice"), "day").withColumnRenamed(
        "period", "day")
    w = Window.orderBy("day").rowsBetween(-6, 0)
    return d.select("day", F.round("total", 2).alias("total"), F.round(F.avg("total").over(w), 2).alias("ma7"))


_MONTHLY_TYPE = ("WITH m AS (SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, "
                 "round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2) ")


@query("moving_avg_3m", "W13",
       _MONTHLY_TYPE + "SELECT l_returnflag, period, total, round(avg(total) OVER (PARTITION BY l_returnflag "
       "ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS ma3 FROM m")
def moving_avg_3m(spark, sf):
    m = P.periodic_totals(_t(spark, sf, "lineitem"), "l_shipdate", F.col("l_extendedprice"), "month",
                          ["l_returnflag"])
    w = Window.partitionBy("l_returnflag").orderBy("period").rowsBetween(-2, 0)
    return m.select("l_returnflag", "period", F.round("total", 2).alias("total"), F.round(F.avg("total").over(w), 2).alias("ma3"))


_MONTHLY = ("WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, "
            "round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1), "
            "c AS (SELECT period, total, lag(total) OVER (ORDER BY period) AS prev_total FROM m) ")
_PCT = "round(CASE WHEN prev_total = 0 THEN NULL ELSE (total - prev_total) * 100.0 / prev_total END, 2)"


@query("mom_change", "W14", _MONTHLY + f"SELECT period, total, prev_total, {_PCT} AS pct_change FROM c")
def mom_change(spark, sf):
    m = P.periodic_totals(_t(spark, sf, _ORD), "o_orderdate", F.col("o_totalprice"), "month")
    return P.period_change(m).select("period", *[F.round(c, 2).alias(c) for c in ("total", "prev_total")], "pct_change")


@query("mom_drop", "W15", _MONTHLY + f"SELECT period, total, prev_total, {_PCT} AS pct_change FROM c "
       f"WHERE {_PCT} < -20")
def mom_drop(spark, sf):
    """Months whose total fell by more than 20 %."""
    return mom_change(spark, sf).filter(F.col("pct_change") < -20)


@query("top3", "W16",
       "SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT o_custkey, o_orderkey, o_totalprice, "
       "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) "
       "WHERE rn <= 3")
def top3(spark, sf):
    o = _t(spark, sf, _ORD).select("o_custkey", "o_orderkey", "o_totalprice")
    return P.top_n(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("second_highest", "W17",
       "SELECT c_custkey, c_mktsegment, c_acctbal FROM (SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment "
       "ORDER BY c_acctbal DESC) AS dr FROM customer) WHERE dr = 2")
def second_highest(spark, sf):
    c = _t(spark, sf, "customer")
    return P.nth_highest(c, ["c_mktsegment"], "c_acctbal", 2).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("anomaly_5min", ("W18", "J11"),
       "SELECT event_id, ts, value FROM (SELECT event_id, ts, value, avg(value) OVER (ORDER BY ts "
       "RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS a5 FROM events) WHERE value > 3 * a5")
def anomaly_5min(spark, sf):
    """Value above 3x the trailing-5-minute average, exact RANGE frame, computed
    per hour bucket with a 5-minute halo (parallel, not one global task)."""
    e = _t(spark, sf, "events").select("event_id", "ts", "value")
    out = P.trailing_window(e, "ts", 300, {"a5": F.avg("value")}, bucket_seconds=3600)
    return out.filter(F.col("value") > 3 * F.col("a5")).select("event_id", "ts", "value")


@query("sliding_count", "T05",
       "SELECT event_id, user_id, ts, n5 FROM (SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id "
       "ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS n5 FROM events) WHERE n5 > 1")
def sliding_count(spark, sf):
    """Sliding window evaluated per event, HAVING count > threshold (threshold 1 at this data density)."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    out = P.trailing_window(e, "ts", 300, {"n5": F.count(F.lit(1))}, ["user_id"], bucket_seconds=3600)
    return out.filter(F.col("n5") > 1)


@query("gaps_islands", "W19",
       "WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), "
       "g AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp "
       "FROM d) SELECT user_id, min(day) AS start_period, max(day) AS end_period, count(*) AS length "
       "FROM g GROUP BY user_id, grp")
def gaps_islands(spark, sf):
    return P.islands(_t(spark, sf, "events"), ["user_id"], F.to_date("ts"), "day")


@query("consecutive_days", "W20",
       "WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS period FROM events), "
       "l AS (SELECT user_id, period, lag(period) OVER (PARTITION BY user_id ORDER BY period) AS prev_period FROM d) "
       "SELECT user_id, period, prev_period FROM l WHERE period - prev_period = 1")
def consecutive_days(spark, sf):
    return P.consecutive_pairs(_t(spark, sf, "events"), ["user_id"], F.to_date("ts"), "day")


@query("consecutive_months", "W21",
       "WITH d AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders), "
       "l AS (SELECT o_custkey, period, lag(period) OVER (PARTITION BY o_custkey ORDER BY period) AS prev_period "
       "FROM d) SELECT o_custkey, period, prev_period FROM l WHERE date_diff('month', prev_period, period) = 1")
def consecutive_months(spark, sf):
    return P.consecutive_pairs(_t(spark, sf, _ORD), ["o_custkey"],
                               F.date_trunc("month", "o_orderdate").cast("date"), "month")


@query("three_consecutive_months", "W22",
       "WITH d AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders), "
       "g AS (SELECT o_custkey, m, year(m) * 12 + month(m) - row_number() OVER (PARTITION BY o_custkey ORDER BY m) "
       "AS grp FROM d) SELECT o_custkey, min(m) AS start_period, max(m) AS end_period, count(*) AS length FROM g "
       "GROUP BY o_custkey, grp HAVING count(*) >= 3")
def three_consecutive_months(spark, sf):
    isl = P.islands(_t(spark, sf, _ORD), ["o_custkey"], F.date_trunc("month", "o_orderdate").cast("date"), "month")
    return isl.filter(F.col("length") >= 3)


# =========================================================================== set operations
_U_A = "(SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))"
_U_B = "(SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000)"


def _ua(spark, sf):
    return _t(spark, sf, _ORD).filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) \
        .select("o_custkey", "o_orderstatus")


def _ub(spark, sf):
    return _t(spark, sf, _ORD).filter(F.col("o_totalprice") > 100000).select("o_custkey", "o_orderstatus")


@query("intersect", "U01", f"SELECT * FROM {_U_A} INTERSECT SELECT * FROM {_U_B}")
def intersect(spark, sf):
    return _ua(spark, sf).intersect(_ub(spark, sf))


@query("except_all", "U02", f"SELECT * FROM {_U_A} EXCEPT ALL SELECT * FROM {_U_B}")
def except_all(spark, sf):
    return _ua(spark, sf).exceptAll(_ub(spark, sf))


@query("union_by_name", "U03",
       "SELECT o_orderkey AS k, o_orderstatus AS status, NULL AS flag FROM orders WHERE o_orderpriority = '1-URGENT' "
       "UNION ALL SELECT l_orderkey, NULL, l_returnflag FROM lineitem WHERE l_quantity > 49")
def union_by_name(spark, sf):
    a = _t(spark, sf, _ORD).filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("k"),
                                                                         F.col("o_orderstatus").alias("status"))
    b = _t(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_returnflag").alias("flag"),
                                                                  F.col("l_orderkey").alias("k"))
    return a.unionByName(b, allowMissingColumns=True)


@query("union_distinct", "U04", f"SELECT * FROM {_U_A} UNION SELECT * FROM {_U_B}")
def union_distinct(spark, sf):
    return _ua(spark, sf).union(_ub(spark, sf)).distinct()


@query("drop_duplicates", ("U05", "A02", "A03"),
       "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_duplicates(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


# =========================================================================== projection / filter / sort
@query("rename_recast", ("P01", "P03"),
       "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, "
       "CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def rename_recast(spark, sf):
    """Rename + recast from a mapping list, one projection."""
    from tablecheck.operators.transform import rename_cast
    mapping = [("o_orderkey", "string", "order_id"), ("o_custkey", "int", "customer_id"),
               ("o_totalprice", "decimal(12,2)", "amount"), ("o_orderdate", "date", "order_date")]
    return rename_cast(_t(spark, sf, _ORD), mapping)


@query("resolve_types", "P04",
       "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def resolve_types(spark, sf):
    """Ambiguous text field resolved to double with try_cast; null-only columns dropped."""
    from tablecheck.operators.transform import drop_all_null_columns
    e = _t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"),
                                       F.lit(None).cast("string").alias("always_null"))
    return drop_all_null_columns(e)


@query("fillna_dropna", "P05",
       "SELECT order_id, coalesce(cust_id, 'unknown') AS cust_id, coalesce(status, 'U') AS status "
       "FROM (SELECT 'ORD' || CAST(o_orderkey AS VARCHAR) AS order_id, "
       "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust_id, "
       "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderstatus END AS status, "
       "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS prio FROM orders) WHERE prio IS NOT NULL")
def fillna_dropna(spark, sf):
    o = _t(spark, sf, _ORD).select(
        F.concat(F.lit("ORD"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(F.col("o_orderkey") % 97 == 0, None).otherwise(F.col("o_custkey").cast("string")).alias("cust_id"),
        F.when(F.col("o_orderkey") % 89 == 0, None).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 83 == 0, None).otherwise(F.col("o_orderpriority")).alias("prio"))
    return o.dropna(subset=["prio"]).fillna({"cust_id": "unknown", "status": "U"}).drop("prio")


@query("explode_array", "P06",
       "SELECT c_custkey, unnest(list_sort(list_distinct(list(o_orderstatus)))) AS status FROM customer "
       "JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def explode_array(spark, sf):
    o = _t(spark, sf, _ORD)
    arr = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_set("o_orderstatus")).alias("a"))
    return arr.select("c_custkey", F.explode("a").alias("status"))


@query("cte_having", "P07",
       "WITH t AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15) "
       "SELECT c.c_custkey, c.c_name, t.n FROM t JOIN customer c ON c.c_custkey = t.o_custkey")
def cte_having(spark, sf):
    t = _t(spark, sf, _ORD).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 15")
    c = _t(spark, sf, "customer")
    return t.join(c, t.o_custkey == c.c_custkey).select("c_custkey", "c_name", "n")


@query("order_limit", ("O01", "O02"),
       "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def order_limit(spark, sf):
    """Top 100 by a multi-key order (LIMIT is the feature: TakeOrderedAndProject)."""
    return _t(spark, sf, _ORD).select("o_orderkey", "o_totalprice", "o_orderdate") \
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("filter_null_logic", "P02",
       "WITH f AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderstatus END AS status, "
       "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice END AS price, o_orderkey FROM orders) "
       "SELECT o_orderkey, status, price FROM f WHERE (status = 'F' OR status IS NULL) AND price IS NOT NULL "
       "AND NOT (price < 1000 AND status IS NULL)")
def filter_null_logic(spark, sf):
    """AND / OR / IS NULL under three-valued logic."""
    o = _t(spark, sf, _ORD).select(
        F.when(F.col("o_orderkey") % 97 == 0, None).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 89 == 0, None).otherwise(F.col("o_totalprice")).alias("price"), "o_orderkey")
    cond = ((F.col("status") == "F") | F.col("status").isNull()) & F.col("price").isNotNull() & \
        ~((F.col("price") < 1000) & F.col("status").isNull())
    return o.filter(cond).select("o_orderkey", "status", "price")
