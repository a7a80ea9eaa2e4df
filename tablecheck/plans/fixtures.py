"""Shared inputs for the query catalogue.

``F1_SQL`` is the dirty order feed (FIXTURES.md §B): every ``orders`` row, with
deterministic dirt injected by key, plus late lower-cased repeats.  The text is
valid in Spark SQL and DuckDB; ``{orders}`` is bound to a DataFrame in Spark
(``spark.sql(text, orders=df)``) and to the view name in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

F1_SQL = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(o_orderdate AS DATE) AS d FROM {orders}),
t AS (
  SELECT k, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(year(d) AS STRING) || '.' || lpad(CAST(month(d) AS STRING), 2, '0') || '.' || lpad(CAST(day(d) AS STRING), 2, '0') AS dt
  FROM b),
r AS (
  SELECT 'ORD' || CAST(k AS STRING) AS order_id,
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 97 = 1 THEN '' ELSE CAST(o_custkey AS STRING) END AS cust_id,
    CASE WHEN k % 89 = 0 THEN 'X' WHEN k % 89 = 1 THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN k % 71 = 0 THEN 'N/A' WHEN k % 71 = 1 THEN '-5.00' WHEN k % 71 = 2 THEN '1e3' WHEN k % 71 = 3 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS price_txt,
    CASE WHEN k % 83 = 0 THEN '2024.13.40' WHEN k % 83 = 1 THEN '2024-01-05' WHEN k % 83 = 2 THEN NULL WHEN k % 83 = 3 THEN ''
         ELSE dt END AS order_date,
    CASE WHEN k % 67 = 0 THEN '1990.01.01' ELSE '2024.12.31' END AS end_date,
    CASE WHEN k % 61 = 0 THEN o_orderpriority || ';x' ELSE o_orderpriority END AS note,
    CASE WHEN k % 101 = 0 THEN 'row_to_delete' ELSE 'keep' END AS action,
    k AS ts_rank, 'part-' || CAST(k % 8 AS STRING) AS source_file_name
  FROM t)
SELECT * FROM r
UNION ALL
SELECT lower(order_id), cust_id, status, price_txt, order_date, end_date, note, action, ts_rank + 1000000, 'late-0'
FROM r WHERE ts_rank % 53 = 0
"""

F1_COLUMNS = ["order_id", "cust_id", "status", "price_txt", "order_date", "end_date", "note",
              "action", "ts_rank", "source_file_name"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty order feed as a lazy DataFrame over ``orders``."""
    return spark.sql(F1_SQL, orders=table(spark, sf_dir, "orders"))


def f1_cte() -> str:
    """F1 as a DuckDB CTE named ``f1`` (prefix for oracle SQL)."""
    return "WITH f1 AS (" + F1_SQL.replace("{orders}", "orders") + ")\n"
