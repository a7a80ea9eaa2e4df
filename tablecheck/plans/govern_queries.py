"""Governance and layout queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablecheck.functions import morton_key
from tablecheck.operators import govern as G
from tablecheck.plans.fixtures import table
from tablecheck.plans.registry import query
from tablecheck.sources import ingest as I


@query("mask_sha256", "G07",
       "SELECT c_custkey, sha256('pepper:' || c_name) AS c_name, c_nationkey, c_mktsegment FROM customer")
def mask_sha256(spark, sf):
    """Salted SHA-256 of the name; balance dropped for the gold layer."""
    return G.mask_columns(table(spark, sf, "customer"), ["c_name"], salt="pepper:", drop=["c_acctbal"])


_GRANTS = {"analyst": ["c_custkey", "c_nationkey", "c_mktsegment"],
           "finance": ["c_custkey", "c_acctbal"]}


@query("role_view", "G08", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def role_view(spark, sf):
    return G.role_view(table(spark, sf, "customer"), "analyst", _GRANTS)


@query("column_mask", "G09",
       "SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), "
       "'[0-9]', 'n', 'g') AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey < 10")
def column_mask(spark, sf):
    """Support role: names masked, rows limited to nations 0–9."""
    return G.masked_view(table(spark, sf, "customer"), "support", {"admin"}, ["c_name"], "c_nationkey < 10",
                         {"support"})


_PII_SQL = " UNION ALL ".join(
    f"SELECT 'text' AS column_name, '{name}' AS pattern, "
    f"CAST(count(*) FILTER (WHERE regexp_matches(text, '{rx.replace(chr(39), chr(39) * 2)}')) AS BIGINT) AS n_hits, "
    f"round(count(*) FILTER (WHERE regexp_matches(text, '{rx.replace(chr(39), chr(39) * 2)}')) / count(*), 6) "
    f"AS hit_rate FROM documents"
    for name, rx in G.PII_PATTERNS.items())


@query("pii_scan", "G10", _PII_SQL)
def pii_scan(spark, sf):
    """PII pattern hit rates over whole document texts, one scan."""
    return G.pii_scan(table(spark, sf, "documents"), ["text"])


@query("lineage", "G11",
       "SELECT 'orders.parquet' AS source_file, 'daily_load' AS pipeline, 'run-42' AS run_id, count(*) AS n_rows "
       "FROM orders")
def lineage(spark, sf):
    """Lineage columns from the scan metadata, summarised per source file."""
    o = G.add_lineage(table(spark, sf, "orders"), "daily_load", "run-42", dt.datetime(2024, 1, 1))
    return o.groupBy(F.regexp_extract("_source_file", r"([^/]+)$", 1).alias("source_file"),
                     F.col("_pipeline").alias("pipeline"), F.col("_run_id").alias("run_id")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


@query("column_stats", "G04",
       "SELECT 'o_custkey' AS column_name, count(o_custkey) AS n_non_null, "
       "CAST(count(*) - count(o_custkey) AS BIGINT) AS n_null, count(DISTINCT o_custkey) AS n_distinct, "
       "CAST(min(o_custkey) AS VARCHAR) AS min_value, CAST(max(o_custkey) AS VARCHAR) AS max_value FROM orders "
       "UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), CAST(count(*) - count(o_orderstatus) AS BIGINT), "
       "count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders")
def column_stats(spark, sf):
    return G.column_stats(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


def _morton_sql(cols, bits=16):
    k = len(cols)
    terms = [f"(((CAST({c} AS BIGINT) >> {b}) & 1) << {b * k + i})" for i, c in enumerate(cols) for b in range(bits)]
    return " | ".join(terms)


@query("zorder_key", "G02",
       f"SELECT l_orderkey, l_linenumber, {_morton_sql(['l_partkey', 'l_suppkey'])} AS z FROM lineitem")
def zorder_key(spark, sf):
    """Morton key interleaving part and supplier keys (the clustering key of G02)."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", morton_key(["l_partkey", "l_suppkey"]).alias("z"))


@query("compaction_plan", "G01")
def compaction_plan(spark, sf, target_bytes: int = 128 * 1024 * 1024):
    """Files per table after compaction to ~128 MB (metadata only; rows-only)."""
    inv = I.file_inventory(spark, sf)
    return inv.select("path", "size_bytes",
                      F.greatest(F.lit(1), F.ceil(F.col("size_bytes") / F.lit(target_bytes))).alias("target_files"))
