"""Every registered query runs and matches its DuckDB oracle (sf0.001)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from tablecheck.plans.fixtures import TABLES  # noqa: E402
from tablecheck.plans.catalog import ORACLES, QUERIES  # noqa: E402
from tablecheck.plans.registry import IDS  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_names_survey_ids():
    assert len(QUERIES) >= 100 and set(QUERIES) <= set(entry.queries())
    for name in QUERIES:
        assert IDS[name], name
        assert "pipeline" not in name and not name.startswith("op")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 7 and df.columns == ["check_passed", "check_column_name", "n_fail"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, res.fetchall())
