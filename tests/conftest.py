import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tablecheck.session import BASE_CONF, checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("tablecheck-tests")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    wh = tempfile.mkdtemp(prefix="tablecheck-wh-", dir="/tmp")
    s = (b.config("spark.sql.shuffle.partitions", "8").config("spark.sql.warehouse.dir", wh)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tablecheck-test-", dir="/tmp")


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
