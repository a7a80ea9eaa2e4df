"""Session helpers.

Library code never creates a global session: every operator takes the
DataFrames it works on.  ``get_session`` is a convenience for scripts,
tests and the bench; on a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: ANSI stays on (Spark 4 default), so the
# operators use try_* functions; timestamps are pinned to UTC because the
# driver tables carry TIMESTAMP_NTZ and watermarks need TIMESTAMP.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablecheck", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one for tests/bench.

    J07: AQE with skew-join splitting is on; partition coalescing follows
    the real shuffle sizes."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("TABLECHECK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def is_one_machine(master: str) -> bool:
    """A plain local master: driver and executor threads share one disk."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used unchanged; unset, it is an error, since executors could not read back
    what others wrote to their own disks.  Only with a local master, one machine, is a
    fresh scratch folder made.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tablecheck-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
