"""tablecheck — Spark-native table checks, cleaning and lakehouse pipeline operators.

Sub-packages:

* ``functions``  – Column factories (row predicates, safe parsing, hashing keys).
* ``operators``  – DataFrame -> DataFrame operators: the fused rule evaluator,
  key-level dedup, lookups, reports, joins, windows, change/merge, governance.
* ``sources``    – reading/landing/versioned tables, ledgers, done markers.
* ``streaming``  – Structured Streaming jobs (windows, watermarks, stateful).
* ``plans``      – the query catalogue (``queries()`` / ``oracle_sql()``) and fixtures.
"""

from tablecheck.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
