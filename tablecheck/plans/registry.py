"""Registry behind ``__spark_entry__.queries()`` / ``oracle_sql()``.

Each query is a function ``(spark, sf_dir) -> DataFrame`` registered with the
survey IDs it covers and, where SQL can express it, the DuckDB oracle text.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, tuple[str, ...]] = {}


def query(name: str, ids: tuple[str, ...] | str = (), oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = (ids,) if isinstance(ids, str) else tuple(ids)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco
