"""Import every query module so the registry is complete."""

from __future__ import annotations

from tablecheck.plans import dq_queries, govern_queries, lake_queries, load_queries, pattern_queries, report_queries, stream_queries  # noqa: F401
from tablecheck.plans.registry import IDS, ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "IDS"]
