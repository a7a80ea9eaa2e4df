"""Structured Streaming jobs.

Every function takes and returns DataFrames; the same window/aggregate code
runs on a batch DataFrame (for backfills and oracle tests) and on a streaming
one.  Event times from the driver tables are TIMESTAMP_NTZ, which watermarks
refuse, so ``event_time`` casts to TIMESTAMP (session zone is UTC).
"""
