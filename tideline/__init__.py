"""Layered, metadata-driven incremental ETL written as Spark jobs.

Three layers, each fed from the one before it: ``raw`` holds the rows of one
time window per batch, ``ext`` the current state by key, ``enrich`` summaries by
month. A control table names the packages, an append-only log drives what runs
next. Operators take and return DataFrames; sinks and flows run the jobs.
"""

from tideline.session import build_session, drop_scratch, scratch_path

__all__ = ["build_session", "drop_scratch", "scratch_path"]
