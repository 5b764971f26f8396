"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from tickroll.plans import candle_queries, ingest_queries, merge_queries, payload_queries, stream_queries, job_queries  # noqa: F401
from tickroll.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
