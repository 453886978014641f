"""The retail model laid over the driver's tables, its registered queries and their SQL checks."""

from tidemark.workload import (  # noqa: F401
    gold_queries,
    report_queries,
    silver_queries,
    stream_queries,
)
from tidemark.workload.registry import QUERIES, Query, runnable

__all__ = ["QUERIES", "Query", "runnable"]
