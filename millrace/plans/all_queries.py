"""Importing this module registers every query."""

from millrace.plans import (  # noqa: F401
    aggregate_queries,
    diff_queries,
    graph_queries,
    join_queries,
    load_queries,
    project_queries,
    source_queries,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
