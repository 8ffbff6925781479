"""Registered queries over the given tables."""

from tidewater.plans import batch_queries, gold_queries, load_queries, source_queries  # noqa: F401
from tidewater.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
