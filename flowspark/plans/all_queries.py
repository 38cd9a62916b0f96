"""Importing this module registers every query."""

from flowspark.plans import flow_queries, forest_queries, model_queries, score_queries, table_queries  # noqa: F401
from flowspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
