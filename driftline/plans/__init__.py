"""Registered queries (name -> callable) and their DuckDB oracles."""

from driftline.plans import (drift_plans, ml_plans, monitor_plans, relational_plans,  # noqa: F401
                             stream_plans, table_plans, udf_plans)
from driftline.plans.registry import FAMILY, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "FAMILY"]
