"""All registered queries."""

from shopfloor import (  # noqa: F401
    load_queries,
    telemetry_queries,
    time_queries,
    warehouse_queries,
)
from shopfloor.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
