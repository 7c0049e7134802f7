"""All registered queries."""

from threatloom.plans import event_queries, landing_queries, storage_queries, stream_queries, vulnerability_queries  # noqa: F401
from threatloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
