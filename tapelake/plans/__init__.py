"""Registered queries: an operator call on the market views beside the SQL that must give the same rows."""

from tapelake.plans import analytics, charts, ingestion, medallion, quality, scalars, security, selection, storage  # noqa: F401
from tapelake.plans.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
