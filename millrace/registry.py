"""All queries by name, each with the SQL that an independent engine checks it by."""

from __future__ import annotations

from millrace.plans import assisted_queries, page_queries, pool_queries, report_queries, scalar_queries, service_queries, source_queries  # noqa: F401  queries register themselves
from millrace.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
