"""Queries on the given tables and their SQL twins."""

from costgauge.workload import compute, exports, ingestion, pricing, series, services  # noqa: F401  (they register their queries)
from costgauge.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
