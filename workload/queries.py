"""All queries and SQL twins."""

from __future__ import annotations

from workload import (  # noqa: F401
    children_queries,
    flow_queries,
    link_queries,
    recode_queries,
    source_queries,
    table_queries,
)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
