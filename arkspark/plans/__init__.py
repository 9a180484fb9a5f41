"""Registered queries over the given tables, with their SQL."""

from arkspark.plans import archive_queries, capture_queries, context_queries, name_queries, record_queries  # noqa: F401  register their queries
from arkspark.plans.queries import QUERIES, SQL  # noqa: F401
