"""Named queries over the driver tables, each with the SQL that checks it."""

from quayside.registry import aggregates, elements, mechanisms, reports, storage  # noqa: F401
from quayside.registry.core import QUERIES, check_sql

__all__ = ["QUERIES", "check_sql"]
