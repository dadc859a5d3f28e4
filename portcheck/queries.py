"""All registered queries and their SQL."""

from . import columns, increments, loads, tables, versioned  # noqa: F401  (registering is the import's effect)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
