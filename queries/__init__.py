"""Registered queries over the driver tables, each next to the SQL it has to equal."""

from queries import cleaning, lake, layers, pages  # noqa: F401
from queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
