"""All queries of the engine, with their SQL. Importing a module registers its queries."""

from . import core_queries, event_queries, flight_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
