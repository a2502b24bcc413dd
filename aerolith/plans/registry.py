"""Queries by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Registers a query; its SQL may name the views, which come before it as common table expressions."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ctes = ",\n".join(VIEWS[v] for v in views.split())
            body = sql.strip()
            SQL[name] = f"WITH {ctes}{',' if body.startswith('%') else ''}\n{body.lstrip('%')}" if ctes else body.lstrip("%")
        return f

    return add


def r(c: str | Column, digits: int = 6) -> Column:
    """A double rounded for comparison, under its own name."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits).alias(c) if isinstance(c, str) else F.round(c, digits)
