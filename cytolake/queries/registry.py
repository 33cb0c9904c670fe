"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.fixtures import with_fixtures

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) under a name, with SQL over the projections where there is any."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            SQL[name] = with_fixtures(sql)
        return f

    return add


def r6(column: str, alias: str | None = None) -> Column:
    """Rounded to 6 places, as the SQL is."""
    return F.round(column, 6).alias(alias or column)
