"""Registered queries: a Spark function and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def r(expression: str, digits: int) -> str:
    """SQL for rounding half to even on the exact value: through fixed-decimal text."""
    return f"(CAST(format('{{:.{digits}f}}', CAST({expression} AS DOUBLE)) AS DOUBLE) + 0.0)"


def rs(expression: str, digits: int) -> str:
    """SQL for rounding an aggregate: four digits finer first, so that summation order does not show."""
    return r(r(expression, digits + 4), digits)
