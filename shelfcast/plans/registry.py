"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def r6(column: str | Column, name: str | None = None) -> Column:
    """Round to six places, so that engines adding in another order agree.

    Plain arithmetic; ``round`` on a double goes through a decimal per value.
    """
    source = F.col(column) if isinstance(column, str) else column
    return (F.floor(source * 1e6 + 0.5) / 1e6).alias(name or column)
