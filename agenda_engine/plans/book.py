"""The book of named queries and of the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where SQL can express it."""

    def add(make):
        QUERIES[make.__name__] = make
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make

    return add
