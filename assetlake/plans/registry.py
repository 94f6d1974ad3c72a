"""Named queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import limit_methods

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with its checking SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(limit_methods(spark), sf_dir)
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register
