"""Registration of queries: a name, the Spark job, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        """Register the decorated function; without SQL only its rows are checked."""
        def keep(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.oracles[name] = sql
            return function
        return keep


REGISTRY = Registry()
query = REGISTRY.query
