"""Named queries of the core, each a function (spark, folder) -> DataFrame, with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, and the SQL of those that DuckDB can express."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Decorator: register a query under ``name``."""

        def register(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = function
            if sql:
                self.oracles[name] = sql
            return function

        return register
