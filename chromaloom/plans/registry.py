"""A query with its SQL for the other engine, if SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self._queries: dict[str, Query] = {}
        self._sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self._queries:
            raise ValueError(f"{name} is there already")
        self._queries[name] = query
        if sql is not None:
            self._sql[name] = sql

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.add(name or f.__name__, f, sql)
            return f

        return add

    def queries(self) -> dict[str, Query]:
        return dict(self._queries)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
