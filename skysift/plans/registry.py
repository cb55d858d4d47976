"""Queries with their SQL checks, registered where they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return add


#: The moment the relative-time filters count from.
NOW = "2021-01-25 00:00:00"
