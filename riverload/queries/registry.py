"""Collecting queries and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riverload.fixtures import view

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register the decorated function under its own name, with its SQL."""
        def register(query: Query) -> Query:
            name = query.__name__
            if name in self.queries:
                raise ValueError(f"query {name!r} registered twice")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query
        return register


class Input:
    """Frames of one data folder by name, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)
