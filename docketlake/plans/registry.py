"""Registration of queries with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketlake.session import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Lazy access to the tables of a folder: ``t.cells`` reads ``cells.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)


class Registry:
    """Queries by name; a query takes its tables and returns a DataFrame."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(function: Callable[[Tables], DataFrame]):
            name = function.__name__
            self.queries[name] = lambda spark, folder: function(Tables(spark, folder))
            if sql is not None:
                self.sql[name] = sql
            return function

        return register
