"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tractwise.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The driver's tables as attributes. A table's schema is read from its files
    once, so later reads start no job to infer it."""

    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def stored(self, df: DataFrame) -> DataFrame:
        """``df`` written as a table in the shared folder, for results read more than once."""
        path = scratch_path(self.spark, "table")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def check(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with its SQL if it has any."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
