"""Named queries and their SQL: modules of this package register with ``@query``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables below one folder, read when named; pruning and push-down are left to the optimizer."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of ``Tables``; ``sql``: the same result in DuckDB's SQL, if SQL can express it."""

    def register(f: Callable[[Tables], DataFrame]):
        @wraps(f)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Tables(spark, folder))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
