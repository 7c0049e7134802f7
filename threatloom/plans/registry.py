"""Registry of the queries over the supplied tables, each with its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from threatloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The supplied tables of one folder; columns are pruned and filters pushed by the readers' plans."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name, with its check."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return run

    return register
