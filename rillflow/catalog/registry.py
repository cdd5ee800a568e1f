"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rillflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables by name; each is scanned lazily and pruned by Catalyst."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__

        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return build

    return register
