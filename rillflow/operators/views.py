"""Named views over day tables (ALS-01 .. ALS-04)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def publish(name: str, *tables: DataFrame, only: Column | None = None) -> DataFrame:
    """Point a name at one or more tables, optionally filtered.

    Publishing the name again moves it in one step (ALS-03). Columns a table lacks are null.
    """
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if only is not None:
        united = united.where(only)
    united.createOrReplaceTempView(name)
    return united


def publish_days(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """A view over all day partitions under a declared schema; other fields stay out (ALS-04)."""
    return publish(name, spark.read.schema(schema).parquet(path).select(*schema.fieldNames()))
