"""Tables written to the shared folder and read again, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.session import scratch_path


def saved(
    spark: SparkSession, df: DataFrame, name: str, codec: str | None = None
) -> DataFrame:
    """The same table from files that survive the executors that made it."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
