"""CSV tables and partitioned file ingest (SNK-03, SNK-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def insert_by_position(df: DataFrame, schema: StructType, path: str) -> None:
    """Write CSV under a declared schema; columns bind by position, not by name (SNK-03)."""
    if len(df.columns) != len(schema.fields):
        raise ValueError("the row and the table differ in their number of columns")
    bound = [
        F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)
    ]
    df.select(*bound).write.mode("append").csv(path)


def ingest_files(spark: SparkSession, source: str, target: str, day: str, hour: str) -> None:
    """Copy text files into a day and hour partition (SNK-14); the source stays.

    Files lie beside those that came earlier; only a file of the same name is replaced.
    """
    lines = spark.read.text(source).select(
        "value", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file_name"),
        F.lit(day).alias("clndr_dt_id"), F.lit(hour).alias("hour_id"),
    )
    (
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("clndr_dt_id", "hour_id", "file_name").parquet(target)
    )
