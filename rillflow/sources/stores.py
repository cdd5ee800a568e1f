"""JDBC tables, hash entries and day tables (SRC-09, SRC-12, SRC-13)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None,
    parts: int = 1, **more: str,
) -> dict[str, str]:
    """Reader options; with a numeric column and its bounds the read runs in parallel ranges."""
    options = {"url": url, "dbtable": table, **more}
    if column and bounds:
        options |= {
            "partitionColumn": column, "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]), "numPartitions": str(parts),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Column selection and filters on the result are pushed to the database (SRC-09)."""
    return spark.read.format("jdbc").options(**options).load()


def task_info(tasks: DataFrame) -> DataFrame:
    """The task projection with the lengths of its text columns (SRC-09, FUN-13)."""
    return tasks.select(
        "app_code", "task_code", "task_cells", "task_labels", "task_state",
        F.length("task_cells").alias("cells_length"),
        F.length("task_labels").alias("labels_length"),
    )


def hash_entries(entries: DataFrame) -> DataFrame:
    """Hash entries as ``key-value`` texts; one scan, no lookup per key (SRC-12)."""
    return entries.select(F.concat(F.col("key"), F.lit("-"), F.col("value")).alias("entry"))


def day_field(
    spark: SparkSession, path: str, day: str, field: str, kind: str = "string"
) -> DataFrame:
    """One column of a day's table, empty when the day or table is missing (SRC-13).

    ``kind`` is the type of the field, for a table that is not there yet.
    """
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"`{field}` {kind}")
    return table.where(F.col("dt") == day).select(field)
