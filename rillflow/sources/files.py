"""In-memory rows, text lines and delimited records (SRC-01 .. SRC-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD = "_bad"


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """A small collection under an explicit schema (SRC-01)."""
    return spark.createDataFrame(rows, schema)


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One row per line (SRC-02)."""
    return (spark.readStream if streaming else spark.read).text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, for interactive use (SRC-08)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_lines(
    lines: DataFrame, schema: StructType, text: str = "value", separator: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Typed records and the lines that are none (SRC-03).

    A blank line, one with too few fields or with a field of the wrong type goes to the rejects whole.
    """
    marked = StructType([*schema.fields, StructField(BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "sep": separator}
    parsed = lines.select(
        F.col(text), F.from_csv(F.col(text), marked.toDDL(), options).alias("r")
    )
    blank = F.coalesce(F.length(F.trim(F.col(text))), F.lit(0)) == 0
    bad = blank | F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    records = parsed.where(~bad).select(*[F.col(f"r.{f.name}") for f in schema.fields])
    return records, parsed.where(bad).select(F.col(text).alias("line"))


def csv_table(
    spark: SparkSession, path: str, schema: StructType, name: str | None = None
) -> DataFrame:
    """A CSV file with a declared schema, optionally registered by name (SRC-04)."""
    table = spark.read.schema(schema).csv(path)
    if name:
        table.createOrReplaceTempView(name)
    return table
