"""Topics of text messages (SRC-05 .. SRC-07, PIP-07).

The broker connector is not part of Spark itself, so the format is a parameter: ``kafka`` in
production, a folder of files with the same columns elsewhere.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from rillflow.functions import compute_once
from rillflow.schemas import texts
from rillflow.sources.files import parse_lines

MESSAGE = texts("topic key value")


def broker_options(
    servers: str, topic: str, offsets: dict[int, int] | None = None, group: str | None = None
) -> dict[str, str]:
    """Options of a topic reader: saved offsets if there are any, else the newest (SRC-06).

    They matter on the first start only; afterwards the checkpoint knows where to go on.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    options["startingOffsets"] = (
        json.dumps({topic: {str(p): o for p, o in offsets.items()}}) if offsets else "latest"
    )
    if group:
        options["groupIdPrefix"] = group
    return options


def read_topic(
    spark: SparkSession, options: dict[str, str], source: str = "kafka",
    schema: StructType | None = None, path: str | None = None,
) -> DataFrame:
    """A stream of (topic, key, value) texts (SRC-05)."""
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    messages = reader.load(path) if path else reader.load()
    return messages.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def csv_topic(
    messages: DataFrame, schema: StructType, name: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Records of a topic in CSV form and its other messages (SRC-07).

    The records are optionally registered by name.
    """
    records, rejects = parse_lines(messages, schema)
    if name:
        records.createOrReplaceTempView(name)
    return records, rejects


def decode(
    messages: DataFrame, schema: StructType, zero_numbers: bool = False
) -> tuple[DataFrame, DataFrame]:
    """JSON messages as typed records, and the messages that are none (PIP-07).

    Numbers are read as text and cast, so quoted numbers are numbers too; other text in their
    place is null. With ``zero_numbers`` an absent number is 0. A message that is null or not a
    JSON object is rejected as it came.
    """
    numeric = (LongType, DoubleType)
    as_text = StructType.fromDDL(
        ", ".join(
            f"`{f.name}` " + ("string" if isinstance(f.dataType, numeric) else f.dataType.simpleString())
            for f in schema.fields
        )
    )
    # The parser turns broken text into a record of nulls, so what it could not read is kept.
    unread = "_unread"
    parser = StructType([*as_text.fields]).add(unread, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": unread}
    parsed = compute_once(messages, "r", F.from_json("value", parser, options))
    good = F.col("value").isNotNull() & F.col("r").isNotNull() & F.col(f"r.{unread}").isNull()
    good &= F.ltrim("value").startswith("{")
    rejects = parsed.where(~F.coalesce(good, F.lit(False))).select(*messages.columns)
    columns = []
    for f in schema.fields:
        column = F.col(f"r.{f.name}").try_cast(f.dataType)
        if zero_numbers and isinstance(f.dataType, numeric):
            column = F.coalesce(column, F.lit(0).cast(f.dataType))
        columns.append(column.alias(f.name))
    return parsed.where(good).select(*columns), rejects
