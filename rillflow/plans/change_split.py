"""Split of database change events into fact topics and dimension rows (PIP-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions import compute_once, op_code
from rillflow.operators.joins import in_tables
from rillflow.schemas import CHANGE
from rillflow.sinks.keyed import KeyedTable
from rillflow.sinks.topics import write_messages

SUFFIX = "_1018"


def parsed(lines: DataFrame, text: str = "value", *carried: str) -> DataFrame:
    """(op, table, data) of the events with a wanted operation, plus carried columns."""
    events = compute_once(lines.select(text, *carried), "e", F.from_json(F.col(text), CHANGE))
    return events.select(
        op_code(F.col("e.type")).alias("op"), F.col("e.table").alias("table"),
        F.col("e.data").alias("data"), *carried,
    ).where(F.col("op").isNotNull())


def facts(changes: DataFrame, tables: DataFrame, suffix: str = SUFFIX) -> DataFrame:
    """Fact rows with their topic ``DWD_<TABLE>_<op>``."""
    topic = F.concat(F.lit("DWD_"), F.upper("table"), F.lit("_"), F.col("op"), F.lit(suffix))
    return in_tables(changes, tables).select(topic.alias("topic"), F.col("data").alias("value"))


def dimensions(changes: DataFrame, tables: DataFrame, *carried: str) -> DataFrame:
    """Dimension rows keyed ``<TABLE>:<id>``; a delete event still writes its row."""
    return in_tables(changes, tables).select(
        F.concat(F.upper("table"), F.lit(":"), F.get_json_object("data", "$.id")).alias("dim_key"),
        F.upper("table").alias("table_name"),
        F.get_json_object("data", "$.id").alias("id"), F.col("data").alias("value"), *carried,
    )


def batch_writer(
    fact_list: str, dim_list: str, topics_path: str, dims: KeyedTable, order: str,
    target: str = "parquet",
):
    """A ``foreachBatch`` function; the table lists are read anew in every batch (JON-07)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changes = parsed(batch, "value", order).persist()
        try:
            rows = facts(changes, spark.read.json(fact_list, "table_name string"))
            if target == "kafka":
                write_messages(rows.withColumn("key", F.lit(None).cast("string")))
            else:
                # Laid out by batch, so a repeated batch replaces its own files.
                path = f"{topics_path}/batch_id={batch_id}"
                rows.write.mode("overwrite").partitionBy("topic").format(target).save(path)
            wanted = dimensions(changes, spark.read.json(dim_list, "table_name string"), order)
            dims.write_batch(wanted, batch_id)
        finally:
            changes.unpersist()

    return write
