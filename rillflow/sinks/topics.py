"""Messages for topics (SNK-02, SNK-04) and the console (SNK-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The producer settings of a safe write.
PRODUCER = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def messages(df: DataFrame, topic: str | Column, key: Column | None = None) -> DataFrame:
    """(topic, key, value) with the row as JSON; null fields are left out."""
    return df.select(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def csv_messages(df: DataFrame, topic: str) -> DataFrame:
    """(topic, key, value) with the row as a CSV line (SNK-04)."""
    return df.select(
        F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"),
        F.to_csv(F.struct(*df.columns)).alias("value"),
    )


def write_messages(df: DataFrame, target: str = "kafka", path: str | None = None, **options: str) -> None:
    """Batch write; a file target is laid out by topic."""
    if target == "kafka":
        df.write.format("kafka").options(**PRODUCER, **options).save()
    else:
        df.write.format(target).options(**options).partitionBy("topic").mode("append").save(path)


def stream_messages(
    df: DataFrame, checkpoint: str, target: str = "kafka", path: str | None = None,
    every: str | None = "5 seconds", **options: str,
) -> StreamingQuery:
    """Streaming write. Append mode: Spark refuses a plan that would take rows back."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if target == "kafka":
        return writer.format("kafka").options(**PRODUCER, **options).start()
    return writer.format(target).options(**options).partitionBy("topic").start(path)


def to_console(df: DataFrame, tag: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Print under a tag (SNK-01)."""
    if not df.isStreaming:
        print(tag)
        df.show(truncate=False)
        return None
    writer = df.writeStream.format("console").queryName(tag).outputMode("append")
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
