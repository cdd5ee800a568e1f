"""Streaming jobs (STR-01, STR-02, STR-06 .. STR-09 and the stream forms of other operators)."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rillflow.operators.aggregates import word_count
from rillflow.operators.windows import millis, window_counts, windowed
from rillflow.schemas import struct
from rillflow.sinks.keyed import KeyedTable

# Fixed value: the pace of the micro-batches.
EVERY = "5 seconds"

# State outside the heap, with batches that save their changes instead of the whole state.
# Keyed processors need it and buffers larger than the executors' memory want it; a query keeps
# the store it began with when it restarts.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# For state with a time to live: such a query always has a next batch by the clock, which would
# keep one that takes what is there and ends from ending.
EXPIRING = {**ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}

# State on the heap keeps the version before the last one as well, for a task that is repeated. Without
# it such a task reads that version from its files, and what has left the state leaves the heap at once.
LAST_VERSION = {"spark.sql.streaming.maxBatchesToRetainInMemory": "1"}


@contextmanager
def with_settings(spark: SparkSession, values: dict[str, str]):
    """Settings for what is planned or started inside; the session has its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def looked_up(table: DataFrame, key: str, partitions: int):
    """A table that every batch of a query looks up by a key, dealt out and sorted by it once.

    A stream plans each batch anew, by the size of files: packed columns look small enough there to be
    sent through the driver, batch after batch, and tables that are not sent are shuffled and sorted
    as often. This one is kept by the executors, in memory as far as it goes, else on their disks. It
    has its real size, and joins over as many partitions find it in its place.
    """
    dealt = table.repartition(partitions, key).sortWithinPartitions(key).persist()
    try:
        dealt.count()  # its size is known from here on
        yield dealt
    finally:
        dealt.unpersist()


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None,
    source: str = "parquet",
) -> DataFrame:
    """A folder (or glob) of files as a stream."""
    reader = spark.readStream.schema(schema).format(source)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start(
    df: DataFrame, checkpoint: str, path: str | None = None,
    write: Callable[[DataFrame, int], None] | None = None, mode: str = "append",
    every: str | None = EVERY, store: dict[str, str] | None = None,
    partitions: int | None = None, source: str = "parquet", name: str | None = None,
) -> StreamingQuery:
    """Start a query into files or a batch writer (STR-07, STR-08, STR-09).

    Progress is kept at ``checkpoint``: a restart goes on after the last finished batch. With
    ``every=None`` the query takes what is there and ends. ``store`` sets the state store and
    ``partitions`` the partitions of the state, which stay as they are for the query's life.
    ``source`` names the format of the files, ``name`` the query in reports.
    """
    settings = dict(store or {})
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    with with_settings(df.sparkSession, settings):
        if write is not None:
            return writer.foreachBatch(write).start()
        return writer.format(source).start(path)


def run(df: DataFrame, checkpoint: str, **options) -> None:
    """Process everything that is there, then stop."""
    start(df, checkpoint, every=None, **options).awaitTermination()


def bounded_lateness(df: DataFrame, time: str, seconds: int = 1) -> DataFrame:
    """Watermark for rows at most some seconds out of order; 0 for ascending times (STR-01, STR-02).

    Time columns without a zone become instants first, which streaming asks for. With several
    inputs the slowest one decides (STR-06), which is Spark's default policy.
    """
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, f"{seconds} seconds")


# Record of a running word count: one table, no days.
COUNTS = struct(word="string", cnt="bigint")


def counts_table(path: str) -> KeyedTable:
    return KeyedTable(path, ("word",), COUNTS, ("cnt",), day=None)


def running_word_count(
    lines: DataFrame, checkpoint: str, table: KeyedTable, every: str | None = EVERY,
    partitions: int | None = None,
) -> StreamingQuery:
    """Each batch upserts the words it changed (AGG-02)."""
    counted = word_count(lines, keep_empty=False)

    return start(
        counted, checkpoint, write=table.write_batch, mode="update", every=every, partitions=partitions
    )


def window_stream(
    readings: DataFrame, keys: list[str], time: str, size: int, slide: int | None = None,
    delay: int = 1,
) -> DataFrame:
    """Window counts, each sent once its window is closed by the watermark (WIN-01, WIN-02)."""
    return window_counts(bounded_lateness(readings, time, delay), keys, time, size, slide)


def reduced_window_stream(
    readings: DataFrame, keys: list[str], time: str, size: int, delay: int = 1
) -> DataFrame:
    """Latest time and lowest temperature per window (WIN-06)."""
    marked = bounded_lateness(readings, time, delay)
    reduced = windowed(marked, keys, time, size).agg(
        F.max("timestamp").alias("timestamp"), F.min("temperature").alias("temperature")
    )
    start_ms = millis(F.col("window.start")).alias("window_start")
    return reduced.select(*keys, start_ms, "timestamp", "temperature")


def session_stream(readings: DataFrame, keys: list[str], time: str, gap: int, delay: int = 1) -> DataFrame:
    """Sessions, each sent once closed (WIN-04)."""
    marked = bounded_lateness(readings, time, delay)
    counted = marked.groupBy(*keys, F.session_window(time, f"{gap} seconds").alias("s")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counted.select(
        *keys, millis(F.col("s.start")).alias("session_start"),
        millis(F.col("s.end")).alias("session_end"), "cnt",
    )


def first_in_day_stream(entries: DataFrame, time: str) -> DataFrame:
    """First entry per device and day, with state that expires after a day (STA-07, STA-09)."""
    marked = entries.withWatermark(time, "1 day")
    return marked.dropDuplicatesWithinWatermark(["dt", "mid"])


def branch_tables(split: Callable[[DataFrame], dict[str, DataFrame]], root: str):
    """A ``foreachBatch`` function writing tagged branches of one batch (FLT-14, FLT-15).

    The batch is read once; each branch replaces its own folder of the batch when repeated.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for tag, rows in split(batch).items():
                rows.write.mode("overwrite").parquet(f"{root}/{tag}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write
