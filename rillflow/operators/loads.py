"""Cells written as sorted files for range reads (SNK-13, DST-02).

A load is a folder of files in key order whose key ranges do not overlap. A range read leaves out
the files, and inside a file the row groups, that lie outside its range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.operators.keyrange import bucket_of
from rillflow.operators.widecolumn import CELL_KEY

CELLS = "row_key string, family string, qualifier string, ts bigint, value string"
# Row groups are what a range read can leave out inside a file.
GROUP_BYTES = 8 << 20


def write_load(
    cells: DataFrame, path: str, splits: list[str] | None = None, files: int | None = None,
    group_bytes: int = GROUP_BYTES,
) -> None:
    """Write cells in key order, newest version first (SNK-13).

    With ``splits`` every bucket has a folder of its own (DST-02). Without ``files`` their number
    follows the size. Ranges follow the data and take
    the versions of a cell in, so neither a crowded bucket nor a cell of many versions is one task.
    """
    order = [*CELL_KEY, F.col("ts").desc()]
    rows = cells.select(*CELL_KEY, "ts", "value")
    if splits is not None:
        rows = rows.withColumn("bucket", bucket_of(F.col("row_key"), splits))
        order = ["bucket", *order]
    count = [files] if files else []
    ordered = rows.repartitionByRange(*count, *order).sortWithinPartitions(*order)
    writer = ordered.write.option("parquet.block.size", group_bytes)
    if splits is not None:
        writer = writer.partitionBy("bucket")
    writer.parquet(path)


def read_load(spark: SparkSession, path: str, splits: list[str] | None = None) -> DataFrame:
    """All cells of a load, with their bucket if it has any."""
    return spark.read.schema(f"{CELLS}, bucket int" if splits is not None else CELLS).parquet(path)


def read_range(
    spark: SparkSession, path: str, start: str | None = None, stop: str | None = None,
    splits: list[str] | None = None,
) -> DataFrame:
    """Cells with a row key in [start, stop), compared by bytes; an end that is None is open.

    The load's split points leave out the folders of other buckets.
    """
    found = read_load(spark, path, splits)
    for end, inside in ((start, F.col("row_key") >= start), (stop, F.col("row_key") < stop)):
        if end is not None:
            found = found.where(inside)
    if splits is not None:
        points = [s.encode() for s in splits]
        if start is not None:
            found = found.where(F.col("bucket") >= sum(p <= start.encode() for p in points))
        if stop is not None:
            found = found.where(F.col("bucket") <= sum(p < stop.encode() for p in points))
    return found


def file_ranges(load: DataFrame) -> DataFrame:
    """A row per file: (file, low, high, cells) by row key, family, qualifier and age."""
    place = F.struct(*CELL_KEY, (-F.col("ts")).alias("age"))
    return load.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("cells")
    )


def overlapping_files(load: DataFrame) -> DataFrame:
    """Files that begin before the end of an earlier one; none in a load of distinct cells.

    Only ``file_ranges`` is put in order, which has a row per file.
    """
    before = Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    ends = file_ranges(load).withColumn("end", F.max("high").over(before))
    return ends.where(F.col("low") <= F.col("end")).drop("end")
