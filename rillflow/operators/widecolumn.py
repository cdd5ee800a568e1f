"""Wide-column rows kept as a long cell table (SRC-10/11, FLT-04 .. FLT-08, SNK-11 .. 13, MUT-08 .. 11).

A cell is (row_key, family, qualifier, ts, value). Older versions stay in the table; readers
take the newest one.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import reversed_key, salted_key

CELL_KEY = ["row_key", "family", "qualifier"]


def to_cells(
    df: DataFrame, key: str, family: str, ts: Column | int = 0, reverse: bool = False
) -> DataFrame:
    """One cell per non-null column (SNK-11 with ``reverse``, SNK-12 without, MUT-08)."""
    row_key = F.col(key).cast("string")
    columns = [c for c in df.columns if c != key]
    texts = df.select(
        (reversed_key(row_key) if reverse else row_key).alias("row_key"),
        (ts if isinstance(ts, Column) else F.lit(ts)).cast("bigint").alias("ts"),
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    cells = texts.unpivot(["row_key", "ts"], columns, "qualifier", "value")
    return cells.where(F.col("value").isNotNull()).select(
        "row_key", F.lit(family).alias("family"), "qualifier", "ts", "value"
    )


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell."""
    newest = cells.groupBy(*CELL_KEY).agg(F.max(F.struct("ts", "value")).alias("_newest"))
    return newest.select(*CELL_KEY, "_newest.ts", "_newest.value")


def versions(
    cells: DataFrame, family: str | None = None, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """All versions of the cells of a family and of a row-key range [start, stop)."""
    if family is not None:
        cells = cells.where(F.col("family") == family)
    if start is not None:
        cells = cells.where(F.col("row_key") >= start)
    if stop is not None:
        cells = cells.where(F.col("row_key") < stop)
    return cells


def scan(
    cells: DataFrame, family: str | None = None, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """Newest cells of a family and of a row-key range [start, stop) (SRC-10)."""
    return latest(versions(cells, family, start, stop))


def to_rows(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """Cells or versions of one family as wide rows of the named columns (SRC-10).

    The newest version counts; one aggregation makes the rows.
    """
    newest = [
        F.max(F.when(F.col("qualifier") == q, F.struct("ts", "value"))).alias(q) for q in qualifiers
    ]
    wide = cells.groupBy("row_key").agg(*newest)
    return wide.select("row_key", *[F.col(f"`{q}`.value").alias(q) for q in qualifiers])


def row_texts(cells: DataFrame, qualifiers: list[str] | None = None) -> DataFrame:
    """(row_key, newest values joined by ``_`` in qualifier order) (SRC-11).

    Rows are brought together once: the newest version of a cell and the text of a row are both
    taken where the row lies. The number of qualifiers does not matter.
    """
    if qualifiers is not None:
        cells = cells.where(F.col("qualifier").isin(qualifiers))
    newest = (
        cells.repartition("row_key").groupBy("row_key", "qualifier")
        .agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    )
    row = newest.groupBy("row_key").agg(F.collect_list(F.struct("qualifier", "value")).alias("_row"))
    values = F.transform(F.array_sort("_row"), lambda cell: cell["value"])
    return row.select("row_key", F.array_join(values, "_").alias("row_text"))


def key_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """Pushed down to the files (FLT-04)."""
    return cells.where(F.col("row_key").startswith(prefix))


def key_pattern(cells: DataFrame, pattern: str) -> DataFrame:
    """Row keys holding a match of the pattern (FLT-05)."""
    return cells.where(F.col("row_key").rlike(pattern))


# The comparisons of a column value filter.
COMPARISONS = {
    "<": operator.lt, "<=": operator.le, "=": operator.eq,
    "<>": operator.ne, ">=": operator.ge, ">": operator.gt,
}


def column_value(
    cells: DataFrame, family: str, qualifier: str, comparison: str, value: str,
    keep_missing: bool = True,
) -> DataFrame:
    """Cells of the rows whose column compares with a value (FLT-06).

    Rows without the column pass unless ``keep_missing`` is off.
    """
    column = cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
    passes = COMPARISONS[comparison](F.col("value"), F.lit(value))
    column = latest(column)
    if keep_missing:
        return cells.join(column.where(~passes).select("row_key"), "row_key", "left_anti")
    return cells.join(column.where(passes).select("row_key"), "row_key", "left_semi")


def column_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells whose qualifier starts with the prefix (FLT-07)."""
    return cells.where(F.col("qualifier").startswith(prefix))


def row_and_column(
    cells: DataFrame, family: str, qualifier: str, comparison: str, value: str, prefix: str
) -> DataFrame:
    """Rows by column value, then their cells by qualifier prefix (FLT-08)."""
    rows = column_value(cells, family, qualifier, comparison, value, keep_missing=False)
    return column_prefix(rows, prefix)


def sorted_load(
    df: DataFrame, key: str, family: str, ts: Column | int = 0
) -> DataFrame:
    """Cells under salted keys, range-partitioned and sorted for a bulk load (SNK-13).

    Partitions do not overlap; inside a row the qualifiers are in order. Their number follows
    the session and the size of the data.
    """
    cells = to_cells(df.withColumn(key, salted_key(F.col(key).cast("string"))), key, family, ts)
    ranged = cells.repartitionByRange("row_key", "family", "qualifier")
    return ranged.sortWithinPartitions("row_key", "family", "qualifier")


def put_cells(cells: DataFrame, batch: DataFrame) -> DataFrame:
    """Add cells as new versions (MUT-08, MUT-09); the newest ``ts`` wins when read."""
    return cells.unionByName(batch)


def delete_cells(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Delete whole rows, families or columns: every cell key column in ``targets`` counts (MUT-10)."""
    keys = [c for c in CELL_KEY if c in targets.columns]
    return cells.join(targets.select(*keys).distinct(), keys, "left_anti")


def delete_newest(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Delete only the newest version of the named columns, uncovering the one before (MUT-10)."""
    named = cells.join(targets.select(*CELL_KEY).distinct(), CELL_KEY, "left_semi")
    newest = named.groupBy(*CELL_KEY).agg(F.max("ts").alias("ts"))
    return cells.join(newest, [*CELL_KEY, "ts"], "left_anti")


def drop_family(cells: DataFrame, family: str) -> DataFrame:
    """Remove a family from all rows (MUT-11)."""
    return cells.where(F.col("family") != family)
