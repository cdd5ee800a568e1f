"""Range buckets over row keys (DST-01, DST-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_keys(regions: int, radix: int, start: str, end: str) -> list[str]:
    """Split points for evenly cut numeric keys in base 10 or 16.

    The points are the multiples of ``range size / regions`` within the range, without the
    first one; the start is read in base 10, the end in the given base.
    """
    if radix not in (10, 16):
        raise ValueError("keys are in base 10 or 16")
    first, last = int(start), int(end, radix)
    step = (last - first + 1) // regions
    if step == 0:
        raise ValueError("fewer keys than regions")
    points = range(first + -first % step, last + 1, step)[1:]
    return [f"{p:x}" if radix == 16 else str(p) for p in points]


def bucket_of(key: Column, splits: list[str]) -> Column:
    """Number of split points at or below the key, compared by bytes.

    The split points are a constant of the job, one per region.
    """
    points = F.array(*[F.lit(s) for s in sorted(splits, key=str.encode)]).cast("array<string>")
    return F.size(F.filter(points, lambda point: point <= key))


def bucket_counts(df: DataFrame, key: str, splits: list[str]) -> DataFrame:
    """Rows per bucket (DST-01)."""
    return df.groupBy(bucket_of(F.col(key), splits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def bucketed(cells: DataFrame, splits: list[str]) -> DataFrame:
    """Cells tagged with their bucket, in key order and cut by key range (DST-02).

    Ranges follow the data, not the split points, so a crowded bucket becomes several files.
    """
    tagged = cells.withColumn("bucket", bucket_of(F.col("row_key"), splits))
    order = ["bucket", "row_key", "family", "qualifier"]
    return tagged.repartitionByRange(*order).sortWithinPartitions(*order)
