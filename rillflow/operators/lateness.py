"""Replay of per-record watermarks and late-data triage (STR-03 .. STR-05).

Structured Streaming moves its watermark between micro-batches. These replays compute the
watermark each record met: a running maximum per source partition in arrival order.
Times are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.ordered import OrderedKeys, Running


def with_watermark_before(
    df: DataFrame, source: str, arrival: list[str], time: str, delay_ms: int,
    advances: Column | None = None, limit: int | None = None,
) -> DataFrame:
    """Add ``watermark``: the highest earlier time minus the delay, null before the first.

    With ``advances`` only the rows it holds for move the watermark (STR-04).
    """
    seen = F.col(time) if advances is None else F.when(advances, F.col(time))
    scanned = OrderedKeys.of(df, [source], arrival, limit)
    scanned = scanned.running(before=True, _seen=Running("max", seen))
    return scanned.frame().withColumn("watermark", F.col("_seen") - delay_ms).drop("_seen")


def flag_late(df: DataFrame, time: str) -> DataFrame:
    """A record at or below the watermark is late."""
    late = F.coalesce(F.col(time) <= F.col("watermark"), F.lit(False))
    return df.withColumn("is_late", late)


def triage(df: DataFrame, time: str, window_ms: int, allowed_ms: int) -> DataFrame:
    """Add the tumbling window's start and what happens to the row (STR-05).

    ``on_time``: its window has not fired; ``late``: fired, still updated within the
    allowance; ``too_late``: goes to the late table.
    """
    start = F.col(time) - F.pmod(F.col(time), F.lit(window_ms))
    last = start + window_ms - 1
    mark = F.col("watermark")
    fate = (
        F.when(mark.isNull() | (last > mark), "on_time")
        .when(last + allowed_ms > mark, "late")
        .otherwise("too_late")
    )
    return df.withColumns({"window_start": start, "fate": fate})
