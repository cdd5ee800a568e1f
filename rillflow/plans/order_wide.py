"""Wide order rows (PIP-06): enrich orders, join their details, save by detail."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import day_from_text, hour_from_text
from rillflow.operators.joins import assembled, marked, on_side, wide_rows, with_province, with_user
from rillflow.sinks.keyed import KeyedTable


def enriched_orders(infos: DataFrame, users: DataFrame, provinces: DataFrame, as_of: Column) -> DataFrame:
    """Orders with user, province, date and hour (JON-01, JON-02, FUN-03)."""
    known = with_user(infos, users, as_of)
    placed = with_province(known, provinces, "province_3166_2_code")
    return placed.withColumns({
        "create_date": day_from_text(F.col("create_time")),
        "create_hour": hour_from_text(F.col("create_time")),
    })


def wide_orders(
    infos: DataFrame, details: DataFrame, users: DataFrame, provinces: DataFrame, as_of: Column
) -> DataFrame:
    """The batch form: every detail whose order is there."""
    return wide_rows(enriched_orders(infos, users, provinces, as_of), details)


def wide_order_stream(
    infos: DataFrame, details: DataFrame, info_time: str, detail_time: str, buffer: str = "24 hours",
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    describe: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The stream form (JON-03, STA-09): both sides wait up to ``buffer`` for the other.

    Each pair comes out once; rows older than the buffer leave the state by the watermark. What
    ``infos`` and ``details`` do not have yet, ``enrich`` and ``describe`` look up for the pairs: rows
    that find no other half are never looked up, and the state holds them as they came.
    """
    left = marked(infos, "info").withWatermark(f"info_{info_time}", buffer)
    right = marked(details, "detail").withWatermark(f"detail_{detail_time}", buffer)
    seen, sold = F.col(f"detail_{detail_time}"), F.col(f"info_{info_time}")
    wait = F.expr(f"INTERVAL {buffer}")
    near = (seen >= sold - wait) & (seen <= sold + wait)
    same = F.col("info_id") == F.col("detail_order_id")
    pairs = left.join(right, same & near, "inner")
    for mark, lookup in (("info", enrich), ("detail", describe)):
        pairs = on_side(pairs, mark, lookup) if lookup else pairs
    return assembled(pairs)


def match_state_stream(
    infos: DataFrame, details: DataFrame, info_time: str, detail_time: str, buffer: str = "24 hours",
    lateness: str = "1 hour",
) -> DataFrame:
    """Orders and details as a stream with whether the other side came in time (JON-06).

    A pair comes out when its second half arrives. What finds no other half within ``buffer`` comes
    out alone once the watermark, ``lateness`` behind the slower input, has passed that time; until
    then it waits in the state, and afterwards it leaves it.
    """
    left = infos.select(
        F.col("id").alias("info_id"), F.col(info_time).alias("info_at")
    ).withWatermark("info_at", lateness)
    right = details.select(
        F.col("id").alias("detail_id"), "order_id", F.col(detail_time).alias("detail_at")
    ).withWatermark("detail_at", lateness)
    wait = F.expr(f"INTERVAL {buffer}")
    near = F.col("detail_at").between(F.col("info_at") - wait, F.col("info_at") + wait)
    joined = left.join(right, (F.col("info_id") == F.col("order_id")) & near, "full_outer")
    return joined.select(
        F.coalesce("info_id", "order_id").alias("order_id"), "detail_id",
        F.when(F.col("detail_id").isNull(), "info_only").when(F.col("info_id").isNull(), "detail_only")
        .otherwise("both").alias("match_state"),
    )


def wide_table(path: str, wide: DataFrame) -> KeyedTable:
    """Where wide rows are saved: by detail, in the day of their order; a repeated pair changes nothing."""
    return KeyedTable(path, ("detail_id",), wide.schema, ("create_time",), day="create_date")
