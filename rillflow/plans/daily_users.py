"""Daily active users: first entry of a device per day, enriched (PIP-05, STA-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import copy_fields, day_of_millis, hour_of_millis
from rillflow.operators.joins import with_province, with_user
from rillflow.operators.mutate import last_per_key
from rillflow.schemas import DAU_INFO
from rillflow.sinks.keyed import KeyedTable


def entries(pages: DataFrame) -> DataFrame:
    """Page views that entered from outside, with their day (FLT-03).

    Only a missing ``last_page_id`` counts, an empty one does not. A page view without a device or
    a time is nobody's entry.
    """
    known = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    return pages.where(F.col("last_page_id").isNull() & known).withColumn("dt", day_of_millis(F.col("ts")))


def first_per_day(found: DataFrame, tie: str | None = None) -> DataFrame:
    """The earliest entry of a device and day; combined before the shuffle."""
    rank = F.struct(-F.col("ts"), *([-F.col(tie)] if tie else []))
    ranked = found.withColumn("_rank", rank)
    return last_per_key(ranked, ["dt", "mid"], ["_rank"]).drop("_rank")


def enriched(first: DataFrame, users: DataFrame, provinces: DataFrame, as_of: Column) -> DataFrame:
    """The record of a daily active user; dimensions that are missing stay null."""
    known = with_user(first, users, as_of, age_type="string")
    placed = with_province(known, provinces, "province_3166_2")
    placed = placed.withColumn("hr", hour_of_millis(F.col("ts")))
    row = placed.select(F.struct(*placed.columns).alias("row"))
    return copy_fields(row, DAU_INFO.fieldNames(), "row")


def daily_users(
    pages: DataFrame, users: DataFrame, provinces: DataFrame, as_of: Column, tie: str | None = None
) -> DataFrame:
    return enriched(first_per_day(entries(pages), tie), users, provinces, as_of)


def batch_writer(table: KeyedTable, users: DataFrame, provinces: DataFrame, as_of: Column):
    """A ``foreachBatch`` function whose dedupe state is the written table itself (STA-08).

    A restart needs no rebuilt state: what the table holds has been seen.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        first = first_per_day(entries(batch)).persist()
        try:
            new = table.unseen(first, ["dt", "mid"])
            table.write_batch(enriched(new, users, provinces, as_of), batch_id)
        finally:
            first.unpersist()

    return write
