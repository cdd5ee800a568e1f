"""Dimension lookups and order joins (JON-01 .. JON-08).

No join carries a broadcast hint: dimensions grow with the business, so Catalyst decides
from the measured size and AQE splits skewed partitions of the larger side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import age_years
from rillflow.schemas import ORDER_WIDE_COLUMNS


def with_user(facts: DataFrame, users: DataFrame, as_of: Column, age_type: str = "int") -> DataFrame:
    """Gender and age of the fact's user; a missing user leaves nulls (JON-01)."""
    dim = users.select(
        F.col("id").alias("_user"), F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), as_of).cast(age_type).alias("user_age"),
    )
    key = F.col("user_id").cast(dim.schema["_user"].dataType)
    return facts.join(dim, key == F.col("_user"), "left").drop("_user")


def with_province(facts: DataFrame, provinces: DataFrame, code: str = "province_3166_2") -> DataFrame:
    """Name and codes of the fact's province (JON-02); ``code`` names the 3166-2 column."""
    dim = provinces.select(
        F.col("id").alias("_province"), F.col("name").alias("province_name"),
        F.col("iso_code").alias("province_iso_code"), F.col("iso_3166_2").alias(code),
        F.col("area_code").alias("province_area_code"),
    )
    key = F.col("province_id").cast(dim.schema["_province"].dataType)
    return facts.join(dim, key == F.col("_province"), "left").drop("_province")


def missing_dimensions(facts: DataFrame, *columns: str) -> DataFrame:
    """How many facts found no dimension row, per looked-up column."""
    return facts.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def marked(df: DataFrame, mark: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{mark}_{c}") for c in df.columns])


def on_side(pairs: DataFrame, mark: str, lookup: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Joined rows with a lookup made for the columns of one side; what it adds is marked as theirs."""
    others = [c for c in pairs.columns if not c.startswith(f"{mark}_")]
    bare = pairs.select(*others, *[
        F.col(c).alias(c.removeprefix(f"{mark}_")) for c in pairs.columns if c not in others
    ])
    found = lookup(bare)
    return found.select(*[
        F.col(c) if c in others else F.col(c).alias(f"{mark}_{c}") for c in found.columns
    ])


def wide_rows(infos: DataFrame, details: DataFrame) -> DataFrame:
    """Inner join of orders and details into wide rows (JON-04, JON-05)."""
    joined = marked(infos, "info").join(
        marked(details, "detail"), F.col("info_id") == F.col("detail_order_id"), "inner"
    )
    return assembled(joined)


def assembled(joined: DataFrame) -> DataFrame:
    """Wide rows from joined columns marked ``info_`` and ``detail_`` (JON-04).

    The detail is copied over the order, so ``create_time`` is the detail's while
    ``create_date`` and ``create_hour`` are the order's.
    """
    names = set(joined.columns)
    source = {
        target: next(c for c in (f"detail_{target}", f"info_{target}") if c in names)
        for target in ORDER_WIDE_COLUMNS if target != "detail_id"
    }
    source["detail_id"] = "detail_id"
    return joined.select(*[F.col(source[t]).alias(t) for t in ORDER_WIDE_COLUMNS])


def match_states(infos: DataFrame, details: DataFrame) -> DataFrame:
    """Every order and detail with whether the other side exists (JON-06).

    A full outer join cannot be split when one order holds many details, so it is built
    from a left join over the details and an anti join against their distinct order ids.
    """
    orders = infos.select(F.col("id").alias("order_id")).withColumn("_known", F.lit(True))
    lines = details.select(F.col("id").alias("detail_id"), F.col("order_id"))
    from_details = lines.join(orders, "order_id", "left").select(
        "order_id", "detail_id",
        F.when(F.col("_known"), "both").otherwise("detail_only").alias("match_state"),
    )
    ordered = lines.select("order_id").distinct()
    from_orders = orders.join(ordered, "order_id", "left_anti").select(
        "order_id", F.lit(None).cast(lines.schema["detail_id"].dataType).alias("detail_id"),
        F.lit("info_only").alias("match_state"),
    )
    return from_details.unionByName(from_orders)


def in_tables(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """Change events whose table is on a list that may change at any time (JON-07).

    The list is read when the plan runs, so in every micro-batch; Catalyst decides from its size
    whether the events must move.
    """
    listed = tables.select(F.col("table_name").alias("_listed")).distinct()
    return changes.join(listed, F.col("table") == F.col("_listed"), "left_semi")


def connected(first: DataFrame, second: DataFrame, mapped: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Two differently typed inputs mapped into one tagged stream (JON-08)."""
    one = first.select(F.lit(1).alias("source"), *[c[0].alias(n) for n, c in mapped.items()])
    two = second.select(F.lit(2).alias("source"), *[c[1].alias(n) for n, c in mapped.items()])
    return one.unionByName(two)
