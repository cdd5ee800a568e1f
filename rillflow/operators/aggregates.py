"""Counting, grouping and custom reductions (AGG-01 .. AGG-06, AGG-12 .. AGG-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.ordered import OrderedKeys
from rillflow.operators.relational import tokens_of, top_groups


def word_count(lines: DataFrame, text: str = "value", keep_empty: bool = True) -> DataFrame:
    """The batch form counts inner empty words, the stream form drops them (AGG-01/02)."""
    counted = tokens_of(lines, text, keep_empty).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("cnt"))


def group_count(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; a null key counts nothing (AGG-03)."""
    return df.groupBy(key).agg(F.count(key).alias("cnt"))


def retract_changelog(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Messages of a running count per key (AGG-04).

    The nth row of a key withdraws count n-1 (not for the first row) and adds count n, so
    n rows give 2n-1 messages. ``step`` numbers the messages of a key.
    """
    n = F.col("_n")
    add = F.struct(F.lit(True).alias("is_add"), n.alias("cnt"), (2 * n - 1).alias("step"))
    drop = F.struct(
        F.lit(False).alias("is_add"), (n - 1).alias("cnt"), (2 * n - 2).alias("step")
    )
    messages = F.when(n > 1, F.array(drop, add)).otherwise(F.array(add))
    numbered = OrderedKeys.of(df.select(key, *order), [key], order).numbered("_n").frame()
    return numbered.select(key, F.inline(messages))


def reduce_readings(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Latest time and lowest temperature of a group (AGG-05, WIN-06)."""
    return df.groupBy(*keys).agg(
        F.max("timestamp").alias("timestamp"), F.min("temperature").alias("temperature")
    )


def min_and_min_by(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """``min`` keeps the other fields of the first row, ``minBy`` the whole lowest row (AGG-06)."""
    arrival = F.struct(*order)
    others = [c for c in df.columns if c not in (key, value)]
    first = F.min_by(F.struct(*others), arrival)
    lowest = F.min_by(F.struct(*others), F.struct(F.col(value), arrival))
    grouped = df.groupBy(key).agg(
        F.min(value).alias(value), first.alias("_first"), lowest.alias("_lowest")
    )
    return grouped.select(
        key, value,
        *[F.col(f"_first.{c}").alias(f"min_{c}") for c in others],
        *[F.col(f"_lowest.{c}").alias(f"minby_{c}") for c in others],
    )


def exact_sum(amount: Column) -> Column:
    """A money sum that does not depend on the order of the rows."""
    return F.sum(amount.cast("decimal(18,2)")).cast("double")


def exact_avg(value: Column) -> Column:
    """A mean that does not depend on the order of the rows, of values with up to ten decimals."""
    return F.sum(value.cast("decimal(28,10)")).cast("double") / F.count(value)


def nested_groups(df: DataFrame, items: str, field: str) -> DataFrame:
    """One row per document and distinct element value."""
    values = F.array_distinct(F.col(f"{items}.{field}"))
    return df.withColumn("group_key", F.explode(values))


def terms_top(df: DataFrame, items: str, field: str, size: int) -> DataFrame:
    """Documents per element value, largest first (AGG-12)."""
    counted = nested_groups(df, items, field).groupBy("group_key")
    return top_groups(
        counted.agg(F.count(F.lit(1)).alias("doc_count")), F.col("doc_count"), "group_key", size
    )


def terms_by_avg(df: DataFrame, items: str, field: str, value: str, size: int) -> DataFrame:
    """Groups ordered by the average of a value (AGG-13)."""
    grouped = nested_groups(df, items, field).groupBy("group_key").agg(
        F.count(F.lit(1)).alias("doc_count"), exact_avg(F.col(value)).alias("avg_value")
    )
    return top_groups(grouped, F.col("avg_value"), "group_key", size)


def partition_counts(df: DataFrame, day: str = "dt") -> DataFrame:
    """Row count of every day table (AGG-15)."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("doc_count"))
