"""Projection, filters, sorting and paging (PRJ, FLT-01 .. FLT-04, FLT-09 .. FLT-15, SRT)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import words
from rillflow.session import spread


def tokens_of(df: DataFrame, text: str = "value", keep_empty: bool = True) -> DataFrame:
    """One row per word (PRJ-05)."""
    return spread(df).select(F.explode(words(F.col(text), keep_empty)).alias("word"))


def split_by(df: DataFrame, **predicates: Column) -> dict[str, DataFrame]:
    """Tagged branches of one source (FLT-15); a row goes to every branch it fits."""
    return {tag: df.where(predicate) for tag, predicate in predicates.items()}


def tagged(df: DataFrame, **predicates: Column) -> DataFrame:
    """Each row once per tag it fits, in one pass over the source (FLT-15)."""
    tags = F.array_compact(F.array(*[F.when(p, F.lit(tag)) for tag, p in predicates.items()]))
    return df.withColumn("tag", F.explode(tags))


def threshold_split(df: DataFrame, value: str, limit: float) -> tuple[DataFrame, DataFrame]:
    """Above the limit as full rows, the rest as (id, temperature, timestamp) (FLT-14)."""
    high = df.where(F.col(value) > limit)
    rest = df.where(F.coalesce(F.col(value) <= limit, F.lit(True)))
    return high, rest.select("id", value, "timestamp")


def term(field: Column, value) -> Column:
    """Exact, whole-value match (FLT-09)."""
    return field == F.lit(value)


def nested_term(items: Column, field: str, value) -> Column:
    """Exact match on one element of an array of objects (FLT-09, SCH-04)."""
    return F.exists(items, lambda item: item[field] == F.lit(value))


def in_range(field: Column, gt=None, gte=None, lt=None, lte=None) -> Column:
    """Range filter with open or closed ends (FLT-11)."""
    bounds = []
    if gt is not None:
        bounds.append(field > gt)
    if gte is not None:
        bounds.append(field >= gte)
    if lt is not None:
        bounds.append(field < lt)
    if lte is not None:
        bounds.append(field <= lte)
    return reduce(Column.__and__, bounds, F.lit(True))


def page(df: DataFrame, order: list[Column], page_no: int = 1, page_size: int = 20) -> DataFrame:
    """One page of a total order (SRT-01, SRT-03); a top-k per task, no full sort."""
    start = (page_no - 1) * page_size
    return df.orderBy(*order).offset(start).limit(page_size)


def top_groups(groups: DataFrame, by: Column, key: str, size: int) -> DataFrame:
    """The first ``size`` groups, ties broken by key (SRT-04)."""
    return groups.orderBy(by.desc(), F.col(key).asc()).limit(size)
