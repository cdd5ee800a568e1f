"""Batch mutations of a document table: (table, batch) -> new table (MUT-01 .. MUT-07).

A batch may repeat a key; its last write wins. ``order`` names the columns that say which is last.
Without them it is the row that stands last in the batch, as the batch is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUT, PATCH, DELETE = "put", "patch", "delete"
_AT = "_order"


def last_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last write of every key; combined before the shuffle, one row kept per key."""
    rest = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return batch.groupBy(*keys).agg(last.alias("_last")).select(
        *[F.col("_last")[c].alias(c) if c in rest else F.col(c) for c in batch.columns]
    )


def _ordered(batch: DataFrame, order: list[str] | None) -> DataFrame:
    """The batch with one column to order it by."""
    at = F.struct(*order) if order else F.monotonically_increasing_id()
    return batch.withColumn(_AT, at)


def put(
    table: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Whole replacement by key (MUT-01, MUT-06)."""
    last = last_per_key(_ordered(batch, order), keys, [_AT]).select(*table.columns)
    return table.join(last.select(*keys), keys, "left_anti").unionByName(last)


def _last_values(columns: list[str], changed: list[str]) -> list[Column]:
    """Of every column its last value that is not null; an unchanged one has none."""
    return [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_AT))).alias(f"_new_{c}")
        for c in columns if c in changed
    ]


def patch(
    table: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Partial update: the batch's last non-null value of a column replaces the old one (MUT-02)."""
    changed = [c for c in batch.columns if c not in keys and c in table.columns]
    new = _ordered(batch, order).groupBy(*keys).agg(*_last_values(table.columns, changed))
    joined = table.join(new, keys, "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c)
        for c in table.columns
    ])


def apply_log(
    table: DataFrame, log: DataFrame, keys: list[str], order: list[str], kind: str = "op"
) -> DataFrame:
    """The table after an ordered log of puts, patches and deletes (MUT-01, MUT-02, MUT-04, MUT-06).

    ``kind`` names the column of the log that holds ``put``, ``patch`` or ``delete``. A put replaces
    the whole row, a patch its columns that are not null, a delete the row; a patch of a row that
    is not there changes nothing. Of mutations at the same place in the order a delete counts last
    and a patch before a put. The rows of the table come before the log. Table and log meet in one
    aggregation by key, which combines before the shuffle, so a key may have any number of entries.
    """
    values = [c for c in table.columns if c not in keys]
    rank = F.when(F.col(kind) == DELETE, 2).when(F.col(kind) == PUT, 1).otherwise(0)
    place = F.struct(*[F.col(c) for c in order], rank.alias("_rank"))
    there = [F.col(c) if c in log.columns else F.lit(None).alias(c) for c in values]
    entries = log.where(F.col(kind).isin(PUT, PATCH, DELETE)).select(
        *keys, F.col(kind).alias("_kind"), place.alias(_AT), *there
    )
    before = F.lit(None).cast(entries.schema[_AT].dataType)
    begin = table.select(*keys, F.lit(PUT).alias("_kind"), before.alias(_AT), *values)
    whole = F.when(F.col("_kind") != PATCH, F.struct(
        F.coalesce(F.col(_AT).isNotNull(), F.lit(False)).alias("logged"), F.col(_AT).alias("at"),
    ))
    row = F.struct(F.col("_kind").alias("kind"), F.col(_AT).alias("at"), *values)
    patched = [
        F.max_by(
            F.struct(F.col(_AT).alias("at"), F.col(c).alias("value")),
            F.when((F.col("_kind") == PATCH) & F.col(c).isNotNull(), F.col(_AT)),
        ).alias(f"_new_{c}")
        for c in values
    ]
    found = begin.unionByName(entries).groupBy(*keys).agg(F.max_by(row, whole).alias("_row"), *patched)

    def value(name: str) -> Column:
        new, old = F.col(f"_new_{name}"), F.col("_row")
        later = new.isNotNull() & (old["at"].isNull() | (new["at"] > old["at"]))
        return F.when(later, new["value"]).otherwise(old[name]).alias(name)

    return found.where(F.col("_row.kind") == PUT).select(
        *[F.col(c) if c in keys else value(c) for c in table.columns]
    )


def update_where(table: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Set columns of the rows the condition holds for (MUT-03)."""
    return table.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()
    })


def with_first_item(items: Column, field: str, value) -> Column:
    """The array with one field of its first element replaced (MUT-03)."""
    return F.transform(
        items, lambda item, i: F.when(i == 0, item.withField(field, F.lit(value))).otherwise(item)
    )


def delete_by_key(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop the rows named by a key table, which may repeat itself (MUT-04)."""
    return table.join(keys.distinct(), keys.columns, "left_anti")


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows the condition holds for; an unknown condition keeps the row (MUT-05)."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def get_by_key(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows named by a key table, which may repeat itself (MUT-07)."""
    return table.join(keys.distinct(), keys.columns, "left_semi")
