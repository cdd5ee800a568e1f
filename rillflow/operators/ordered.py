"""Per-key ordered scans that survive a key holding a large share of all rows.

A plain window function gives a whole key to one task. Here the keys are counted first
(one pruned, partially aggregated pass). Cold keys use the plain window. Hot keys are
range-partitioned on (key, order), so
one key spreads over many slices of bounded size, and a small table with one row per
slice carries what a slice must know about the slices before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.session import checkpoint_root, hot_rows

HOT_ID, SLICE = "_hot_id", "_slice"


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is sum, max or min over ``value``."""

    kind: str
    value: Column

    def over(self, window) -> Column:
        return getattr(F, self.kind)(self.value).over(window)

    def total(self) -> Column:
        return getattr(F, self.kind)(self.value)

    def combine(self, carried: Column, own: Column) -> Column:
        if self.kind == "sum":
            both = carried + own
            return F.coalesce(both, carried, own)
        # greatest and least skip nulls
        return (F.greatest if self.kind == "max" else F.least)(carried, own)


@dataclass(frozen=True)
class OrderedKeys:
    """Rows split into cold keys and, when there are any, sliced hot keys."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    limit: int
    cold: DataFrame
    hot: DataFrame | None

    @staticmethod
    def of(df: DataFrame, keys: list[str], order: list[str], limit: int | None = None):
        """``order`` must be a total order within a key."""
        keys, order = tuple(keys), tuple(order)
        limit = limit or hot_rows(df.sparkSession)
        # At most total / limit keys can pass, whatever the size of the table.
        heavy = df.groupBy(*keys).count().where(F.col("count") > limit).collect()
        if not heavy:
            return OrderedKeys(keys, order, limit, df, None)

        spark = df.sparkSession
        schema = df.select(*keys).schema.add(HOT_ID, "integer")
        listed = spark.createDataFrame(
            [tuple(r[k] for k in keys) + (i,) for i, r in enumerate(heavy)], schema
        )
        renamed = listed.select(*[F.col(k).alias(f"_h_{k}") for k in keys], HOT_ID)
        same = reduce(
            Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
        )
        tagged = df.join(renamed, same, "left").drop(*[f"_h_{k}" for k in keys])
        slices = max(2, math.ceil(sum(r["count"] for r in heavy) / limit))
        checkpoint_root(spark)
        # The bounds of a range partitioning are sampled, so the slices are fixed by a
        # checkpoint before anything is computed from them.
        hot = (
            tagged.where(F.col(HOT_ID).isNotNull())
            .repartitionByRange(slices, HOT_ID, *order)
            .withColumn(SLICE, F.spark_partition_id())
            .checkpoint()
        )
        cold = tagged.where(F.col(HOT_ID).isNull()).drop(HOT_ID)
        return OrderedKeys(keys, order, limit, cold, hot)

    # -- scans ---------------------------------------------------------------

    def previous(self, **columns: str) -> OrderedKeys:
        """Add ``name=source``: the source's value in the row before, else null."""

        def add(df: DataFrame, window) -> DataFrame:
            lagged = {name: F.lag(source).over(window) for name, source in columns.items()}
            return df.withColumns(lagged)

        cold = add(self.cold, self._window(self.keys))
        if self.hot is None:
            return replace(self, cold=cold)
        last = F.max_by(F.struct(*set(columns.values())), F.struct(*self.order))
        tails = self.hot.groupBy(HOT_ID, SLICE).agg(last.alias("_tail"))
        before = F.lag("_tail").over(Window.partitionBy(HOT_ID).orderBy(SLICE))
        tails = tails.select(HOT_ID, SLICE, before.alias("_tail"))
        window = self._window((HOT_ID, SLICE))
        hot = add(self.hot.withColumn("_head", F.row_number().over(window) == 1), window)
        hot = self._carry(hot, tails).withColumns({
            name: F.when(F.col("_head"), F.col(f"_tail.{source}")).otherwise(F.col(name))
            for name, source in columns.items()
        })
        return replace(self, cold=cold, hot=hot.drop("_head", "_tail"))

    def running(self, before: bool = False, **columns: Running) -> OrderedKeys:
        """Add running aggregates up to the row, or up to the row before it."""
        end = -1 if before else Window.currentRow
        start = Window.unboundedPreceding

        def add(df: DataFrame, keys) -> DataFrame:
            window = self._window(keys).rowsBetween(start, end)
            return df.withColumns({n: r.over(window) for n, r in columns.items()})

        cold = add(self.cold, self.keys)
        if self.hot is None:
            return replace(self, cold=cold)
        totals = self.hot.groupBy(HOT_ID, SLICE).agg(
            *[r.total().alias(f"_t_{n}") for n, r in columns.items()]
        )
        earlier = Window.partitionBy(HOT_ID).orderBy(SLICE).rowsBetween(start, -1)
        totals = totals.select(
            HOT_ID, SLICE,
            *[getattr(F, r.kind)(f"_t_{n}").over(earlier).alias(f"_t_{n}")
              for n, r in columns.items()],
        )
        hot = self._carry(add(self.hot, (HOT_ID, SLICE)), totals).withColumns(
            {n: r.combine(F.col(f"_t_{n}"), F.col(n)) for n, r in columns.items()}
        )
        return replace(self, cold=cold, hot=hot.drop(*[f"_t_{n}" for n in columns]))

    def numbered(self, name: str = "rn") -> OrderedKeys:
        return self.running(**{name: Running("sum", F.lit(1).cast("bigint"))})

    def trailing(self, size: int, rn: str = "rn", **columns: Column) -> OrderedKeys:
        """Aggregates over the last ``size`` rows; needs the row number of `numbered`."""

        def add(df: DataFrame, keys) -> DataFrame:
            window = Window.partitionBy(*keys).orderBy(rn).rowsBetween(1 - size, 0)
            return df.withColumns({n: c.over(window) for n, c in columns.items()})

        cold = add(self.cold, self.keys)
        if self.hot is None:
            return replace(self, cold=cold)
        # Fixed blocks of rows; the last rows of a block also visit the next one.
        span = max(self.limit, size)
        block = F.floor((F.col(rn) - 1) / span)
        visits = F.when(
            (F.col(rn) - 1) % span >= span - (size - 1), F.array(block, block + 1)
        ).otherwise(F.array(block))
        spread = self.hot.withColumn("_own", block).withColumn("_block", F.explode(visits))
        hot = add(spread, (HOT_ID, "_block")).where(F.col("_own") == F.col("_block"))
        return replace(self, cold=cold, hot=hot.drop("_own", "_block"))

    def map(self, step: Callable[[DataFrame], DataFrame]) -> OrderedKeys:
        """Apply a row-local step to both halves."""
        return replace(
            self, cold=step(self.cold), hot=None if self.hot is None else step(self.hot)
        )

    def frame(self) -> DataFrame:
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(HOT_ID, SLICE))

    # -- helpers -------------------------------------------------------------

    def _window(self, keys):
        return Window.partitionBy(*keys).orderBy(*self.order)

    def _carry(self, hot: DataFrame, per_slice: DataFrame) -> DataFrame:
        # One row per (hot key, slice): bounded by slices + hot keys, never by the data.
        return hot.join(per_slice, [HOT_ID, SLICE], "left")
