"""Keyed writes into day tables (SNK-06, SNK-07, SNK-09, SNK-10, STA-08, SNK-15).

A table is a folder of parquet files laid out as ``dt=<day>/batch_id=<n>``. A batch writes only
its own folders, so it costs the size of the batch, not of the table, and writing it again after
a failure replaces the same folders: replay changes nothing. Readers take the last row of a key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.operators.mutate import last_per_key
from rillflow.schemas import struct

BATCH = "batch_id"


@dataclass(frozen=True)
class KeyedTable:
    """``order`` says which of several rows of one key in a batch is the last.

    Without a ``day`` the table is laid out by batch only.
    """

    path: str
    keys: tuple[str, ...]
    schema: StructType
    order: tuple[str, ...]
    day: str | None = "dt"

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = last_per_key(batch.select(*self.schema.fieldNames()), self._key, list(self.order))
        tagged = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        (
            self._arranged(tagged)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self._folders).parquet(self.path)
        )

    @property
    def _key(self) -> list[str]:
        return [*([self.day] if self.day else []), *(k for k in self.keys if k != self.day)]

    @property
    def _folders(self) -> list[str]:
        return [*([self.day] if self.day else []), BATCH]

    def _arranged(self, rows: DataFrame) -> DataFrame:
        """Few files for quiet days, many for a crowded one.

        AQE cuts by size. Inside a stateful streaming query it is off, and the rows are spread by
        their whole key over the partitions of the session.
        """
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return rows.hint("rebalance", *([self.day] if self.day else []))
        return rows.repartition(*self._key)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All written rows, with their batch; empty before the first write."""
        schema = StructType([*self.schema.fields]).add(BATCH, "long")
        try:
            return spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, days: list[str] | None = None) -> DataFrame:
        """The current row of every key; a list of days prunes the folders read."""
        found = self.versions(spark)
        if days is not None:
            found = found.where(F.col(self.day).isin(days))
        return last_per_key(found, self._key, [BATCH]).select(*self.schema.fieldNames())

    def unseen(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        """Rows whose key the table does not have yet: the table is the state (STA-07, STA-08).

        The days of the batch are joined, so that they prune the folders read.
        """
        seen = self.versions(batch.sparkSession)
        if self.day:
            seen = seen.join(batch.select(self.day).distinct(), self.day, "left_semi")
        return batch.join(seen.select(*keys).distinct(), keys, "left_anti")

    def compact(self, spark: SparkSession, target: str, files: int | None = None) -> KeyedTable:
        """Rewrite the current rows as a new table (SNK-15); readers switch over.

        Each day gets ``files`` files, or as many as its size asks for.
        """
        rows = self.read(spark).withColumn(BATCH, F.lit(0).cast("bigint"))
        if files:
            part = F.pmod(F.xxhash64(*self.keys), F.lit(files))
            arranged = rows.repartition(*([F.col(self.day)] if self.day else []), part)
        else:
            arranged = self._arranged(rows)
        arranged.write.mode("overwrite").partitionBy(*self._folders).parquet(target)
        return KeyedTable(target, self.keys, self.schema, self.order, self.day)


def append_rows(df: DataFrame, path: str) -> None:
    """Append without a key of its own: duplicates are allowed (SNK-07)."""
    df.withColumn("_id", F.uuid()).write.mode("append").parquet(path)


def renamed_strings(df: DataFrame, **columns: str) -> DataFrame:
    """``name=source`` columns as texts, the shape of a document sink (SNK-08)."""
    return df.select(*[F.col(source).cast("string").alias(name) for name, source in columns.items()])


def pairs_from_entries(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """(key, value) of ``key-value`` texts; parts after the second are lost (SNK-09)."""
    parts = F.split(F.col(entry), "-")
    return entries.select(F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("value"))


HASH = struct(table_name="string", key="string", value="string", seq="bigint")


def hash_table(path: str) -> KeyedTable:
    """Hashes by name: ``table_name`` plays the part of the day (SNK-09)."""
    return KeyedTable(path, ("key",), HASH, ("seq",), day="table_name")


def hash_rows(df: DataFrame, table: str, key: str, value: str, seq: str) -> DataFrame:
    """Rows of a hash upsert ``table key value``; the highest ``seq`` of a key wins."""
    return df.select(
        F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"), F.col(seq).cast("bigint").alias("seq"),
    )
