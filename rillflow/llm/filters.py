"""Bitmaps of fixed size that say which keys cannot be in a table."""

from __future__ import annotations

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap that is a table: at most a million rows of two numbers.
SLOT_BITS = 1 << 26


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap in which every key (the only column, a bigint) has its bit.

    Its size does not depend on the table. The larger the table, the more other keys pass, so what
    passes is always joined with the table afterwards.
    """
    bit = F.pmod(F.col(keys.columns[0]), F.lit(bits))
    words = keys.select(
        F.floor(bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("bit")
    )
    # At most bits / 64 rows come to the driver.
    rows = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = rows.toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def passing(filter_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (unsigned) can be in the table."""
    at = keys & np.uint64(64 * len(filter_words) - 1)
    word = filter_words[(at >> np.uint64(6)).astype(np.int64)]
    return ((word >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def row_slot(*columns: str) -> Column:
    """A key for rows named by some columns."""
    return F.xxhash64(*columns)


def slots(keys: DataFrame) -> DataFrame:
    """A bitmap with a bit for every key (the only column) as a table of its words: (word, bits).

    It has a row for each word that is not zero, so no more rows than keys, and ``SLOT_BITS / 64``
    at most; ``maybe`` sends it to every executor.
    """
    slot = F.pmod(F.xxhash64(keys.columns[0]), F.lit(SLOT_BITS))
    placed = keys.select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
    return placed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def maybe(df: DataFrame, key: Column, words: DataFrame, flag: str) -> DataFrame:
    """The rows with a column ``flag``: whether the key can be among those of the bitmap.

    The key must have the type of the bitmap's keys. What can be is left for a join to decide.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOT_BITS))
    held = words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    bit = F.expr(f"getbit(_bits, CAST({flag} % 64 AS INT))") == 1
    return (
        df.withColumn(flag, slot)
        .join(F.broadcast(held), F.shiftright(flag, 6) == F.col("_word"), "left")
        .withColumn(flag, F.coalesce(bit, F.lit(False))).drop("_word", "_bits")
    )


def possible(df: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """The rows whose key can be among those of the bitmap, so that few others are shuffled for a join."""
    return maybe(df, F.col(key), words, "_maybe").where("_maybe").drop("_maybe")


def without(df: DataFrame, key: str, gone: DataFrame, words: DataFrame) -> DataFrame:
    """The rows whose key (a bigint) is not in ``gone``; only rows that can be there are shuffled."""
    asked = maybe(df, F.col(key).cast("bigint"), words, "_maybe")
    certain = asked.where("NOT _maybe").drop("_maybe")
    return certain.unionByName(asked.where("_maybe").drop("_maybe").join(gone, key, "left_anti"))
