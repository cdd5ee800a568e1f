"""Scalar functions (FUN-01 .. FUN-15) and bean-style copying (PRJ-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_at(text: Column, separator: str, index: int) -> Column:
    """The part at a zero-based index, null when there are fewer parts."""
    return F.get(F.split(text, _quoted(separator)), F.lit(index))


def _quoted(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def day_of_millis(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def hour_of_millis(millis: Column) -> Column:
    """Two-digit hour in the session's zone."""
    return F.date_format(F.timestamp_millis(millis), "HH")


def day_from_text(time: Column) -> Column:
    """The day of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return split_at(time, " ", 0)


def hour_from_text(time: Column) -> Column:
    return split_at(split_at(time, " ", 1), ":", 0)


def age_years(birthday: Column, as_of: Column) -> Column:
    """Completed years; a 29 February birthday has not come by 28 February."""
    born, today = birthday.cast("date"), as_of.cast("date")
    not_yet = F.date_format(today, "MMdd") < F.date_format(born, "MMdd")
    return F.year(today) - F.year(born) - not_yet.cast("int")


def previous_day(day: Column) -> Column:
    return F.date_format(F.date_sub(day.cast("date"), 1), "yyyy-MM-dd")


def reversed_key(key: Column) -> Column:
    return F.reverse(key)


def salted_key(key: Column, width: int = 3) -> Column:
    """Prefix a key with the head of its md5 so that neighbours spread out."""
    return F.concat(F.substring(F.md5(key), 1, width), key)


# Change-event types and their one-letter codes.
OP_CODES = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}


def op_code(kind: Column) -> Column:
    """One-letter operation code, null for events nobody wants."""
    code = F.lit(None).cast("string")
    for name, letter in OP_CODES.items():
        code = F.when(kind == name, letter).otherwise(code)
    return code


def join_values(values: Column) -> Column:
    return F.array_join(values, "_")


def seconds_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later steps use several times.

    Catalyst copies a projected expression into the filters above it, and a parsed document
    would be parsed anew for each of them. A generator is not copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def copy_fields(df: DataFrame, targets: list[str], *sources: str) -> DataFrame:
    """Fill ``targets`` from same-named fields of struct columns.

    A later source wins over an earlier one; a target no source has is null.
    """
    owner = {}
    for source in sources:
        for field in df.schema[source].dataType.fieldNames():
            owner[field] = source
    picked = [
        F.col(f"{owner[t]}.{t}").alias(t) if t in owner else F.lit(None).alias(t)
        for t in targets
    ]
    return df.select(*picked)
