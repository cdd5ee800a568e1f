"""Upsert into a JDBC table (SNK-05).

Spark's JDBC writer appends, so a batch goes to a staging table and two statements move it
over inside the database: update the known keys, insert the others. No row passes the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rillflow.operators.mutate import last_per_key


def upsert_statements(table: str, staging: str, keys: list[str], columns: list[str]) -> list[str]:
    """Standard SQL; last write per key is decided before staging, so keys are unique there."""
    rest = [c for c in columns if c not in keys]
    same = " AND ".join(f"{table}.{k} = {staging}.{k}" for k in keys)
    picked = ", ".join(f"{c} = (SELECT {staging}.{c} FROM {staging} WHERE {same})" for c in rest)
    exists = f"EXISTS (SELECT 1 FROM {staging} WHERE {same})"
    unknown = f"NOT EXISTS (SELECT 1 FROM {table} WHERE {same})"
    names = ", ".join(columns)
    return [
        f"UPDATE {table} SET {picked} WHERE {exists}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE {unknown}",
    ]


def upsert_writer(
    options: dict[str, str], table: str, staging: str, keys: list[str], order: list[str],
    columns: list[str], execute: Callable[[list[str]], None],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function; ``execute`` runs statements in one transaction."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = last_per_key(batch, keys, order).select(*columns)
        rows.write.format("jdbc").options(**options, dbtable=staging, truncate="true").mode(
            "overwrite"
        ).save()
        execute(upsert_statements(table, staging, keys, columns))

    return write
