"""Run queries beside their SQL twins on DuckDB and compare rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def compare(df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal, else what differs."""
    names = sorted(df.columns)
    theirs = sorted(str(d[0]) for d in db.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    if names != theirs:
        return f"columns {sorted(set(names) ^ set(theirs))} are on one side only"
    found = db.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql})")
    theirs = [str(d[1]) for d in found.description]
    expected = Counter(found.fetchall())
    ours = [df.schema[n].dataType.simpleString() for n in names]
    rows = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    problems = []
    for name, mine, other in zip(names, ours, theirs):
        if KINDS.get(other, other) != mine:
            problems.append(f"type of {name}: {mine} vs {other}")
    if rows != expected:
        extra, missing = rows - expected, expected - rows
        problems.append(
            f"rows {sum(rows.values())} vs {sum(expected.values())};"
            f" extra {list(extra)[:2]}; missing {list(missing)[:2]}"
        )
    return "; ".join(problems)


def main() -> None:
    from rillflow.catalog import ORACLES, QUERIES
    from rillflow.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    spark, db = build_session("oracle"), connect(folder)
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            sql = ORACLES.get(name)
            problem = compare(df, db, sql) if sql else f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'BAD '} {name} {time.time() - began:.1f}s {problem}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")


if __name__ == "__main__":
    main()
