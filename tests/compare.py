"""Runs registered queries next to their SQL in DuckDB and compares the sorted rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_rows, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names and rows agree, else a short account of what does not."""
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    if sorted(names) != sorted(spark_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(names)}"
    expected = rows_of(names, found.fetchall())
    actual = rows_of(spark_rows.columns, [tuple(row) for row in spark_rows.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"{a} != {e}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tallyflow.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, overrides={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            frame = run(spark, folder)
            sql = oracle_sql().get(name)
            result = difference(frame, connection, sql) if sql else f"rows only: {frame.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32} {time.time() - began:6.2f}s  {result or 'ok'}", flush=True)
