"""Relational sinks.

Reports are small when they reach a database; ``connections`` bounds how many tasks write at once.
Every error is raised, so a failed batch is retried instead of being lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from contextlib import closing
from itertools import islice

from pyspark.sql import DataFrame, Row


def jdbc_options(
    url: str, table: str, user: str | None = None, password: str | None = None, driver: str | None = None,
    batch_size: int = 1000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    named = {"user": user, "password": password, "driver": driver}
    options.update({name: value for name, value in named.items() if value is not None})
    return options


def write_jdbc(rows: DataFrame, options: dict[str, str], mode: str = "append", connections: int = 8) -> None:
    """Append to a table or, with ``mode="overwrite"``, replace it."""
    rows.write.format("jdbc").options(**options).option("numPartitions", connections).mode(mode).save()


def upsert_statement(table: str, keys: Sequence[str], values: Sequence[str], mark: str = "?") -> str:
    """Insert that updates the value columns of an existing key (MySQL syntax)."""
    columns = [*keys, *values]
    changes = ", ".join(f"{name} = VALUES({name})" for name in values)
    return f"{_insert('INSERT', table, columns, mark)} ON DUPLICATE KEY UPDATE {changes}"


def replace_statement(table: str, columns: Sequence[str], mark: str = "?") -> str:
    """Delete-and-insert by unique key (MySQL syntax)."""
    return _insert("REPLACE", table, columns, mark)


def _insert(verb: str, table: str, columns: Sequence[str], mark: str) -> str:
    return f"{verb} INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))})"


def write_statement(
    rows: Iterable[Row], connect: Callable[[], object], statement: str, columns: Sequence[str], batch_size: int = 1000
) -> int:
    """Run ``statement`` for each row over one DB-API connection, in one transaction."""
    written = 0
    values = (tuple(row[name] for name in columns) for row in rows)
    with closing(connect()) as connection:
        cursor = connection.cursor()
        try:
            while batch := list(islice(values, batch_size)):
                cursor.executemany(statement, batch)
                written += len(batch)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    return written


def upsert_jdbc(
    rows: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    values: Sequence[str],
    connections: int = 8,
    mark: str = "?",
) -> None:
    """Upsert a report over at most ``connections`` connections, one transaction per task."""
    columns = [*keys, *values]
    statement = upsert_statement(table, keys, values, mark)
    rows.select(*columns).coalesce(connections).foreachPartition(
        lambda part: write_statement(part, connect, statement, columns) and None
    )


class RowReplacer:
    """Row writer for ``DataStreamWriter.foreach``: replaces each row by its unique key.

    One connection per task and epoch; the rows are committed together when the task closes.
    """

    def __init__(self, connect: Callable[[], object], table: str, columns: Sequence[str], mark: str = "?"):
        self.connect = connect
        self.columns = tuple(columns)
        self.statement = replace_statement(table, columns, mark)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.connection = self.connect()
        self.cursor = self.connection.cursor()
        return True

    def process(self, row: Row) -> None:
        self.cursor.execute(self.statement, tuple(row[name] for name in self.columns))

    def close(self, error: Exception | None) -> None:
        try:
            if error is None:
                self.connection.commit()
            else:
                self.connection.rollback()
        finally:
            self.connection.close()
