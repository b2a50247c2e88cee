"""Latest-state tables: a Parquet folder of everything put under a key, read as the newest row or fields of each key.

A put is one partition, named after the stream and its micro-batch, and the only commit is Spark's dynamic partition
overwrite: a batch that runs again replaces its own partition and nothing else, and a new checkpoint, being another
stream, adds partitions of its own. What is newest is decided on reading, by one grouping with a map-side step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import list_folders

STREAM, BATCH, TIME = "state_stream", "state_batch", "state_time"
BY_ROW, BY_FIELD = "row", "field"


@dataclass(frozen=True)
class KeyedTable:
    """``merge`` says what a put replaces: the whole row of its key, or only the fields it has a value for."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    merge: str = BY_ROW

    def upsert(
        self,
        rows: DataFrame,
        batch_id: int | None = None,
        order_by: str | Column | None = None,
        unique: bool = False,
        stream: str = "main",
    ) -> None:
        """Put rows under their keys. ``order_by`` tells which row of a key is the last one among them.

        ``unique`` states that there is one row per key already, as the result of grouping by the keys has. The same
        ``batch_id`` of a ``stream`` again replaces what it put before; without one the put is one of its own.
        """
        if not unique and order_by is None:
            raise ValueError("give order_by, or unique=True for rows with one row per key")
        stamped = timed(rows)
        if not unique:
            stamped = last_per_key(stamped, self.keys, order_by, self.merge)
        self._put(stamped, *((uuid4().hex, 0) if batch_id is None else (stream, batch_id)))

    def replace(self, rows: DataFrame) -> None:
        """Put rows that stand for the whole table, as a complete-mode batch does; they replace the ones put so before."""
        self._put(timed(rows), "complete", 0)

    def read(self) -> DataFrame:
        """Current rows."""
        if not list_folders(self.spark, self.path):
            raise FileNotFoundError(f"nothing written to {self.path}")
        return latest(self.history(), self.keys, self.merge)

    def history(self) -> DataFrame:
        """All rows put, with their stream, batch and time."""
        return self.spark.read.option("mergeSchema", str(self.merge == BY_FIELD).lower()).parquet(self.path)

    def _put(self, rows: DataFrame, stream: str, batch_id: int) -> None:
        checked = rows.select(*[self._checked(name) for name in rows.columns])
        placed = checked.withColumns({STREAM: F.lit(stream), BATCH: F.lit(batch_id)})
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(STREAM, BATCH).parquet(self.path)
        if not list_folders(self.spark, self.path):  # no row in the first put: it leaves the columns only
            checked.limit(0).write.mode("append").parquet(f"{self.path}/{STREAM}={stream}/{BATCH}={batch_id}")

    def _checked(self, name: str) -> Column:
        if name not in self.keys:
            return F.col(name)
        missing = F.raise_error(F.lit(f"null in key column {name}"))
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name)).alias(name)


def timed(rows: DataFrame) -> DataFrame:
    """``rows`` with the time of the put, if they have none.

    Taken within a stream it is the time Spark recorded for the micro-batch in the checkpoint, so a batch that runs again
    keeps its place among the batches of other streams.
    """
    return rows if TIME in rows.columns else rows.withColumn(TIME, F.current_timestamp())


def latest(history: DataFrame, keys: Sequence[str], merge: str = BY_ROW) -> DataFrame:
    """The newest row of each key, or the newest value of each field that is not null."""
    values = history.drop(STREAM, BATCH, TIME).columns
    return last_per_key(history, keys, F.struct(TIME, BATCH), merge).select(*values)


def last_per_key(rows: DataFrame, keys: Sequence[str], order_by: str | Column, merge: str = BY_ROW) -> DataFrame:
    """The row with the largest ``order_by`` for each key, reduced within tasks before the shuffle.

    A row without it comes before all others, and rows that tie are told apart by their content, so
    the outcome never depends on their order. With ``merge`` by field, each field keeps the last
    value that is not null.
    """
    values = [name for name in rows.columns if name not in keys]
    order = F.struct(F.col(order_by) if isinstance(order_by, str) else order_by, F.xxhash64(*values) if values else F.lit(0))
    if merge == BY_FIELD:
        newest = [F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(name) for name in values]
        return rows.groupBy(*keys).agg(*newest).select(*rows.columns) if newest else rows.distinct()
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("newest"))
    columns = [F.col(name) if name in keys else F.col(f"newest.{name}") for name in rows.columns]
    return newest.select(*columns)


def keyed_table(spark: SparkSession, path: str, *keys: str, merge: str = BY_ROW) -> KeyedTable:
    return KeyedTable(spark, path, tuple(keys), merge)
