"""Streaming sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.rejects import PAYLOAD, REASON, good_rows, rejected_rows
from ..session import ROCKSDB_STATE
from ..workspace import list_folders
from .keyed import BATCH, STREAM, KeyedTable, timed

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def topic_sink(
    records: DataFrame,
    checkpoint: str,
    folder: str | None = None,
    kafka: dict[str, str] | None = None,
    file_format: str = "json",
) -> DataStreamWriter:
    """Append ``key`` and ``value`` records to a Kafka topic or a folder of record files.

    ``kafka`` holds ``kafka.bootstrap.servers`` and ``topic`` and needs the Kafka connector.
    """
    writer = writer_of(records, checkpoint, "append")
    if kafka is not None:
        return writer.format("kafka").options(**kafka)
    return writer.format(file_format).option("path", folder)


def console_sink(rows: DataFrame, mode: str = "update", rows_shown: int = 20, truncate: bool = False) -> DataStreamWriter:
    keep_state_on_disk(rows.sparkSession)
    return (
        rows.writeStream.outputMode(mode)
        .format("console")
        .option("numRows", rows_shown)
        .option("truncate", str(truncate).lower())
    )


def batch_sink(
    rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "update"
) -> DataStreamWriter:
    """Hand every non-empty micro-batch to ``write`` together with its id.

    The batch is persisted for the emptiness check and the write, so its source is read once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return writer_of(rows, checkpoint, mode).foreachBatch(run)


def keyed_sink(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    mode: str = "update",
    order_by: str | Column | None = None,
    rejects: str | None = None,
) -> DataStreamWriter:
    """Upsert every micro-batch under the stream's id and its batch id.

    A complete-mode batch replaces the one before. With no ``order_by`` the rows must be one per key.

    A row with a null key fails the batch. With ``rejects`` such rows go to a folder of that path,
    one per batch, and the batch goes on; a column ``payload`` then holds the record as it came and
    is left out of the table.
    """
    spark, known = rows.sparkSession, {}

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = known.setdefault("id", stream_id(spark, checkpoint))
        if rejects is not None:
            bad = F.lit(False)
            for key in table.keys:
                bad = bad | F.col(key).isNull()
            batch.where(bad).write.mode("overwrite").parquet(f"{rejects}/stream={stream}/batch={batch_id}")
            batch = batch.where(~bad).drop("payload")
        if mode == "complete":
            table.replace(batch)
        else:
            table.upsert(batch, batch_id, order_by=order_by, unique=order_by is None, stream=stream)

    return writer_of(timed(rows), checkpoint, mode).foreachBatch(run)


def put_batch(rows: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Write a micro-batch as one partition of ``path``; the batch again replaces it."""
    placed = rows.withColumns({STREAM: F.lit(stream), BATCH: F.lit(batch_id)})
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(STREAM, BATCH).parquet(path)


def split_sink(
    checked: DataFrame, checkpoint: str, rejects: str, write: Callable[[DataFrame, str, int], None]
) -> DataStreamWriter:
    """Good rows of every micro-batch to ``write`` with the stream's id and the batch's, rejects to the folder ``rejects``.

    ``checked`` carries ``payload`` and ``reject_reason``. The batch is parsed once and persisted for both. Rejects are
    written first, so a batch that counts has left all its records in one of the two places.
    """
    spark, known = checked.sparkSession, {}

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = known.setdefault("id", stream_id(spark, checkpoint))
        batch.persist()
        try:
            put_batch(rejected_rows(batch), rejects, stream, batch_id)
            write(good_rows(batch), stream, batch_id)
        finally:
            batch.unpersist()

    return writer_of(checked, checkpoint, "append").foreachBatch(run)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All rejects kept in a folder; none when no batch had any."""
    schema = f"{PAYLOAD} string, {REASON} string"
    return spark.read.schema(schema).parquet(path).select(PAYLOAD, REASON) if list_folders(spark, path) else spark.createDataFrame([], schema)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query a checkpoint belongs to; a new checkpoint has a new one."""
    text = "".join(r[0] for r in spark.read.text(f"{checkpoint}/metadata").collect())
    return json.loads(text)["id"]


def writer_of(rows: DataFrame, checkpoint: str, mode: str) -> DataStreamWriter:
    keep_state_on_disk(rows.sparkSession)
    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Use the RocksDB state store unless the session names another one.

    The number of keys is then not limited by executor memory. A query restarted from a checkpoint
    keeps the store it began with.
    """
    if not spark.conf.get(STATE_STORE, ""):
        spark.conf.set(STATE_STORE, ROCKSDB_STATE)
