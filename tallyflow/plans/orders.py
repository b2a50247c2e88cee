"""Order records: topic-to-topic cleaning and storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.lookups import BROADCAST_ROWS, locate_in_blocks, locate_ips
from ..operators.parsing import has_fields, non_blank, parse_payload, to_payload
from ..schemas import ORDER, RAW_ORDER
from ..sinks.cells import order_rows
from ..sinks.keyed import BATCH, STREAM, KeyedTable
from ..sinks.streams import keyed_sink, put_batch, stream_id, writer_of
from ..sources.regions import EDITION, newest_edition, octets_of, read_regions
from ..workspace import path_exists

OPEN = 0


def open_orders(records: DataFrame) -> DataFrame:
    orders = parse_payload(has_fields(records), RAW_ORDER)
    return orders.withColumn("orderStatus", F.col("orderStatus").try_cast("int")).where(F.col("orderStatus") == OPEN)


def enrich_orders(records: DataFrame, ranges: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Open orders with the region of their address, as ``key`` and JSON ``value``.

    On a stream every micro-batch plans the dictionary anew: give it the blocks of a published one, not ranges yet to be
    parsed and cut.
    """
    return to_payload(locate_ips(open_orders(records), ranges, broadcast_rows=broadcast_rows), "orderId", ORDER.fieldNames())


def enrich_in_batches(records: DataFrame, regions: str, target: str, checkpoint: str, broadcast_rows: int = BROADCAST_ROWS) -> DataStreamWriter:
    """The same for a long-running stream against a published dictionary in the folder ``regions``.

    Each micro-batch takes the newest edition and notes it before it writes, so a batch that runs again uses the edition
    it began with, while later batches follow new editions without a restart. Only blocks of the batch's first
    octets are read. A batch is one partition of ``target``, replaced as a whole when it runs again.
    """
    spark = records.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(spark, checkpoint)
        edition = noted_edition(spark, target, stream, batch_id, newest_edition(spark, regions))
        batch.persist()
        try:
            blocks = read_regions(spark, regions, edition, octets_of(batch))
            located = to_payload(locate_in_blocks(batch, blocks, broadcast_rows=broadcast_rows), "orderId", ORDER.fieldNames())
            put_batch(located, target, stream, batch_id)
        finally:
            batch.unpersist()

    return writer_of(open_orders(records), checkpoint, "append").foreachBatch(run)


def noted_edition(spark: SparkSession, target: str, stream: str, batch_id: int, newest: int) -> int:
    """Edition a batch has noted, or the newest one, noted now; notes lie in a folder that readers of ``target`` skip."""
    note = f"{target}/_editions/{STREAM}={stream}/{BATCH}={batch_id}"
    if not path_exists(spark, f"{note}/_SUCCESS"):
        spark.range(1).select(F.lit(newest).alias(EDITION)).write.mode("overwrite").parquet(note)
    return spark.read.parquet(note).first()[0]


def editions_used(spark: SparkSession, target: str) -> DataFrame:
    """``(state_stream, state_batch, edition)`` of every batch that ``enrich_in_batches`` wrote."""
    return spark.read.parquet(f"{target}/_editions").select(STREAM, BATCH, EDITION)


def order_documents(records: DataFrame, payload: bool = False) -> DataFrame:
    """Flat text columns of each order, one document per ``orderId``; with ``payload``, the record as it came too."""
    return parse_payload(non_blank(records), ORDER, payload=payload)


def index_orders(records: DataFrame, table: KeyedTable, checkpoint: str, rejects: str | None = None) -> DataStreamWriter:
    """Keep the newest document of each order; within a batch the latest order time wins.

    A table that merges by field updates what a document carries; one that merges by row replaces it.
    """
    documents = order_documents(records, payload=rejects is not None)
    return keyed_sink(documents, table, checkpoint, "append", order_by="orderTime", rejects=rejects)


def put_orders(records: DataFrame, table: KeyedTable, checkpoint: str, rejects: str | None = None) -> DataStreamWriter:
    """Put each order under its row key; a later record of the same key replaces the cells.

    Records without a row key fail the stream, or go to the folder ``rejects`` if one is given.
    """
    rows = order_rows(records, payload=rejects is not None)
    return keyed_sink(rows, table, checkpoint, "append", order_by="orderId", rejects=rejects)
