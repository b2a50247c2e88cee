"""Sliding-window counts that keep what comes too late, with the lateness of every row on record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..sinks.streams import put_batch, stream_id, writer_of
from ..workspace import list_folders
from .checkpoints import batch_watermark

SPAN = "window_start timestamp, window_end timestamp"


def windows_with_late_rows(
    timed: DataFrame,
    counts: str,
    late: str,
    checkpoint: str,
    key: str = "word",
    time: str = "time",
    length: str = "10 seconds",
    slide: str = "5 seconds",
    watermark: str = "10 seconds",
) -> DataStreamWriter:
    """Counts per window and key to the folder ``counts``, rows of windows that had ended to the folder ``late``.

    A window has ended for a micro-batch when it ends at or before the watermark that the checkpoint planned for it. The rows
    are split before anything is counted, so each pair of a row and a window is in exactly one of the two folders; a row can
    be late for one of its windows and in time for another. The query holds no state: a batch adds its partial counts as one
    partition, and ``read_windows`` sums them. A replayed batch has the same offsets and the same watermark and replaces its
    own partitions. Rows without a time belong to no window; ``checked_times`` keeps them as rejects.
    """
    spark, known = timed.sparkSession, {}

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = known.setdefault("id", stream_id(spark, checkpoint))
        mark = F.timestamp_millis(F.lit(batch_watermark(spark, checkpoint, batch_id)))
        spans = batch.withColumn("window", F.window(time, length, slide))
        spans = spans.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")
        batch.persist()
        try:
            put_batch(spans.where(F.col("window_end") <= mark).withColumn("watermark", mark), late, stream, batch_id)
            in_time = spans.where(F.col("window_end") > mark)
            put_batch(in_time.groupBy("window_start", "window_end", key).count(), counts, stream, batch_id)
        finally:
            batch.unpersist()

    return writer_of(timed.withWatermark(time, watermark), checkpoint, "append").foreachBatch(run)


def read_windows(spark: SparkSession, counts: str, key: str = "word", kind: str = "string") -> DataFrame:
    """Counts per window and key over all batches written so far."""
    parts = _read(spark, counts, f"{SPAN}, {key} {kind}, count bigint")
    return parts.groupBy("window_start", "window_end", key).agg(F.sum("count").alias("count"))


def read_late_rows(spark: SparkSession, late: str, row: str = "time timestamp, word string") -> DataFrame:
    """Late rows, once per window they missed, with the watermark they were behind."""
    return _read(spark, late, f"{row}, {SPAN}, watermark timestamp")


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not list_folders(spark, folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(folder)
    return rows.select(*spark.createDataFrame([], schema).columns)
