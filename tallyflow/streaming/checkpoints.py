"""What a query's checkpoint says, as DataFrames: its batches, their files and its state.

All of it is read from the folder, so it outlives the driver that ran the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import list_folders, path_exists

RETAIN = "spark.sql.streaming.minBatchesToRetain"  # batches a query's logs keep, 100 by default


def batch_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(batch, planned_at, watermark, offsets, committed)`` of every batch the logs still hold.

    A batch that is planned but not committed runs again with the same offsets when the query starts. ``offsets`` has the
    JSON text of each source, null for one that had nothing yet. Queries keep the number of batches named by the setting
    ``minBatchesToRetain``; the files of older batches stay known to ``batch_files``.
    """
    planned = _log(spark, f"{checkpoint}/offsets").select(
        "batch",
        F.timestamp_millis(_field("batchTimestampMs")).alias("planned_at"),
        F.timestamp_millis(_field("batchWatermarkMs")).alias("watermark"),
        F.transform(F.slice("lines", 3, F.size("lines")), lambda x: F.when(x != "-", x)).alias("offsets"),
    )
    if not path_exists(spark, f"{checkpoint}/commits"):
        return planned.withColumn("committed", F.lit(False))
    done = _log(spark, f"{checkpoint}/commits").select("batch", F.lit(True).alias("committed"))
    return planned.join(done, "batch", "left").withColumn("committed", F.coalesce("committed", F.lit(False)))


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Watermark in milliseconds that a batch was planned with; 0 while no row has raised it. Reads one small file."""
    planned = _log(spark, f"{checkpoint}/offsets/{batch_id}").select(_field("batchWatermarkMs"))
    return planned.first()[0]


def batch_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``(batch, path)`` of every file that a file source has ever given to a batch.

    The source's log is compacted, not cut: compacted files repeat earlier entries, so they are made distinct.
    """
    lines = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId bigint").alias("e")
    return lines.select(entry).select(F.col("e.batchId").alias("batch"), "e.path").distinct()


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys and values that a stateful step holds after the last batch, by Spark's state reader."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful steps of a query, with their store and number of partitions."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_sizes(spark: SparkSession, checkpoint: str) -> dict[int, int]:
    """Rows of state for each stateful step."""
    return {int(n): state_rows(spark, checkpoint, int(n)).count() for n in list_folders(spark, f"{checkpoint}/state") if n.isdigit()}


def _log(spark: SparkSession, folder: str) -> DataFrame:
    texts = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    numbered = texts.where(F.col("name").rlike(r"^\d+$"))
    return numbered.select(F.col("name").cast("bigint").alias("batch"), F.split("value", "\n").alias("lines"))


def _field(name: str) -> Column:
    return F.get_json_object(F.get("lines", F.lit(1)), f"$.{name}").cast("bigint")
