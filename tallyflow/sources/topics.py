"""Key and value record streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TOPIC_RECORD


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def topic_stream(
    spark: SparkSession,
    folder: str | None = None,
    kafka: dict[str, str] | None = None,
    file_format: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """``key`` and ``value`` text columns from a Kafka topic or a folder of record files.

    ``kafka`` takes :func:`kafka_options` and needs the Kafka connector on the class path; the
    folder form carries the same two columns, with ``max_files`` limiting each micro-batch.
    """
    if kafka is not None:
        reader = spark.readStream.format("kafka").options(**kafka).load()
    else:
        source = spark.readStream.schema(TOPIC_RECORD).format(file_format)
        if max_files is not None:
            source = source.option("maxFilesPerTrigger", max_files)
        reader = source.load(folder)
    return reader.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def rate_stream(
    spark: SparkSession,
    rows_per_second: int = 10,
    partitions: int = 2,
    ramp_up: str = "0s",
    per_batch: bool = False,
    start_timestamp: int = 0,
) -> DataFrame:
    """Generated ``timestamp`` and ``value`` rows; ``per_batch`` repeats exactly from run to run."""
    if per_batch:
        return (
            spark.readStream.format("rate-micro-batch")
            .option("rowsPerBatch", rows_per_second)
            .option("numPartitions", partitions)
            .option("startTimestamp", start_timestamp)
            .load()
        )
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("rampUpTime", ramp_up)
        .option("numPartitions", partitions)
        .load()
    )
