"""Session factory."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # only the partitions a write touches are replaced
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # state lives off-heap and on disk, so key counts are not limited by executor memory
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    overrides: Mapping[str, str] | None = None,
) -> SparkSession:
    """Return a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are normally left to spark-submit. AQE coalesces batch
    shuffles, but a stream keeps the partition count of its first checkpoint, so streaming jobs
    should pass ``shuffle_partitions`` sized for the state they will grow into.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(DEFAULTS)
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir:
        options["spark.checkpoint.dir"] = checkpoint_dir
    options.update(overrides or {})
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set a session option within a ``with`` block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
