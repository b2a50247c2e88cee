"""Stateful stream operators; each also works on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import partition_salt

DEDUP_SALTS = 16
THINNED = "1 minute"


def windowed_counts(
    timed: DataFrame,
    key: str = "word",
    time: str = "time",
    length: str = "10 seconds",
    slide: str = "5 seconds",
    watermark: str | None = None,
) -> DataFrame:
    """Counts per sliding event-time window and key.

    With a ``watermark``, rows of windows that ended before it are dropped and their state freed.
    A new watermark takes effect with the batch after the one that raised it; when batches follow
    each other without a pause, rows are compared with the watermark of one batch earlier.
    """
    if watermark:
        timed = timed.withWatermark(time, watermark)
    return timed.groupBy(F.window(time, length, slide), key).count()


def flat_windows(counts: DataFrame) -> DataFrame:
    """The same rows with the window as start and end columns."""
    others = [name for name in counts.columns if name != "window"]
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def first_per_key(
    rows: DataFrame, keys: Sequence[str], within: tuple[str, str] | None = None, salts: int = DEDUP_SALTS
) -> DataFrame:
    """Pass one row per key.

    ``within`` is a time column and a delay: keys are then forgotten once the delay has passed,
    which bounds the state. Otherwise every key ever seen is kept, once. On a stream, rows are first
    deduplicated within ``salts`` parts of their key, so that a key holding a large share of a
    micro-batch is spread over tasks and only one row per part goes on. That step only has to thin
    out what arrives together: without ``within`` it remembers a key for ``THINNED`` of clock time.
    """
    names = list(keys)
    if within is not None:
        rows = rows.withWatermark(*within)
    if rows.isStreaming and salts > 1:
        parts = rows.withColumn("_part", partition_salt(salts))
        if within is None:
            parts = parts.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", THINNED)
        rows = parts.dropDuplicatesWithinWatermark([*names, "_part"]).select(*rows.columns)
    return rows.dropDuplicates(names) if within is None else rows.dropDuplicatesWithinWatermark(names)


def deduplicated_counts(rows: DataFrame, keys: Sequence[str], salts: int = DEDUP_SALTS) -> DataFrame:
    """Count after deduplication on the same keys, which is one for every key."""
    return first_per_key(rows, keys, salts=salts).groupBy(*keys).count()
