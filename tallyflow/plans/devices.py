"""Device signal statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import rounded_mean
from ..operators.parsing import non_blank, parse_payload
from ..schemas import DEVICE_SIGNAL

MIN_SIGNAL = 30


def device_signals(records: DataFrame) -> DataFrame:
    """Signals from JSON payloads; a signal that is no number is null."""
    return parse_payload(non_blank(records), DEVICE_SIGNAL).select(
        F.col("device").alias("device_id"),
        F.col("deviceType").alias("device_type"),
        F.col("signal").try_cast("double").alias("signal"),
        "time",
    )


def device_stats(signals: DataFrame, above: float = MIN_SIGNAL) -> DataFrame:
    """Count and mean of the strong signals per device type."""
    return (
        signals.where(F.col("signal") > above)
        .groupBy("device_type")
        .agg(F.count("device_type").alias("count_device"), rounded_mean("signal").alias("avg_signal"))
    )


def device_stats_sql(signals: DataFrame, above: float = MIN_SIGNAL) -> DataFrame:
    """The same statistics in SQL over a view, which may be a stream."""
    signals.createOrReplaceTempView("device_signals_view")
    return signals.sparkSession.sql(
        f"""
        SELECT device_type, count(device_type) AS count_device, round(avg(signal), 2) AS avg_signal
        FROM device_signals_view WHERE signal > {float(above)} GROUP BY device_type
        """
    )
