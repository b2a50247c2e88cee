"""Grouped aggregates shared by the reports.

All of them use aggregates with a partial step, so a hot key reaches the shuffle as one row per
task however many input rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_summary(counts: DataFrame, column: str = "count") -> DataFrame:
    """Largest, smallest and mean group count in one pass."""
    return counts.agg(
        F.max(column).alias("max_count"), F.min(column).alias("min_count"), F.avg(column).alias("mean_count")
    )


def rounded_mean(value: str | Column, digits: int = 2) -> Column:
    return F.round(F.avg(value), digits)


def mean_by(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return rows.groupBy(key).agg(rounded_mean(value).alias(name))


def mean_by_sql(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The same average as :func:`mean_by`, written in SQL."""
    return rows.sparkSession.sql(
        f"SELECT {key}, round(avg({value}), 2) AS {name} FROM {{rows}} GROUP BY {key}", rows=rows
    )


def sum_by(rows: DataFrame, value: str, *keys: str | Column, name: str = "total") -> DataFrame:
    """Sum per key; with no keys the sum over everything."""
    return rows.groupBy(*keys).agg(F.sum(value).alias(name))


def pivot_sum(
    rows: DataFrame, column: str, value: str, values: Sequence[str] | None = None
) -> DataFrame:
    """One wide row with the sum of ``value`` per distinct ``column`` value.

    Naming ``values`` saves the job that finds them.
    """
    grouped = rows.groupBy().pivot(column, list(values)) if values else rows.groupBy().pivot(column)
    return grouped.sum(value)
