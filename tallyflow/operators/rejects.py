"""Records that a report can't use, kept as data with the reason instead of vanishing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD, REASON = "payload", "reject_reason"


def with_reason(rows: DataFrame, faults: Mapping[str, Column]) -> DataFrame:
    """``reject_reason``: the name of the first fault that holds for a row, null for a good one.

    A fault that is null does not hold. The reason is a column, so good rows and rejects come from one parse.
    """
    return rows.withColumn(REASON, F.coalesce(*[F.when(fault, F.lit(name)) for name, fault in faults.items()]))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(PAYLOAD, REASON)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The records as they came, with the reason."""
    return checked.where(F.col(REASON).isNotNull()).select(PAYLOAD, REASON)
