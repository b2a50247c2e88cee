"""Key-value tables read as cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells_of(
    table: DataFrame, row_key: str, columns: list[str], family: str = "info", version: str | None = None
) -> DataFrame:
    """One row per non-null cell: row_key, family, qualifier, version, value.

    ``table`` is a wide keyed table; ``version`` names its version column when it has one.
    """
    stamp = F.col(version) if version else F.lit(0)
    wide = table.select(
        F.col(row_key).alias("row_key"),
        stamp.cast("bigint").alias("version"),
        *[F.col(name).cast("string").alias(name) for name in columns],
    )
    return (
        wide.unpivot(["row_key", "version"], columns, "qualifier", "value")
        .where("value IS NOT NULL")
        .select("row_key", F.lit(family).alias("family"), "qualifier", "version", "value")
    )
