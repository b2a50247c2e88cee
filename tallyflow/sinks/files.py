"""File sinks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(rows: DataFrame, path: str, separator: str = ",", stamped: bool = False) -> str:
    """Write the columns of each row as one text line; ``stamped`` makes a fresh path per run."""
    target = f"{path}-{int(time.time() * 1000)}" if stamped else path
    rows.select(F.concat_ws(separator, *[F.col(name).cast("string") for name in rows.columns])).write.text(target)
    return target


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with CSV. Ask for one file only for a result of bounded size."""
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").csv(path)


def write_partitions(rows: DataFrame, path: str, by: str = "date_str", one_value: bool = False) -> None:
    """Replace the partitions that ``rows`` covers, leaving the others alone.

    Rows are rebalanced by the partition column: each partition gets a few files of the advisory
    size and a partition that holds most rows is split over several tasks. Rows that all carry one
    value (``one_value``) need no shuffle: each task adds one file to the same partition.
    """
    (
        balanced(rows, by, one_value)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def balanced(rows: DataFrame, by: str, one_value: bool = False) -> DataFrame:
    return rows if one_value else rows.hint("rebalance", F.col(by))
