"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import setting
from tallyflow.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: White space that separates words, as a pattern class: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\f\r"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the queries within go when each has ended, not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read again: computed once, and safe when executors go.

    What was shuffled for them is not needed again and leaves the executors' disks.
    """
    spark = rows.sparkSession
    path = new_folder(spark, label)
    with shuffles_dropped(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def doc_crc(doc_id: Column) -> Column:
    """CRC-32 of the identifier's decimal text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def packed(documents: DataFrame, *needed: str | Column) -> DataFrame:
    """``row``, a struct of all columns, beside the needed ones: own names can't clash with those of the table."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *needed)


def unpacked(rows: DataFrame, without: tuple[str, ...] = (), *more: str | Column) -> DataFrame:
    """The columns of ``row`` again, less those that results replace, and the results."""
    names = [f.name for f in rows.schema["row"].dataType.fields if f.name not in without]
    return rows.select(*[F.col("row").getField(n).alias(n) for n in names], *more)
