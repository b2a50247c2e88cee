"""File and table sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import day_before


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as one ``value`` column."""
    return spark.read.text(path)


def line_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in ``folder``."""
    return _limited(spark.readStream, max_files).text(folder)


def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON records. Without a schema Spark reads the data once more to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_day(spark: SparkSession, table: str, as_of: date | None = None, column: str = "date_str") -> DataFrame:
    """Partition of the day before ``as_of``; the bare partition column lets the scan prune."""
    return spark.read.table(table).where(F.col(column) == day_before(as_of))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Rows written out in the program, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def separated_stream(
    spark: SparkSession, folder: str, schema: StructType, separator: str = ";", max_files: int | None = None
) -> DataFrame:
    """Header-less separated files that arrive in ``folder``."""
    reader = spark.readStream.schema(schema).option("sep", separator).option("header", "false")
    return _limited(reader, max_files).csv(folder)


def parquet_stream(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Parquet files that arrive in ``folder``, narrowed to names matching ``pattern``."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return _limited(reader, max_files).parquet(folder)


def _limited(reader, max_files: int | None):
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
