"""Catalog tables: definition, partitioned writes and partition maintenance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import setting
from .files import balanced


@dataclass(frozen=True)
class ReportTable:
    """A report table with its declared key."""

    name: str
    keys: tuple[str, ...]
    values: tuple[str, ...]


# Names and columns of the two report tables.
REGION_COUNTS = ReportTable("region_stat_analysis", ("report_date", "province", "city"), ("count",))
REGION_KPIS = ReportTable(
    "ads_region_analysis",
    ("report_date", "province", "city"),
    (
        "orginal_req_cnt",
        "valid_req_cnt",
        "ad_req_cnt",
        "join_rtx_cnt",
        "success_rtx_cnt",
        "ad_show_cnt",
        "ad_click_cnt",
        "media_show_cnt",
        "media_click_cnt",
        "dsp_pay_money",
        "dsp_cost_money",
        "success_rtx_rate",
        "ad_click_rate",
        "media_click_rate",
    ),
)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: str | None = None,
    location: str | None = None,
    compression: str = "snappy",
) -> None:
    """Create a Parquet table, partitioned when ``partition_by`` names one of its columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    statement += f" OPTIONS ('compression' = '{compression}')"
    if partition_by:
        statement += f" PARTITIONED BY (`{partition_by}`)"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def append_partitions(
    rows: DataFrame, table: str, by: str = "date_str", path: str | None = None, one_value: bool = False
) -> None:
    """Append to a partitioned table, creating it if need be. A repeated run adds its rows again."""
    writer = balanced(rows, by, one_value).write.format("parquet").mode("append").partitionBy(by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def replace_partitions(rows: DataFrame, table: str, by: str = "date_str", one_value: bool = False) -> None:
    """Replace the partitions ``rows`` covers, so a repeated run leaves the same table.

    Inserting into a table obeys the session option only; a static overwrite would wipe all days.
    """
    spark = rows.sparkSession
    target = spark.read.table(table).columns
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        balanced(rows.select(*target), by, one_value).write.mode("overwrite").insertInto(table)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    text = value.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{text}')")


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
