"""A region dictionary as a table of blocks, cut once and read pruned by whoever looks addresses up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.net import ipv4_to_long
from ..operators.lookups import DEEP_BITS, overlapping_ranges, region_blocks
from ..schemas import REGION_BLOCK
from ..workspace import list_folders

EDITION, OCTET = "edition", "octet"


def publish_regions(ranges: DataFrame, path: str, edition: int) -> None:
    """Write one edition of the dictionary: its blocks, sorted into files by the first octet of the address.

    A reader that names octets skips the files and row groups of others by their statistics. Ranges that overlap are refused. Publishing an edition again replaces it; others stay for readers that noted them.
    """
    if (clash := overlapping_ranges(ranges).first()) is not None:
        raise ValueError(f"range {clash.ip_from}-{clash.ip_to} starts inside another one")
    first = F.when(F.col("level") == DEEP_BITS, F.shiftright("block", 16)).otherwise(F.shiftright("block", 8)).cast("int")
    blocks = region_blocks(ranges).withColumn(OCTET, first).withColumn(EDITION, F.lit(edition))
    sorted_blocks = blocks.repartitionByRange(OCTET, "block").sortWithinPartitions(OCTET, "block")
    sorted_blocks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EDITION).parquet(path)


def newest_edition(spark: SparkSession, path: str) -> int:
    editions = [int(name.partition("=")[2]) for name in list_folders(spark, path) if name.startswith(f"{EDITION}=")]
    if not editions:
        raise FileNotFoundError(f"no edition of a dictionary in {path}")
    return max(editions)


def read_regions(spark: SparkSession, path: str, edition: int, octets: list[int] | None = None) -> DataFrame:
    """Blocks of one edition, of the given first octets only; both reach the scan."""
    blocks = spark.read.schema(REGION_BLOCK).parquet(path).where(F.col(EDITION) == edition)
    if octets is not None:
        blocks = blocks.where(F.col(OCTET).isin(*octets) if octets else F.lit(False))
    return blocks.drop(EDITION, OCTET)


def octets_of(rows: DataFrame, ip: str = "ip") -> list[int]:
    """First octets of the readable addresses, 256 at most."""
    found = rows.select(F.shiftright(ipv4_to_long(ip), 24).cast("int").alias(OCTET)).where(f"{OCTET} IS NOT NULL").distinct()
    return sorted(r[0] for r in found.collect())
