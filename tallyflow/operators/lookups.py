"""Lookups: IP address to region, and membership in a list of cities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.net import ipv4_to_long
from ..functions.text import trimmed_fields
from ..workspace import new_folder

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
SALTS = 32
REGION_NAMES = ("province", "city")
TOP_BITS, DEEP_BITS, DEEP = 16, 24, 256  # a /16 block with more than 256 pieces is cut into /24 blocks
HOT_ROWS, HOT_BLOCKS = 2_000_000, 200


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``table`` stays within both bounds. Every task counts its own rows and hands on one."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema.fields if f.dataType == StringType()]
    width = sum(texts, F.lit(16 * len(table.columns)).cast("bigint"))
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size.rows <= max_rows and (size.bytes or 0) <= max_bytes


def partition_salt(salts: int = SALTS) -> Column:
    """Part of a key a row belongs to, taken from the task that reads it.

    A hot key, even one made of identical copies, is read by many tasks and so falls into many
    parts; and a task that is run again gives its rows the same part, which a random one may not.
    """
    return F.spark_partition_id() % salts


def parse_ranges(lines: DataFrame, value: str = "value", rejected: Observation | None = None) -> DataFrame:
    """Ranges from ``first ip|last ip|country|0|province|city|provider`` lines.

    Lines whose region text has not exactly five parts, and ranges that end before they begin, are
    left out; their addresses get nulls. ``rejected`` observes how many lines were read and kept.
    """
    parts = lines.select(trimmed_fields(value, "|").alias("parts"))
    ranges = parts.select(
        F.size("parts").alias("size"),
        ipv4_to_long(F.get("parts", F.lit(0))).alias("ip_from"),
        ipv4_to_long(F.get("parts", F.lit(1))).alias("ip_to"),
        F.get("parts", F.lit(4)).alias("province"),
        F.get("parts", F.lit(5)).alias("city"),
    )
    good = F.coalesce((F.col("size") == 7) & (F.col("ip_from") <= F.col("ip_to")), F.lit(False))
    if rejected is not None:
        ranges = ranges.observe(rejected, F.count(F.lit(1)).alias("lines"), F.count_if(good).alias("kept"))
    return ranges.where(good).drop("size")


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that start inside another range; the lookup needs this to be empty.

    Ranges are cut at /16 blocks and reduced to one row per starting address, so a task holds at
    most 65,536 rows of a block whatever the input repeats.
    """
    first, last = _blocks(16)
    pieces = ranges.select("ip_from", "ip_to", F.explode(F.sequence(first, last)).alias("block"))
    starts = pieces.groupBy("block", F.greatest("ip_from", F.shiftleft("block", 16)).alias("start")).agg(
        F.count(F.lit(1)).alias("ranges"),
        F.max("ip_to").alias("reach"),
        F.max(F.struct("ip_from", "ip_to")).alias("latest"),
    )
    before = Window.partitionBy("block").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        starts.withColumn("reached", F.max("reach").over(before))
        .where((F.col("ranges") > 1) | (F.col("start") <= F.col("reached")))
        .select("latest.*")
        .distinct()
    )


def region_blocks(ranges: DataFrame, names: tuple[str, ...] = REGION_NAMES) -> DataFrame:
    """The dictionary cut for an equi-join: ``(level, block, piece_from, piece_to)`` and ``names``.

    Ranges are cut at /16 blocks. A block with more than 256 pieces is deep: its pieces are cut again at /24 blocks, of
    which disjoint ranges leave at most 256 pieces each. So every address belongs to one block, with a bounded number of
    candidates, and cutting adds at most 65,536 rows and one row per piece of a deep block.
    """
    wide = _cut(ranges, 16, names)
    crowd = F.count(F.lit(1)).over(Window.partitionBy("block"))
    levels = wide.withColumn("level", F.when(crowd > DEEP, DEEP_BITS).otherwise(TOP_BITS))
    top = levels.where(F.col("level") == TOP_BITS)
    deep = levels.where(F.col("level") == DEEP_BITS).select(F.col("piece_from").alias("ip_from"), F.col("piece_to").alias("ip_to"), *names)
    columns = ("level", "block", "piece_from", "piece_to", *names)
    return top.select(*columns).unionByName(_cut(deep, 24, names).withColumn("level", F.lit(DEEP_BITS)).select(*columns))


def _cut(ranges: DataFrame, bits: int, names: tuple[str, ...]) -> DataFrame:
    size = 32 - bits
    pieces = ranges.select("*", F.explode(F.sequence(*_blocks(bits))).alias("block"))
    first = F.shiftleft("block", size)
    return pieces.select(
        "block", F.greatest("ip_from", first).alias("piece_from"), F.least("ip_to", first + ((1 << size) - 1)).alias("piece_to"), *names
    )


def locate_in_blocks(
    rows: DataFrame,
    blocks: DataFrame,
    ip: str = "ip",
    names: tuple[str, ...] = REGION_NAMES,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join each row to the piece of a cut dictionary that holds its IPv4 address, by one join on the block.

    The deep /16 blocks, 65,536 at most, are broadcast, so a row knows the one block it belongs to. Up to
    ``broadcast_rows`` pieces are broadcast too and ``rows`` is not shuffled. Beyond that both sides are shuffled once by
    block. Rows of each block are counted first; blocks above ``hot_rows`` and above one ``HOT_BLOCKS``-th of all rows,
    so fewer than ``HOT_BLOCKS``, are dealt over several parts and only their pieces are repeated. Rows without a readable
    address take no part in counting or join and are put back with nulls. An address in no range gets nulls.
    """
    small = fits_broadcast(blocks, broadcast_rows)
    deep = blocks.where(F.col("level") == DEEP_BITS).select(F.shiftright("block", 8).alias("_deep")).distinct()
    numbered = rows.withColumn("_ip", ipv4_to_long(ip))
    apart = not small and not rows.isStreaming
    known = numbered.where("_ip IS NOT NULL") if apart else numbered
    known = known.join(F.broadcast(deep), F.shiftright("_ip", 16) == F.col("_deep"), "left")
    level = F.when(F.col("_deep").isNull(), TOP_BITS).otherwise(DEEP_BITS)
    placed = known.withColumns({"_level": level, "_block": F.when(F.col("_deep").isNull(), F.shiftright("_ip", 16)).otherwise(F.shiftright("_ip", 8))})
    pieces = blocks.select("level", "block", "piece_from", "piece_to", F.struct(*names).alias("_region"))
    match = (F.col("_level") == F.col("level")) & (F.col("_block") == F.col("block")) & F.col("_ip").between(F.col("piece_from"), F.col("piece_to"))
    if small:
        pieces = F.broadcast(pieces)
    else:
        if apart and (hot := hot_blocks(placed, hot_rows)):
            parts = rows.sparkSession.createDataFrame(hot, "hot_level int, hot_block bigint, parts int")
            mine = (F.col("_level") == F.col("hot_level")) & (F.col("_block") == F.col("hot_block"))
            placed = placed.join(F.broadcast(parts), mine, "left").withColumn("_part", F.spark_partition_id() % F.coalesce("parts", F.lit(1)))
            theirs = (F.col("level") == F.col("hot_level")) & (F.col("block") == F.col("hot_block"))
            repeats = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
            pieces = pieces.join(F.broadcast(parts), theirs, "left").withColumn("part", repeats).drop("hot_level", "hot_block", "parts")
            match = match & (F.col("_part") == F.col("part"))
        # its size is past the bound, whatever the optimiser estimates
        pieces = pieces.hint("merge")
    found = placed.join(pieces, match, "left").select(*rows.columns, *[F.col("_region")[name].alias(name) for name in names])
    if not apart:
        return found
    none = numbered.where("_ip IS NULL").select(*rows.columns, *[F.lit(None).cast(blocks.schema[name].dataType).alias(name) for name in names])
    return found.unionByName(none)


def hot_blocks(placed: DataFrame, hot_rows: int = HOT_ROWS) -> list[tuple[int, int, int]]:
    """``(level, block, parts)`` of the blocks that hold too many rows for one task.

    The rows are counted within their tasks first. Fewer than ``HOT_BLOCKS`` blocks can qualify, so the answer is small.
    """
    seen = Observation()
    counted = placed.select("_level", "_block").observe(seen, F.count(F.lit(1)).alias("rows"))
    most = counted.groupBy("_level", "_block").count().orderBy(F.desc("count")).limit(HOT_BLOCKS).collect()
    bound = max(hot_rows, seen.get["rows"] // HOT_BLOCKS) if most else 0
    return [(r["_level"], r["_block"], -(-r["count"] // bound)) for r in most if r["count"] > bound]


def locate_ips(
    rows: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    names: tuple[str, ...] = REGION_NAMES,
    broadcast_rows: int = BROADCAST_ROWS,
    disjoint: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join each row to the one range that holds its IPv4 address.

    ``ranges`` has ``ip_from``, ``ip_to`` and ``names``. Overlapping ranges would repeat rows and are refused;
    ``disjoint`` states that the caller has checked that. A dictionary that is cut into blocks already is taken as it is.
    See ``region_blocks`` and ``locate_in_blocks`` for the way.
    """
    if "piece_from" in ranges.columns:
        return locate_in_blocks(rows, ranges, ip, names, broadcast_rows, hot_rows)
    if not disjoint and (clash := overlapping_ranges(ranges).first()) is not None:
        raise ValueError(f"range {clash.ip_from}-{clash.ip_to} starts inside another one")
    folder = new_folder(rows.sparkSession, "blocks")
    region_blocks(ranges, names).write.parquet(folder)  # cut once, also for a stream, and read by each use
    return locate_in_blocks(rows, rows.sparkSession.read.parquet(folder), ip, names, broadcast_rows, hot_rows)


def _blocks(bits: int):
    return F.shiftright("ip_from", 32 - bits), F.shiftright("ip_to", 32 - bits)


def keep_listed(rows: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Keep rows whose ``column`` is in a short list; nulls go."""
    return rows.where(F.col(column).isin(*values))


def keep_in_table(
    rows: DataFrame, column: str, table: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The same filter against a one-column table, broadcast only when its counted size allows."""
    values = table.select(F.col(table.columns[0]).alias(column))
    if fits_broadcast(values, broadcast_rows):
        values = F.broadcast(values)
    return rows.join(values, column, "left_semi")
