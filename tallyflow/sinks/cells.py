"""Rows shaped for key-value, hash and document stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import order_row_key
from ..operators.parsing import non_blank, parse_payload
from ..schemas import ORDER

CELL_KEYS = ("row_key", "family", "qualifier")
FIELD_KEYS = ("key", "field")
ROW_FIELDS = 10_000  # fields that one wide row holds
# The columns kept for an order in the key-value table.
ORDER_COLUMNS = ("orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus", "province", "city")


def count_cells(counts: DataFrame, word: str = "word", count: str = "count", family: str = "info") -> DataFrame:
    """Cells of a word-count table: row key is the word, ``info:count`` the count as text."""
    return counts.select(
        F.col(word).alias("row_key"),
        F.lit(family).alias("family"),
        F.lit("count").alias("qualifier"),
        F.col(count).cast("string").alias("value"),
    )


def order_rows(records: DataFrame, value: str = "value", payload: bool = False) -> DataFrame:
    """Wide rows of the order table from JSON payloads, under the composed row key."""
    orders = parse_payload(non_blank(records, value), ORDER, value, payload)
    return orders.select(order_row_key().alias("row_key"), *ORDER_COLUMNS, *["payload"] * payload)


def hash_fields(rows: DataFrame, key: Column, field: Column, value: Column) -> DataFrame:
    """Hash entries (key, field, value) as text.

    A null field is stored as the text ``null``, the name a pivot gives it, so the entry is kept.
    """
    return rows.select(
        key.alias("key"),
        F.coalesce(field.cast("string"), F.lit("null")).alias("field"),
        value.cast("string").alias("value"),
    )


def wide_maps(fields: DataFrame, combine: Callable[[str], Column] = F.max, most: int = ROW_FIELDS) -> DataFrame:
    """Wide rows ``(key, part, fields)`` with a map from field to value in place of a column per field.

    Any number of fields fits: nothing looks for the distinct ones beforehand, and a key with more than ``most`` of them gets
    as many parts as keep about ``most`` in a row, each field in the part its hash names. Values of one field are combined
    first. A null field is named ``null``. Only keys above ``most`` are looked up, at most one per ``most`` entries.
    """
    named = fields.select("key", F.coalesce(F.col("field").cast("string"), F.lit("null")).alias("field"), "value")
    entries = named.groupBy("key", "field").agg(combine("value").alias("value"))
    sizes = named.groupBy("key").agg(F.count_distinct("field").alias("n")).where(F.col("n") > most)
    crowded = sizes.select(F.col("key").alias("_key"), F.ceil(F.col("n") / most).alias("_parts"))
    parts = entries.join(crowded, F.col("key").eqNullSafe(F.col("_key")), "left")
    part = F.pmod(F.xxhash64("field"), F.coalesce("_parts", F.lit(1))).cast("int").alias("part")
    held = F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value"))))
    return parts.groupBy("key", part).agg(held.alias("fields"))


def named_fields(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per key with a column for each named field, cut from the maps; null where the key lacks the field."""
    return rows.groupBy("key").agg(*[F.max(F.col("fields").getItem(name)).alias(name) for name in names])


def wide_hash(fields: DataFrame, fields_wanted: Sequence[str] | None = None) -> DataFrame:
    """One wide row per key: a column for each field wanted, or ``wide_maps`` where none is named.

    Stores are written field by field and widened on reading, because an update batch holds only
    the fields that changed and a wide row would lose the others.
    """
    if fields_wanted is None:
        return wide_maps(fields)
    return fields.groupBy("key").pivot("field", list(fields_wanted)).agg(F.max("value"))
