"""Running and daily sales totals over enriched orders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.keys import dated_key
from ..operators.aggregates import sum_by
from ..operators.lookups import keep_listed
from ..operators.parsing import has_fields, parse_payload
from ..operators.rejects import PAYLOAD, with_reason
from ..schemas import ORDER
from ..settings import KEY_CITIES
from ..sinks.cells import hash_fields
from ..sinks.keyed import KeyedTable
from ..sinks.streams import keyed_sink, put_batch, split_sink

MONEY = "decimal(18,2)"
KINDS = ("total", "province", "city")
PREFIX = "orders:money"


def order_money(records: DataFrame) -> DataFrame:
    """Day, time, amount and region of each order. Amounts are decimals, so sums are exact."""
    orders = parse_payload(has_fields(records), ORDER)
    return orders.select(
        F.col("orderTime").try_cast("date").alias("order_date"),
        F.col("orderTime").try_cast("timestamp").alias("order_timestamp"),
        F.col("orderMoney").try_cast(MONEY).alias("money"),
        "province",
        "city",
    )


def checked_orders(records: DataFrame, dated: bool = True) -> DataFrame:
    """The columns of ``order_money`` beside the record as it came and the reason it can't be summed.

    Reasons: ``payload`` is no JSON object with an order id, the ``amount`` is missing or no number, and, for ``dated``
    reports, the ``time``. Records of delimiters only are no orders and are left out as in ``order_money``.
    """
    orders = parse_payload(has_fields(records), ORDER, payload=True)
    read = orders.select(
        F.col("orderTime").try_cast("date").alias("order_date"),
        F.col("orderTime").try_cast("timestamp").alias("order_timestamp"),
        F.col("orderMoney").try_cast(MONEY).alias("money"),
        "province",
        "city",
        "orderId",
        PAYLOAD,
    )
    faults = {"payload": F.col("orderId").isNull(), "amount": F.col("money").isNull(), "time": F.lit(dated) & F.col("order_date").isNull()}
    return with_reason(read, faults).drop("orderId")


def _scope(orders: DataFrame, kind: str, key_cities: Iterable[str]) -> tuple[DataFrame, list[str]]:
    if kind == "total":
        return orders, []
    return (keep_listed(orders, "city", key_cities) if kind == "city" else orders), [kind]


def running_totals(orders: DataFrame, kind: str, key_cities: Iterable[str] = KEY_CITIES) -> DataFrame:
    """Sales so far, over everything or per province or key city."""
    rows, keys = _scope(orders, kind, key_cities)
    return sum_by(rows, "money", *keys, name="total_amt")


def running_fields(totals: DataFrame, kind: str) -> DataFrame:
    """Hash entries of the running totals, under the key ``orders:money:<kind>``."""
    field = F.lit("global") if kind == "total" else F.col(kind)
    return hash_fields(totals, F.lit(f"{PREFIX}:{kind}"), field, F.col("total_amt"))


def daily_totals(
    orders: DataFrame,
    kind: str,
    key_cities: Iterable[str] = KEY_CITIES,
    watermark: str = "10 minutes",
    bounded: bool = False,
) -> DataFrame:
    """Hash entries of sales per day.

    Grouping by the plain day keeps every day in state and counts late orders however late, as the
    report is defined. ``bounded`` groups by a one-day event-time window instead: a day is closed
    once the watermark passes its end, later orders for it are dropped and its state is freed.
    """
    rows, keys = _scope(orders, kind, key_cities)
    rows = rows.withWatermark("order_timestamp", watermark)
    if bounded:
        sums = sum_by(rows, "money", F.window("order_timestamp", "1 day").alias("day"), *keys, name="total_amt")
        sums = sums.withColumn("order_date", F.to_date("day.start"))
    else:
        sums = sum_by(rows, "money", "order_date", *keys, name="total_amt")
    field = F.lit("global") if kind == "total" else F.col(kind)
    day = F.col("order_date").cast("string")
    return hash_fields(sums, dated_key(f"{PREFIX}:{kind}", day), field, F.col("total_amt"))


def totals_writers(
    orders: DataFrame, tables: dict[str, KeyedTable], checkpoint: str, daily: bool = False, **options
) -> dict[str, DataStreamWriter]:
    """One update-mode query per kind in ``tables``, each with its own checkpoint."""
    writers = {}
    for kind, table in tables.items():
        fields = daily_totals(orders, kind, **options) if daily else running_fields(
            running_totals(orders, kind, **options), kind
        )
        writers[kind] = keyed_sink(fields, table, f"{checkpoint}/{kind}", "update")
    return writers


def total_entries(orders: DataFrame, daily: bool = False, key_cities: Iterable[str] = KEY_CITIES) -> DataFrame:
    """Hash entries of all three totals from one aggregation.

    Each order names the entries it belongs to, so the records are read and parsed once, and there
    is one state, one sink and one checkpoint where ``totals_writers`` has three of each. Days stay
    in state for ever, as late orders count however late; orders without a day are summed as ``unknown``.
    """
    sums = entry_sums(orders, daily, key_cities)
    return hash_fields(sums, F.col("key"), F.col("field"), F.col("total_amt"))


def entry_sums(orders: DataFrame, daily: bool = False, key_cities: Iterable[str] = KEY_CITIES) -> DataFrame:
    """``(key, field, total_amt)`` of the entries that orders belong to."""

    def entry(kind: str, field: Column) -> Column:
        key = dated_key(f"{PREFIX}:{kind}", F.col("order_date").cast("string")) if daily else F.lit(f"{PREFIX}:{kind}")
        return F.struct(key.alias("key"), F.coalesce(field, F.lit("null")).alias("field"))

    both = F.array(entry("total", F.lit("global")), entry("province", F.col("province")))
    entries = F.when(F.col("city").isin(*key_cities), F.concat(both, F.array(entry("city", F.col("city"))))).otherwise(both)
    sums = sum_by(orders.select("money", F.explode(entries).alias("entry")), "money", "entry", name="total_amt")
    return sums.select("entry.key", "entry.field", "total_amt")


def all_totals_writer(
    orders: DataFrame, table: KeyedTable, checkpoint: str, daily: bool = False, key_cities: Iterable[str] = KEY_CITIES
) -> DataStreamWriter:
    """The three kinds of totals as one update-mode query into one table."""
    return keyed_sink(total_entries(orders, daily, key_cities), table, checkpoint, "update")


def batch_totals_writer(
    records: DataFrame, path: str, checkpoint: str, rejects: str, daily: bool = False, key_cities: Iterable[str] = KEY_CITIES
) -> DataStreamWriter:
    """Totals without streaming state: every micro-batch adds its own sums, and its rejects, as a partition.

    Sums of sums are sums, so reading adds the partitions up; a batch that runs again replaces what it added. Orders count
    however late, no day stays in memory, and every record is either in the sums or among the rejects.
    """

    def write(good: DataFrame, stream: str, batch_id: int) -> None:
        put_batch(entry_sums(good, daily, key_cities), path, stream, batch_id)

    return split_sink(checked_orders(records, daily), checkpoint, rejects, write)


def batch_totals(spark: SparkSession, path: str) -> DataFrame:
    """Hash entries of what ``batch_totals_writer`` has added so far."""
    sums = spark.read.parquet(path).groupBy("key", "field").agg(F.sum("total_amt").alias("total_amt"))
    return hash_fields(sums, F.col("key"), F.col("field"), F.col("total_amt"))
