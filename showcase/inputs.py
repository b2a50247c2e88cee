"""Supplied tables reshaped into the records the reports take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions.net import long_to_ipv4

from .registry import load

SPAN = 4_294_967  # width of one address slot; a thousand slots cover the IPv4 space


def lines_of(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.select(F.col(text).alias("value"))


def money(column: str, precision: int = 18) -> Column:
    return F.col(column).cast(f"decimal({precision},2)")


def utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def ad_events(spark: SparkSession, folder: str) -> DataFrame:
    """Ad events from ``lineitem``; the flag columns are derived so that every measure varies."""
    flag = lambda condition: F.when(condition, 1).otherwise(0).cast("bigint")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return load(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("province"),
        F.col("l_linestatus").alias("city"),
        (1 + F.col("l_linenumber") % 3).cast("bigint").alias("requestmode"),
        (1 + F.col("l_quantity").cast("int") % 3).cast("bigint").alias("processnode"),
        (99998 + F.col("l_suppkey") % 10).alias("adplatformproviderid"),
        flag(part % 10 < 9).alias("iseffective"),
        flag(part % 7 != 0).alias("isbilling"),
        flag(order % 3 != 0).alias("isbid"),
        flag(order % 4 != 0).alias("iswin"),
        F.when(order % 11 == 0, F.lit(0)).otherwise(199999 + order % 5).cast("bigint").alias("adorderid"),
        (199999 + part % 5).alias("adcreativeid"),
        F.col("l_extendedprice").alias("winprice"),
        (F.col("l_extendedprice") / 2).alias("adpayment"),
        long_to_ipv4(address(order)).alias("ip"),
    )


AD_EVENTS_SQL = """
    SELECT l_returnflag AS province, l_linestatus AS city, 1 + l_linenumber % 3 AS requestmode,
           1 + CAST(l_quantity AS INT) % 3 AS processnode, 99998 + l_suppkey % 10 AS adplatformproviderid,
           CASE WHEN l_partkey % 10 < 9 THEN 1 ELSE 0 END AS iseffective,
           CASE WHEN l_partkey % 7 <> 0 THEN 1 ELSE 0 END AS isbilling,
           CASE WHEN l_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS isbid,
           CASE WHEN l_orderkey % 4 <> 0 THEN 1 ELSE 0 END AS iswin,
           CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE 199999 + l_orderkey % 5 END AS adorderid,
           199999 + l_partkey % 5 AS adcreativeid, l_extendedprice AS winprice, l_extendedprice / 2 AS adpayment,
           l_orderkey % 1000 * 4294967 + CASE WHEN l_orderkey % 1000 % 5 = 0 THEN (l_orderkey // 1000) % 150
                                              ELSE (l_orderkey * 7919) % 4294967 END AS ip_number
    FROM lineitem
"""


def address(identifier: Column) -> Column:
    """IPv4 number spread over the slots; every fifth slot is used at its start only."""
    slot = identifier % 1000
    offset = F.when(slot % 5 == 0, F.floor(identifier / 1000) % 150).otherwise((identifier * 7919) % SPAN)
    return slot * SPAN + offset


def ip_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Disjoint ranges named after nations: 40 per nation, with gaps, every fifth one 100 wide."""
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    slots = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "r_name", "n_name", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("step"), "n_nationkey"
    )
    slot = F.col("n_nationkey").cast("bigint") * 40 + F.col("step")
    width = F.when(slot % 5 == 0, F.lit(100)).otherwise(4_000_000 - (slot % 7) * 100_000)
    return slots.select(
        (slot * SPAN).alias("ip_from"),
        (slot * SPAN + width - 1).alias("ip_to"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("city"),
    )


IP_RANGES_SQL = """
    SELECT slot * 4294967 AS ip_from,
           slot * 4294967 + CASE WHEN slot % 5 = 0 THEN 100 ELSE 4000000 - (slot % 7) * 100000 END - 1 AS ip_to,
           r_name AS province, n_name AS city
    FROM (SELECT n_nationkey::BIGINT * 40 + step AS slot, n_name, r_name
          FROM nation JOIN region ON n_regionkey = r_regionkey, range(40) AS steps(step))
"""


def raw_orders(orders: DataFrame) -> DataFrame:
    """Topic records of the orders as they are produced: JSON with the address and a numeric status."""
    status = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("orderId"),
                F.col("o_custkey").cast("string").alias("userId"),
                order_time().alias("orderTime"),
                long_to_ipv4(address(F.col("o_orderkey"))).alias("ip"),
                F.col("o_totalprice").alias("orderMoney"),
                status.alias("orderStatus"),
            )
        ).alias("value"),
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """Topic records of the orders after cleaning, with priority and status as the region."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("orderId"),
                F.col("o_custkey").cast("string").alias("userId"),
                order_time().alias("orderTime"),
                long_to_ipv4(address(F.col("o_orderkey"))).alias("ip"),
                money("o_totalprice").cast("string").alias("orderMoney"),
                F.lit(0).alias("orderStatus"),
                F.col("o_orderpriority").alias("province"),
                F.col("o_orderstatus").alias("city"),
            )
        ).alias("value"),
    )


def order_time() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS")


ORDER_ADDRESS_SQL = """(
    o_orderkey % 1000 * 4294967 + CASE WHEN o_orderkey % 1000 % 5 = 0 THEN (o_orderkey // 1000) % 150
                                       ELSE (o_orderkey * 7919) % 4294967 END
)"""
ORDER_IP_SQL = f"""(
    {ORDER_ADDRESS_SQL} // 16777216 || '.' || {ORDER_ADDRESS_SQL} // 65536 % 256 || '.' || {ORDER_ADDRESS_SQL} // 256 % 256
    || '.' || {ORDER_ADDRESS_SQL} % 256
)"""
