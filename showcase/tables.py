"""Partitioned tables, latest-state tables and key-value shapes."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.plans import ads
from tallyflow.plans.orders import order_documents
from tallyflow.plans.words import word_counts
from tallyflow.sinks import tables
from tallyflow.sinks.cells import CELL_KEYS, ORDER_COLUMNS, count_cells, order_rows
from tallyflow.sinks.files import write_partitions
from tallyflow.sinks.keyed import keyed_table
from tallyflow.sources import cells_of, read_day, read_table
from tallyflow.workspace import new_folder

from .batch import DOCUMENT_WORDS, kpi_sql
from .inputs import ORDER_IP_SQL, AD_EVENTS_SQL, IP_RANGES_SQL, ad_events, clean_orders, ip_ranges, lines_of, money
from .registry import AS_OF, load, query


def _monthly_orders(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        money("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


def _per_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").cast("double").alias("total_price")
    )


def _table_name(label: str) -> str:
    return f"{label}_{uuid4().hex}"


def month_sql(rows: str) -> str:
    return f"""
    SELECT month, count(*) AS orders, CAST(sum(cents) AS DOUBLE) / 100 AS total_price
    FROM ({rows}) GROUP BY month
    """


MONTHLY = """
    SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders
"""
OPEN_ONLY = f"{MONTHLY} WHERE o_orderstatus = 'O' OR strftime(o_orderdate, '%Y') <> '1997'"


@query("partition_overwrite", month_sql(OPEN_ONLY))
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """All months written, then the months of 1997 replaced twice by their open orders."""
    orders, path = _monthly_orders(spark, folder), new_folder(spark, "months")
    write_partitions(orders, path, "month")
    revised = orders.where((F.col("o_orderstatus") == "O") & F.col("month").startswith("1997-"))
    for _ in range(2):
        write_partitions(revised, path, "month")
    return _per_month(spark.read.parquet(path))


@query("partition_replace_table", month_sql(OPEN_ONLY))
def partition_replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a declared catalog table."""
    orders, name = _monthly_orders(spark, folder), _table_name("replaced_orders")
    tables.create_table(spark, name, orders.schema, "month", new_folder(spark, name))
    tables.replace_partitions(orders, name, "month")
    revised = orders.where((F.col("o_orderstatus") == "O") & F.col("month").startswith("1997-"))
    for _ in range(2):
        tables.replace_partitions(revised, name, "month")
    return _per_month(read_table(spark, name))


@query("partition_append", month_sql(f"{MONTHLY} UNION ALL {MONTHLY} WHERE o_orderstatus = 'F'"))
def partition_append(spark: SparkSession, folder: str) -> DataFrame:
    """Appending finished orders again counts them twice."""
    orders, name = _monthly_orders(spark, folder), _table_name("appended_orders")
    path = new_folder(spark, name)
    tables.append_partitions(orders, name, "month", path)
    tables.append_partitions(orders.where("o_orderstatus = 'F'"), name, "month", path)
    return _per_month(read_table(spark, name))


@query("partition_drop", month_sql(f"{MONTHLY} WHERE strftime(o_orderdate, '%Y-%m') <> '1997-03'"))
def partition_drop(spark: SparkSession, folder: str) -> DataFrame:
    orders, database = _monthly_orders(spark, folder), _table_name("dropping")
    tables.create_database(spark, database, new_folder(spark, database))
    name = f"{database}.orders"
    tables.create_table(spark, name, orders.schema, "month")
    tables.replace_partitions(orders, name, "month")
    tables.drop_partition(spark, name, "month", "1997-03")
    return _per_month(read_table(spark, name))


@query(
    "pruned_scan",
    """SELECT o_orderkey, o_orderstatus, '1998-10-01' AS date_str FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = '1998-10'""",
)
def pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Partitions by the first day of the month, of which the scan opens the one before the run day."""
    first_day = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("date_str")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", first_day)
    name = _table_name("dated_orders")
    tables.append_partitions(orders, name, path=new_folder(spark, name))
    return read_day(spark, name, date(1998, 10, 2))


EXTRACT_SQL = f"""
    SELECT e.* EXCLUDE (province, city), coalesce(r.province, 'unknown') AS province, coalesce(r.city, 'unknown') AS city
    FROM ({AD_EVENTS_SQL}) e LEFT JOIN ({IP_RANGES_SQL}) r ON ip_number BETWEEN ip_from AND ip_to
"""


@query("ads_extract_and_report", kpi_sql(True, EXTRACT_SQL))
def ads_extract_and_report(spark: SparkSession, folder: str) -> DataFrame:
    """Daily extract into a partitioned table, then the KPI report of that day into a keyed table.

    Events whose address is in no range are reported under an unknown region.
    """
    name = _table_name("ad_events")
    extract = ads.daily_extract(ad_events(spark, folder).drop("province", "city"), ip_ranges(spark, folder), AS_OF)
    tables.append_partitions(extract, name, path=new_folder(spark, name), one_value=True)
    report = ads.region_kpis(ads.known_regions(read_day(spark, name, AS_OF)), as_of=AS_OF)
    kpis = keyed_table(spark, new_folder(spark, "kpis"), *tables.REGION_KPIS.keys)
    ads.store_region_kpis(report, kpis)
    return kpis.read()


@query(
    "upsert_table",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'changed' ELSE o_orderstatus END AS status,
           o_totalprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS price
    FROM orders
    UNION ALL
    SELECT -1 - o_orderkey, 'new', o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'
    """,
)
def upsert_table(spark: SparkSession, folder: str) -> DataFrame:
    """All orders, then updates of the urgent ones and new keys, these put twice."""
    orders = load(spark, folder, "orders")
    table = keyed_table(spark, new_folder(spark, "orders"), "o_orderkey")
    table.upsert(orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")), 0, unique=True)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.where(urgent).select(
        "o_orderkey", F.lit("changed").alias("status"), (F.col("o_totalprice") * 2).alias("price")
    )
    fresh = orders.where(F.col("o_orderpriority") == "5-LOW").select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("new").alias("status"), F.col("o_totalprice").alias("price")
    )
    for _ in range(2):  # the second time is a replay
        table.upsert(changed, 1, unique=True)
        table.upsert(fresh, 2, unique=True)
    return table.read()


@query(
    "kv_put_cells",
    f"""SELECT word AS row_key, 'info' AS family, 'count' AS qualifier, CAST(count(*) AS VARCHAR) AS value
    FROM ({DOCUMENT_WORDS}) GROUP BY word""",
)
def kv_put_cells(spark: SparkSession, folder: str) -> DataFrame:
    cells = count_cells(word_counts(lines_of(load(spark, folder, "documents"))))
    table = keyed_table(spark, new_folder(spark, "word-cells"), *CELL_KEYS)
    table.upsert(cells, unique=True)
    return table.read()


ORDER_TEXT = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS orderId, CAST(o_custkey AS VARCHAR) AS userId,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS orderTime,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS orderMoney, '0' AS orderStatus,
           {ORDER_IP_SQL} AS ip, o_orderpriority AS province, o_orderstatus AS city
    FROM orders
"""
WIDE_ORDERS = f"""
    SELECT reverse(userId) || '_' || orderTime AS row_key, max_by(o, orderId) AS o
    FROM ({ORDER_TEXT}) AS o GROUP BY 1
"""


@query(
    "kv_scan_cells",
    f"""
    SELECT row_key, 'info' AS family, qualifier, CAST(0 AS BIGINT) AS version, value
    FROM (SELECT row_key, o.orderId, o.userId, o.orderTime, o.orderMoney, o.orderStatus, o.ip, o.province, o.city
          FROM ({WIDE_ORDERS}))
    UNPIVOT (value FOR qualifier IN (orderId, userId, orderTime, orderMoney, orderStatus, ip, province, city))
    """,
)
def kv_scan_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Orders put under their row key, the newest order id winning a shared key, and read as cells."""
    table = keyed_table(spark, new_folder(spark, "order-rows"), "row_key")
    table.upsert(order_rows(clean_orders(load(spark, folder, "orders"))), order_by="orderId")
    return cells_of(table.read(), "row_key", list(ORDER_COLUMNS))


@query("doc_upsert", ORDER_TEXT.replace("o_orderstatus AS city", "coalesce(nullif(o_orderstatus, 'P'), 'seen') AS city"))
def doc_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Order documents indexed by id, pending ones indexed again with a changed field."""
    documents = order_documents(clean_orders(load(spark, folder, "orders")))
    table = keyed_table(spark, new_folder(spark, "order-documents"), "orderId")
    table.upsert(documents, order_by="orderTime")
    table.upsert(documents.where("city = 'P'").withColumn("city", F.lit("seen")), order_by="orderTime")
    return table.read()


@query(
    "doc_merge_fields",
    f"""
    SELECT orderId, userId, CASE WHEN CAST(orderId AS BIGINT) % 3 = 1 THEN NULL ELSE orderTime END AS orderTime, ip,
           CASE WHEN CAST(orderId AS BIGINT) % 2 = 0 THEN orderMoney || '1' ELSE orderMoney END AS orderMoney, orderStatus,
           province, CASE WHEN city = 'P' THEN 'seen' ELSE city END AS city
    FROM ({ORDER_TEXT})
    """,
)
def doc_merge_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Order documents, some without a time, then partial ones that change single fields of them."""
    documents = order_documents(clean_orders(load(spark, folder, "orders")))
    number = F.col("orderId").cast("bigint")
    full = documents.withColumn("orderTime", F.when(number % 3 != 1, F.col("orderTime")))
    empty = lambda *kept: [F.col(c) if c in kept else F.lit(None).cast("string").alias(c) for c in documents.columns]
    prices = full.where(number % 2 == 0).withColumn("orderMoney", F.concat("orderMoney", F.lit("1"))).select(*empty("orderId", "orderMoney"))
    seen = full.where("city = 'P'").withColumn("city", F.lit("seen")).select(*empty("orderId", "city"))
    table = keyed_table(spark, new_folder(spark, "merged-documents"), "orderId", merge="field")
    table.upsert(full, order_by="orderTime")
    table.upsert(prices.unionByName(seen), order_by="orderTime")
    return table.read()
