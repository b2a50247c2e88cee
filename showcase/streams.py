"""Streaming reports, drained over everything available and read back from where they wrote."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyflow.operators.parsing import checked_times, explode_line_words, timed_words
from tallyflow.plans import calls, devices, orders, persons, sales, words
from tallyflow.schemas import PERSON
from tallyflow.session import setting
from tallyflow.sinks.cells import FIELD_KEYS, hash_fields
from tallyflow.sinks.files import write_text
from tallyflow.sinks.keyed import KeyedTable, keyed_table
from tallyflow.sinks.streams import batch_sink, keep_state_on_disk, keyed_sink, put_batch, read_rejects, split_sink, topic_sink
from tallyflow.sources import line_stream, parquet_stream, publish_regions, read_regions, separated_stream, topic_stream
from tallyflow.streaming.checkpoints import RETAIN, batch_files, batch_log
from tallyflow.streaming.late import read_late_rows, read_windows, windows_with_late_rows
from tallyflow.streaming.lifecycle import drain
from tallyflow.streaming.stateful import deduplicated_counts, first_per_key, flat_windows, windowed_counts
from tallyflow.workspace import is_folder, new_folder

from .inputs import IP_RANGES_SQL, ORDER_ADDRESS_SQL, ORDER_IP_SQL, clean_orders, ip_ranges, lines_of, money, order_time, raw_orders, utc
from .registry import ORACLE, load, query


def stream_of(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A supplied table, one file or a folder of files, read as a stream."""
    schema, path = load(spark, folder, table).schema, f"{folder}/{table}.parquet"
    if is_folder(spark, path):
        return parquet_stream(spark, path, schema)
    return parquet_stream(spark, folder, schema, f"{table}.parquet")


def topic_of(spark: SparkSession, label: str, records: DataFrame, max_files: int | None = None) -> DataFrame:
    """Records written to a topic folder and read from it as a stream."""
    path = new_folder(spark, label)
    records.write.parquet(path)
    return topic_stream(spark, path, file_format="parquet", max_files=max_files)


FILE_ROWS = 250_000  # records of a file that one task may have to read in one piece


def delivered(spark: SparkSession, label: str, records: DataFrame, times: int) -> DataFrame:
    """Records in a topic folder that arrives in at most ``times`` micro-batches.

    They are written where they are read, without a shuffle, in files of at most ``FILE_ROWS`` records: larger inputs have
    more files in a batch, not larger tasks.
    """
    path = new_folder(spark, label)
    most = min(FILE_ROWS, max(1, math.ceil(records.count() / times)))
    records.write.option("maxRecordsPerFile", most).parquet(path)
    files = len(spark.read.schema(records.schema).parquet(path).inputFiles())
    return topic_stream(spark, path, file_format="parquet", max_files=max(1, math.ceil(files / times)))


def collected(
    spark: SparkSession, label: str, rows: DataFrame, keys: tuple[str, ...], mode: str = "update", **options
) -> DataFrame:
    """Drain ``rows`` into a fresh latest-state table and return it."""
    path = new_folder(spark, label)
    table = keyed_table(spark, f"{path}/table", *keys)
    drain(keyed_sink(rows, table, f"{path}/checkpoint", mode, **options))
    return table.read()


TURN_WORDS = """
    SELECT word, count(*) AS count
    FROM (SELECT unnest(regexp_split_to_array(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '[ \\t\\n\\x0B\\f\\r]+')) AS word
          FROM conversations WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '')
    GROUP BY word
"""


def _turn_counts(spark: SparkSession, folder: str) -> DataFrame:
    return words.stream_word_counts(lines_of(stream_of(spark, folder, "conversations")))


@query("stream_word_count_update", TURN_WORDS)
def stream_word_count_update(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over text files, one line per line of a turn."""
    path = write_text(load(spark, folder, "conversations").select("text"), new_folder(spark, "turns"))
    counts = words.stream_word_counts(line_stream(spark, path))
    return collected(spark, "word-updates", counts, ("word",))


@query("stream_word_count_complete", TURN_WORDS)
def stream_word_count_complete(spark: SparkSession, folder: str) -> DataFrame:
    return collected(spark, "word-totals", _turn_counts(spark, folder), ("word",), "complete")


@query("stream_replace_rows", TURN_WORDS)
def stream_replace_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Word rows replaced by their key from within each micro-batch."""
    path = new_folder(spark, "word-rows")
    table = keyed_table(spark, f"{path}/table", "word")

    def replace(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, unique=True)

    drain(batch_sink(_turn_counts(spark, folder), f"{path}/checkpoint", replace))
    return table.read()


@query(
    "stream_word_hash",
    f"SELECT 'wordcount:spark' AS key, word AS field, CAST(count AS VARCHAR) AS value FROM ({TURN_WORDS})",
)
def stream_word_hash(spark: SparkSession, folder: str) -> DataFrame:
    counts = _turn_counts(spark, folder)
    return collected(
        spark, "word-hash", hash_fields(counts, F.lit("wordcount:spark"), F.col("word"), F.col("count")), FIELD_KEYS
    )


@query(
    "stream_csv_hobby",
    """SELECT c_mktsegment AS hobby, count(*) AS count FROM customer WHERE c_custkey % 50 < 25
    GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def stream_csv_hobby(spark: SparkSession, folder: str) -> DataFrame:
    source = new_folder(spark, "persons")
    people = load(spark, folder, "customer").select("c_name", (F.col("c_custkey") % 50).cast("int"), "c_mktsegment")
    people.write.option("sep", ";").csv(source)
    return collected(
        spark, "hobbies", persons.hobby_ranking(separated_stream(spark, source, PERSON)), ("hobby",), "complete"
    )


@query(
    "stream_success_etl",
    """SELECT 'station_' || event_id % 7 || ',' || user_id || ',' || event_id || ',' || event_type || ',1,2' AS value
    FROM events WHERE event_type = 'purchase' AND event_id % 5 <> 2""",
)
def stream_success_etl(spark: SparkSession, folder: str) -> DataFrame:
    """Call lines from all events, some of them a field short, filtered from topic to topic."""
    start = [
        F.concat(F.lit("station_"), F.col("event_id") % 7),
        F.col("user_id").cast("string"),
        F.col("event_id").cast("string"),
        F.col("event_type"),
        F.lit("1"),
    ]
    short = F.col("event_id") % 5 == 2
    line = F.when(short, F.concat_ws(",", *start)).otherwise(F.concat_ws(",", *start, F.lit("2")))
    records = load(spark, folder, "events").select(F.col("event_id").cast("string").alias("key"), line.alias("value"))
    path = new_folder(spark, "calls")
    passed = calls.calls_with_status(topic_of(spark, "call-topic", records), "purchase")
    drain(topic_sink(passed, f"{path}/checkpoint", f"{path}/topic", file_format="parquet"))
    return spark.read.parquet(f"{path}/topic").select("value")


DEVICE_SQL = """
    SELECT event_type AS device_type, count(*) AS count_device, round(avg(value), 2) AS avg_signal
    FROM events WHERE value > 30 GROUP BY event_type
"""


def _signals(spark: SparkSession, folder: str) -> DataFrame:
    payload = F.struct(
        F.concat(F.lit("device_"), "user_id").alias("device"),
        F.col("event_type").alias("deviceType"),
        F.col("value").alias("signal"),
        F.unix_millis(utc("ts")).alias("time"),
    )
    records = load(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("key"), F.to_json(payload).alias("value")
    )
    return devices.device_signals(topic_of(spark, "device-topic", records))


@query("stream_device_stats", DEVICE_SQL)
def stream_device_stats(spark: SparkSession, folder: str) -> DataFrame:
    return collected(spark, "devices", devices.device_stats(_signals(spark, folder)), ("device_type",), "complete")


@query("stream_device_stats_sql", DEVICE_SQL)
def stream_device_stats_sql(spark: SparkSession, folder: str) -> DataFrame:
    return collected(spark, "devices-sql", devices.device_stats_sql(_signals(spark, folder)), ("device_type",), "complete")


WINDOW_SQL = """
    SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, word, count(*) AS count
    FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(back) AS start,
                 unnest([event_type, 'u' || user_id % 10]) AS word
          FROM events, range(2) AS backs(back))
    GROUP BY start, word
"""


def _timed_lines(spark: SparkSession, folder: str, time_first: bool) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    said = F.concat("event_type", F.lit(" u"), F.col("user_id") % 10)
    parts = (stamp, said) if time_first else (said, stamp)
    return stream_of(spark, folder, "events").select(F.concat_ws(",", *parts).alias("value"))


def _window_report(spark: SparkSession, label: str, counts: DataFrame, mode: str) -> DataFrame:
    rows = collected(spark, label, flat_windows(counts), ("window_start", "word"), mode)
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "word", "count")


@query("stream_sliding_window", WINDOW_SQL)
def stream_sliding_window(spark: SparkSession, folder: str) -> DataFrame:
    timed = timed_words(_timed_lines(spark, folder, True))
    counts = windowed_counts(timed, length="2 hours", slide="1 hour")
    return _window_report(spark, "windows", counts, "complete")


@query("stream_watermark_update", WINDOW_SQL)
def stream_watermark_update(spark: SparkSession, folder: str) -> DataFrame:
    timed = timed_words(_timed_lines(spark, folder, False), time_first=False)
    counts = windowed_counts(timed, length="2 hours", slide="1 hour", watermark="10 minutes")
    return _window_report(spark, "watermarked", counts, "update")


ARRIVALS = 5  # eight days of events each; the last has only delayed ones


@query(
    "stream_late_windows",
    """
    WITH e AS (SELECT ts, event_type AS word, (day(ts) - 1) // 8 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS arrival FROM events),
    m AS (SELECT a.arrival, (SELECT max(epoch_ms(e.ts)) FROM e WHERE e.arrival < a.arrival) - 600000 AS mark
          FROM (SELECT DISTINCT arrival FROM e) a),
    s AS (SELECT word, mark, time_bucket(INTERVAL 1 HOUR, ts) - to_hours(back) AS start
          FROM e JOIN m USING (arrival), range(2) AS backs(back))
    SELECT CASE WHEN epoch_ms(start + INTERVAL 2 HOUR) <= mark THEN 'late' ELSE 'counted' END AS kind,
           strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, word, count(*) AS count
    FROM s GROUP BY 1, 2, 3
    """,
)
def stream_late_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive eight days at a time, every seventh one delivery later: counted windows, and late rows per window."""
    path = new_folder(spark, "late-windows")
    delayed = F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    events = load(spark, folder, "events").select(
        utc("ts").alias("time"), F.col("event_type").alias("word"), (F.floor((F.dayofmonth("ts") - 1) / 8) + delayed).alias("arrival")
    )
    counts, late = f"{path}/counts", f"{path}/late"
    for arrival in range(ARRIVALS):
        events.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(f"{path}/feed")
        timed = parquet_stream(spark, f"{path}/feed", "time timestamp, word string")
        drain(windows_with_late_rows(timed, counts, late, f"{path}/checkpoint", length="2 hours", slide="1 hour", watermark="10 minutes"))
    missed = read_late_rows(spark, late).groupBy("window_start", "word").count()
    kinds = {"counted": read_windows(spark, counts), "late": missed}
    found = [rows.select(F.lit(kind).alias("kind"), "window_start", "word", "count") for kind, rows in kinds.items()]
    return found[0].unionByName(found[1]).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def _keys(spark: SparkSession, folder: str) -> DataFrame:
    return stream_of(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type")


@query("stream_dedup", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    first = first_per_key(_keys(spark, folder), ["user_id", "event_type"])
    path = new_folder(spark, "firsts")
    keep_state_on_disk(spark)
    drain(first.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_dedup_count",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(1 AS BIGINT) AS count FROM events",
)
def stream_dedup_count(spark: SparkSession, folder: str) -> DataFrame:
    counts = deduplicated_counts(_keys(spark, folder), ["user_id", "event_type"])
    return collected(spark, "first-counts", counts, ("user_id", "event_type"), "complete")


@query(
    "stream_order_etl",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS key,
           '{{"orderId":"' || o_orderkey || '","userId":"' || o_custkey || '","orderTime":"'
           || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') || '","ip":"' || (n // 16777216) || '.'
           || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) || '","orderMoney":"' || o_totalprice
           || '","orderStatus":0' || coalesce(',"province":"' || province || '","city":"' || city || '"', '') || '}}'
           AS value
    FROM (SELECT *, {ORDER_ADDRESS_SQL} AS n FROM orders WHERE o_orderstatus = 'O')
    LEFT JOIN ({IP_RANGES_SQL}) ON n BETWEEN ip_from AND ip_to
    """,
)
def stream_order_etl(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "order-etl")
    topic = topic_of(spark, "raw-orders", raw_orders(load(spark, folder, "orders")))
    publish_regions(ip_ranges(spark, folder), f"{path}/regions", 1)
    cleaned = orders.enrich_orders(topic, read_regions(spark, f"{path}/regions", 1))
    drain(topic_sink(cleaned, f"{path}/checkpoint", f"{path}/topic", file_format="parquet"))
    return spark.read.parquet(f"{path}/topic")


@query("stream_order_etl_editions", ORACLE["stream_order_etl"])
def stream_order_etl_editions(spark: SparkSession, folder: str) -> DataFrame:
    """The same in micro-batches that read a published dictionary pruned to their addresses."""
    path = new_folder(spark, "order-editions")
    publish_regions(ip_ranges(spark, folder), f"{path}/regions", 1)
    topic = topic_of(spark, "raw-orders", raw_orders(load(spark, folder, "orders")))
    drain(orders.enrich_in_batches(topic, f"{path}/regions", f"{path}/topic", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/topic").select("key", "value")


def _order_topic(spark: SparkSession, folder: str) -> DataFrame:
    return topic_of(spark, "orders", clean_orders(load(spark, folder, "orders")))


def _order_store(
    spark: SparkSession, folder: str, key: str, write: Callable[[DataFrame, KeyedTable, str], DataStreamWriter], merge: str = "row"
) -> DataFrame:
    path = new_folder(spark, "order-store")
    table = keyed_table(spark, f"{path}/table", key, merge=merge)
    drain(write(_order_topic(spark, folder), table, f"{path}/checkpoint"))
    return table.read()


STORED_ORDERS = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS orderId, CAST(o_custkey AS VARCHAR) AS userId,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS orderMoney, o_orderpriority AS province,
           o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS orderTime, {ORDER_IP_SQL} AS ip,
           '0' AS orderStatus
    FROM orders
"""
ORDER_ROWS = f"""
    SELECT row_key, o.orderId AS orderId, o.userId AS userId, o.orderTime AS orderTime, o.ip AS ip, o.orderMoney AS orderMoney,
           o.orderStatus AS orderStatus, o.province AS province, o.city AS city
    FROM (SELECT reverse(userId) || '_' || orderTime AS row_key, max_by(o, orderId) AS o FROM ({{orders}}) AS o GROUP BY 1)
"""


@query("stream_order_documents", STORED_ORDERS)
def stream_order_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _order_store(spark, folder, "orderId", orders.index_orders, "field")


@query("stream_order_rows", ORDER_ROWS.format(orders=STORED_ORDERS))
def stream_order_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _order_store(spark, folder, "row_key", orders.put_orders)


BROKEN = "CAST(orderId AS BIGINT) % 7 = 3"


@query(
    "stream_order_rejects",
    f"""
    SELECT row_key, orderId, orderMoney, NULL AS payload FROM ({ORDER_ROWS.format(orders=f"SELECT * FROM ({STORED_ORDERS}) WHERE NOT {BROKEN}")})
    UNION ALL SELECT NULL, NULL, NULL, '{{"orderId":' || orderId || ',broken' FROM ({STORED_ORDERS}) WHERE {BROKEN}
    """,
)
def stream_order_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which every seventh payload is cut off: good ones are put, the others kept as they came."""
    path = new_folder(spark, "rejects")
    broken = F.col("key").cast("bigint") % 7 == 3
    cut = F.concat(F.lit('{"orderId":'), "key", F.lit(",broken"))
    records = clean_orders(load(spark, folder, "orders")).withColumn("value", F.when(broken, cut).otherwise(F.col("value")))
    table = keyed_table(spark, f"{path}/table", "row_key")
    drain(orders.put_orders(topic_of(spark, "some-broken", records), table, f"{path}/checkpoint", f"{path}/rejects"))
    good = table.read().select("row_key", "orderId", "orderMoney", F.lit(None).cast("string").alias("payload"))
    rejects = spark.read.parquet(f"{path}/rejects").select(
        *[F.lit(None).cast("string").alias(c) for c in ("row_key", "orderId", "orderMoney")], "payload"
    )
    return good.unionByName(rejects)


CITIES = ("F", "O")
MONEY_SQL = """
    SELECT o_orderpriority AS province, o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d') AS day,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS money
    FROM orders
"""


def totals_sql(kind: str, daily: bool) -> str:
    key = f"'orders:money:{kind}'" + (" || ':' || day" if daily else "")
    field = "'global'" if kind == "total" else kind
    scope = "WHERE city IN ('F', 'O')" if kind == "city" else ""
    return f"""
    SELECT {key} AS key, {field} AS field, CAST(sum(money) AS VARCHAR) AS value
    FROM ({MONEY_SQL}) {scope} GROUP BY 1, 2
    """


def _totals(kind: str, daily: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(spark, "totals")
        money = sales.order_money(_order_topic(spark, folder))
        table = keyed_table(spark, f"{path}/{kind}", *FIELD_KEYS)
        drain(*sales.totals_writers(money, {kind: table}, f"{path}/checkpoint", daily, key_cities=CITIES).values())
        return table.read()

    return run


for _kind in sales.KINDS:
    query(f"stream_amt_{_kind}", totals_sql(_kind, False))(_totals(_kind, False))
    query(f"stream_daily_amt_{_kind}", totals_sql(_kind, True))(_totals(_kind, True))


def _all_totals(daily: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(spark, "all-totals")
        table = keyed_table(spark, f"{path}/table", *FIELD_KEYS)
        money = sales.order_money(_order_topic(spark, folder))
        drain(sales.all_totals_writer(money, table, f"{path}/checkpoint", daily, CITIES))
        return table.read()

    return run


for _name, _daily in (("stream_amt_all", False), ("stream_daily_amt_all", True)):
    query(_name, " UNION ALL ".join(totals_sql(kind, _daily) for kind in sales.KINDS))(_all_totals(_daily))


_WRONG = {"payload": 13, "amount": 7, "time": 11}  # one order in so many is broken that way
_FAULT = "CASE " + " ".join(f"WHEN o_orderkey % {n} = 3 THEN '{name}'" for name, n in _WRONG.items()) + " END"


@query(
    "stream_amt_rejects",
    f"""
    WITH o AS (SELECT *, {_FAULT} AS fault FROM orders),
    sums AS (SELECT * FROM (
        {" UNION ALL ".join(totals_sql(kind, True) for kind in sales.KINDS).replace("FROM orders", "FROM o WHERE fault IS NULL")}))
    SELECT key, field, value, NULL AS reject_reason, NULL AS payload FROM sums
    UNION ALL
    SELECT NULL, NULL, NULL, fault, CASE WHEN fault = 'payload' THEN '{{"orderId' || o_orderkey ELSE
        '{{"orderId":"' || o_orderkey || '","orderTime":"'
        || CASE WHEN fault = 'time' THEN 'noon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') END || '","orderMoney":"'
        || CASE WHEN fault = 'amount' THEN '1,000.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END
        || '","province":"' || o_orderpriority || '","city":"' || o_orderstatus || '"}}' END
    FROM o WHERE fault IS NOT NULL
    """,
)
def stream_amt_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Day totals of orders of which some are broken in their payload, amount or time, and those orders with the reason."""
    path = new_folder(spark, "checked-totals")
    wrong = lambda name: F.coalesce(F.expr(_FAULT) == name, F.lit(False))
    payload = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("orderId"),
            F.when(wrong("time"), "noon").otherwise(order_time()).alias("orderTime"),
            F.when(wrong("amount"), "1,000.00").otherwise(money("o_totalprice").cast("string")).alias("orderMoney"),
            F.col("o_orderpriority").alias("province"),
            F.col("o_orderstatus").alias("city"),
        )
    )
    cut = F.concat(F.lit('{"orderId'), F.col("o_orderkey").cast("string"))
    records = load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), F.when(wrong("payload"), cut).otherwise(payload).alias("value")
    )
    topic = delivered(spark, "checked-orders", records, 4)
    drain(sales.batch_totals_writer(topic, f"{path}/sums", f"{path}/checkpoint", f"{path}/rejects", True, CITIES))
    totals = sales.batch_totals(spark, f"{path}/sums")
    return totals.unionByName(read_rejects(spark, f"{path}/rejects"), allowMissingColumns=True)


@query(
    "stream_time_rejects",
    """
    WITH l AS (SELECT event_type || ' u' || user_id % 10 AS said, ts, event_id % 9 = 4 AS late, event_id % 10 = 7 AS bare FROM events)
    SELECT strftime(ts, '%Y-%m-%d') AS day, word, count(*) AS count, NULL AS reject_reason
    FROM (SELECT ts, unnest(string_split(said, ' ')) AS word FROM l WHERE NOT late AND NOT bare) GROUP BY 1, 2
    UNION ALL SELECT NULL, NULL, count(*), CASE WHEN late THEN 'time' ELSE 'words' END FROM l WHERE late OR bare GROUP BY 4
    """,
)
def stream_time_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Words per day of timed lines, and the number of lines with an unreadable time or no words."""
    path = new_folder(spark, "checked-times")
    stamp = F.when(F.col("event_id") % 9 == 4, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    said = F.when(F.col("event_id") % 10 != 7, F.concat("event_type", F.lit(" u"), F.col("user_id") % 10))
    lines = stream_of(spark, folder, "events").select(F.concat_ws(",", stamp, said).alias("value"))

    def write(good: DataFrame, stream: str, batch_id: int) -> None:
        timed = explode_line_words(good, "words", ("time",))
        put_batch(timed.groupBy(F.date_format("time", "yyyy-MM-dd").alias("day"), "word").count(), f"{path}/words", stream, batch_id)

    drain(split_sink(checked_times(lines), f"{path}/checkpoint", f"{path}/rejects", write))
    counts = spark.read.parquet(f"{path}/words").groupBy("day", "word").agg(F.sum("count").alias("count"))
    rejects = read_rejects(spark, f"{path}/rejects").groupBy("reject_reason").count()
    return counts.unionByName(rejects, allowMissingColumns=True)


@query(
    "stream_daily_amt_bounded",
    totals_sql("province", True),
)
def stream_daily_amt_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Day totals whose days leave the state once the watermark has passed them."""
    path = new_folder(spark, "bounded-totals")
    table = keyed_table(spark, f"{path}/table", *FIELD_KEYS)
    money = sales.order_money(_order_topic(spark, folder))
    drain(*sales.totals_writers(money, {"province": table}, f"{path}/checkpoint", True, bounded=True).values())
    return table.read()


@query("stream_dedup_within", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events")
def stream_dedup_within(spark: SparkSession, folder: str) -> DataFrame:
    """First events per key, the keys forgotten when the watermark has passed their time; all files are one batch here."""
    path, timed_keys = new_folder(spark, "firsts-within"), ["user_id", "event_type"]
    keys = stream_of(spark, folder, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type", utc("ts").alias("ts"))
    first = first_per_key(keys, timed_keys, within=("ts", "1 hour"))
    keep_state_on_disk(spark)
    drain(first.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows").select(*timed_keys)


AUDITED = 104  # files of the audited stream, one a batch


@query(
    "stream_batch_audit",
    f"""
    SELECT CAST(user_id % {AUDITED} AS INTEGER) AS part, CAST(1 AS BIGINT) AS batches, CAST(1 AS BIGINT) AS committed, count(*) AS rows
    FROM events GROUP BY 1
    """,
)
def stream_batch_audit(spark: SparkSession, folder: str) -> DataFrame:
    """For every file of a drained stream the batches that read it and how many of them are committed, from the checkpoint."""
    path = new_folder(spark, "audited")
    events = load(spark, folder, "events").select("event_id", (F.col("user_id") % AUDITED).cast("int").alias("part"))
    events.repartition("part").write.partitionBy("part").parquet(f"{path}/in")
    source = parquet_stream(spark, f"{path}/in", load(spark, folder, "events").select("event_id").schema, max_files=1)
    with setting(spark, RETAIN, "10000"):
        drain(source.writeStream.format("noop").option("checkpointLocation", f"{path}/checkpoint"))
    part = F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int").alias("part")
    log = batch_files(spark, f"{path}/checkpoint").join(batch_log(spark, f"{path}/checkpoint"), "batch", "left")
    seen = log.groupBy(part).agg(F.countDistinct("batch").alias("batches"), F.count_if("committed").alias("committed"))
    return seen.join(events.groupBy("part").agg(F.count(F.lit(1)).alias("rows")), "part")


@query("stream_amt_separate", " UNION ALL ".join(totals_sql(kind, False) for kind in sales.KINDS))
def stream_amt_separate(spark: SparkSession, folder: str) -> DataFrame:
    """The three running totals as three queries on one stream."""
    path = new_folder(spark, "separate-totals")
    money = sales.order_money(_order_topic(spark, folder))
    tables = {kind: keyed_table(spark, f"{path}/{kind}", *FIELD_KEYS) for kind in sales.KINDS}
    drain(*sales.totals_writers(money, tables, f"{path}/checkpoint", key_cities=CITIES).values())
    merged = tables["total"].read()
    for kind in sales.KINDS[1:]:
        merged = merged.unionByName(tables[kind].read())
    return merged
