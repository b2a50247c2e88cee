"""Batch reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions.net import ipv4_to_long, long_to_ipv4
from tallyflow.functions.text import script_runs
from tallyflow.operators.aggregates import count_by, mean_by, mean_by_sql, pivot_sum
from tallyflow.operators import terms
from tallyflow.operators.lookups import keep_listed, locate_ips
from tallyflow.operators.parsing import explode_words
from tallyflow.plans import ads, ratings, search, words
from tallyflow.sinks.cells import hash_fields, named_fields, wide_hash, wide_maps
from tallyflow.sinks.files import write_text
from tallyflow.sources import literal_rows, read_json, read_lines
from tallyflow.workspace import new_folder

from .inputs import AD_EVENTS_SQL, IP_RANGES_SQL, ad_events, address, ip_ranges, lines_of, money
from .registry import AS_OF, load, query

# words of an untrimmed line: trailing space goes, a leading empty word stays
WORDS_SQL = """
    unnest(CASE WHEN line = '' THEN ['']
                WHEN rtrim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN []
                ELSE regexp_split_to_array(rtrim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                           '[ \\t\\n\\x0B\\f\\r]+') END)
"""
DOCUMENT_WORDS = f"SELECT {WORDS_SQL} AS word FROM (SELECT text AS line FROM documents)"


def document_counts(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(lines_of(load(spark, folder, "documents")))


@query("word_count", f"SELECT word, count(*) AS count FROM ({DOCUMENT_WORDS}) GROUP BY word")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return document_counts(spark, folder)


@query(
    "word_count_text_roundtrip",
    f"""
    SELECT word, count(*) AS count
    FROM (SELECT {WORDS_SQL} AS word
          FROM (SELECT unnest(list_slice(parts, 1, len(parts) - 1)) AS line
                FROM (SELECT regexp_split_to_array(text || chr(10), '\\r\\n|\\r|\\n') AS parts FROM documents)))
    GROUP BY word
    """,
)
def word_count_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = write_text(load(spark, folder, "documents").select("text"), new_folder(spark, "lines"), stamped=True)
    return words.word_counts(read_lines(spark, path))


@query("top_k_desc", f"SELECT word, count(*) AS count FROM ({DOCUMENT_WORDS}) GROUP BY word ORDER BY 2 DESC, 1 LIMIT 10")
def top_k_desc(spark: SparkSession, folder: str) -> DataFrame:
    return words.most_frequent(document_counts(spark, folder), 10)


@query("top_k_asc", f"SELECT word, count(*) AS count FROM ({DOCUMENT_WORDS}) GROUP BY word ORDER BY 2, 1 LIMIT 10")
def top_k_asc(spark: SparkSession, folder: str) -> DataFrame:
    return words.least_frequent(document_counts(spark, folder), 10)


@query(
    "keyword_top10",
    """
    SELECT word, count(*) AS count
    FROM (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS word FROM conversations)
    GROUP BY word ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def keyword_top10(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_terms(load(spark, folder, "conversations"), "text")


HAN_DIGITS = "零一二三四五六七八九"


@query(
    "keyword_han_top10",
    f"""
    WITH texts AS (SELECT translate(CAST(o_custkey AS VARCHAR), '0123456789', '{HAN_DIGITS}') AS han, o_orderstatus FROM orders)
    SELECT word, count(*) AS count
    FROM (SELECT substr(han, i, 2) AS word FROM (SELECT han, unnest(generate_series(1, length(han) - 1)) AS i FROM texts)
          UNION ALL SELECT han FROM texts WHERE length(han) = 1
          UNION ALL SELECT o_orderstatus FROM texts)
    GROUP BY word ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def keyword_han_top10(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of texts of Han digits and a letter: the Han part gives its overlapping pairs."""
    han = F.translate(F.col("o_custkey").cast("string"), "0123456789", HAN_DIGITS)
    return search.top_terms(load(spark, folder, "orders").select(F.concat(han, "o_orderstatus").alias("text")), "text")


HAN_DATES_SQL = f"""
    texts AS (SELECT translate(strftime(o_orderdate, '%Y年%m月%d日'), '0123456789', '{HAN_DIGITS}') AS run, o_orderstatus FROM orders),
    runs AS (SELECT run, count(*) AS n FROM texts GROUP BY run),
    grams AS (SELECT substr(run, i, k) AS gram, substr(' ' || run, i, 1) AS l, substr(run || ' ', i + k, 1) AS r, n
              FROM (SELECT run, n, unnest(generate_series(1, length(run))) AS i FROM runs), range(1, 5) AS sizes(k)
              WHERE i + k - 1 <= length(run)),
    statistics AS (SELECT gram, CAST(sum(n) AS BIGINT) AS count, count(DISTINCT l) AS before, count(DISTINCT r) AS behind
                   FROM grams GROUP BY gram)
"""


def han_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates as they are written in Han characters, without spaces, and a letter."""
    written = F.translate(F.date_format("o_orderdate", "yyyy'年'MM'月'dd'日'"), "0123456789", HAN_DIGITS)
    return load(spark, folder, "orders").select(F.concat(written, "o_orderstatus").alias("text"))


@query("han_gram_statistics", f"WITH {HAN_DATES_SQL} SELECT * FROM statistics")
def han_gram_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and neighbours of all stretches of Han text."""
    runs = count_by(explode_words(han_dates(spark, folder), script_runs("text")), "word", name="runs")
    return terms.gram_statistics(runs.where(terms.is_han(F.col("word"))))


@query(
    "keyword_han_learned",
    f"""
    WITH RECURSIVE {HAN_DATES_SQL},
    cuts AS (SELECT gram, count, left(gram, k) AS a, substr(gram, k + 1) AS b
             FROM statistics, range(1, 4) AS places(k) WHERE k < length(gram) AND count >= 5 AND before >= 2 AND behind >= 2),
    terms AS (SELECT c.gram, any_value(c.count) AS count FROM cuts c JOIN statistics a ON a.gram = c.a JOIN statistics b ON b.gram = c.b
              GROUP BY c.gram
              HAVING bool_and(c.count::HUGEINT * (SELECT sum(count) FROM statistics WHERE length(gram) = 1) >= 3 * a.count::HUGEINT * b.count)),
    paths AS (SELECT run, n, 0 AS place, 0 AS pieces, 0::BIGINT AS score, []::BIGINT[] AS sizes, []::VARCHAR[] AS words FROM runs
              UNION ALL
              SELECT run, n, place + k, pieces + 1, score + coalesce(t.count, 0), list_append(sizes, k), list_append(words, substr(run, place + 1, k))
              FROM (SELECT *, unnest(range(1, 5)) AS k FROM paths) p LEFT JOIN terms t ON t.gram = substr(run, place + 1, k)
              WHERE place + k <= length(run) AND (k = 1 OR t.gram IS NOT NULL)),
    best AS (SELECT n, words FROM paths WHERE place = length(run)
             QUALIFY row_number() OVER (PARTITION BY run ORDER BY pieces, score DESC, sizes DESC) = 1)
    SELECT word, CAST(sum(n) AS BIGINT) AS count
    FROM (SELECT unnest(words) AS word, n FROM best UNION ALL SELECT o_orderstatus, 1 FROM texts) GROUP BY word
    """,
)
def keyword_han_learned(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of Han text as its own statistics cut it."""
    return search.learned_term_counts(han_dates(spark, folder), "text", cohesion=3)


@query(
    "wide_hash_named",
    """SELECT 'orders:status' AS key, CAST(count(*) FILTER (o_orderstatus = 'F') AS VARCHAR) AS "F",
              CAST(count(*) FILTER (o_orderstatus = 'O') AS VARCHAR) AS "O",
              CAST(count(*) FILTER (o_orderstatus = 'P') AS VARCHAR) AS "P" FROM orders""",
)
def wide_hash_named(spark: SparkSession, folder: str) -> DataFrame:
    """One wide row of a hash, with the fields named beforehand."""
    counts = load(spark, folder, "orders").groupBy("o_orderstatus").count()
    return wide_hash(hash_fields(counts, F.lit("orders:status"), F.col("o_orderstatus"), F.col("count")), ["F", "O", "P"])


WIDE_WORDS_SQL = "SELECT role AS key, unnest(string_split(lower(text), ' ')) AS field, count(*) AS value FROM conversations GROUP BY 1, 2"


def _wide_words(spark: SparkSession, folder: str) -> DataFrame:
    said = load(spark, folder, "conversations").select(F.col("role").alias("key"), F.explode(F.split(F.lower("text"), " ")).alias("field"))
    return wide_maps(said.groupBy("key", "field").agg(F.count(F.lit(1)).alias("value")), F.sum, most=500)


@query("wide_row_entries", WIDE_WORDS_SQL)
def wide_row_entries(spark: SparkSession, folder: str) -> DataFrame:
    """All words of each role as wide rows of maps, and back to one row per word."""
    return _wide_words(spark, folder).select("key", F.explode("fields").alias("field", "value"))


@query(
    "wide_row_named",
    f"""SELECT key, max(value) FILTER (field = 'the') AS the, max(value) FILTER (field = 'to') AS "to",
               max(value) FILTER (field = 'no such word') AS missing FROM ({WIDE_WORDS_SQL}) GROUP BY key""",
)
def wide_row_named(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of named words cut from wide rows that hold all words."""
    return named_fields(_wide_words(spark, folder), ["the", "to", "no such word"]).withColumnRenamed("no such word", "missing")


@query(
    "search_click_top10",
    """SELECT user_id, event_type, count(*) AS count FROM events
    GROUP BY user_id, event_type ORDER BY 3 DESC, 1, 2 LIMIT 10""",
)
def search_click_top10(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_clicks(load(spark, folder, "events"), "user_id", "event_type")


@query(
    "search_click_stats",
    """SELECT max(n) AS max_count, min(n) AS min_count, sum(n)::DOUBLE / count(*) AS mean_count
    FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)""",
)
def search_click_stats(spark: SparkSession, folder: str) -> DataFrame:
    return search.click_summary(load(spark, folder, "events"), "user_id", "event_type")


@query("search_by_hour", "SELECT strftime(ts, '%H') AS hour, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def search_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    timed = load(spark, folder, "events").select(F.date_format("ts", "HH:mm:ss").alias("query_time"))
    return search.searches_per_hour(timed)


@query(
    "parse_valid_lines",
    """
    SELECT strftime(ts, '%H:%M:%S') AS query_time, 'u' || user_id AS user_id, event_type AS query_words,
           CAST(event_id % 10 AS INT) AS result_rank, CAST(user_id AS INT) AS click_rank,
           'http://site/' || event_id AS click_url
    FROM events WHERE event_id % 10 NOT IN (3, 7)
    """,
)
def parse_valid_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Search-log lines written from all events, some with a field too many or too few."""
    fields = [
        F.date_format("ts", "HH:mm:ss"),
        F.concat(F.lit("u"), "user_id"),
        F.concat(F.lit("["), "event_type", F.lit("]")),
        (F.col("event_id") % 10).cast("string"),
        F.col("user_id").cast("string"),
        F.concat(F.lit("http://site/"), "event_id"),
    ]
    broken = F.col("event_id") % 10
    line = (
        F.when(broken == 3, F.concat_ws("\t", *fields, F.lit("extra")))
        .when(broken == 7, F.concat_ws("\t", *fields[:-1]))
        .otherwise(F.concat_ws("\t", *fields))
    )
    path = write_text(load(spark, folder, "events").select(line), new_folder(spark, "search-log"))
    return search.search_records(read_lines(spark, path))


# exact mean of cents: six decimals first, as a decimal average keeps them, then two
AVG_BY_GROUP_SQL = """
    SELECT c_mktsegment,
           CAST(CASE WHEN s < 0 THEN -1 ELSE 1 END * ((six + 5000) // 10000) AS DOUBLE) / 100 AS avg_acctbal
    FROM (SELECT c_mktsegment, s, (abs(s) * 20000 + n) // (2 * n) AS six
          FROM (SELECT c_mktsegment, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS HUGEINT) AS s,
                       CAST(count(*) AS HUGEINT) AS n
                FROM customer GROUP BY c_mktsegment))
"""


def _balances(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "customer").select("c_mktsegment", money("c_acctbal", 12).alias("balance"))


@query("avg_by_group_sql", AVG_BY_GROUP_SQL)
def avg_by_group_sql(spark: SparkSession, folder: str) -> DataFrame:
    means = mean_by_sql(_balances(spark, folder), "c_mktsegment", "balance", "avg_acctbal")
    return means.withColumn("avg_acctbal", F.col("avg_acctbal").cast("double"))


@query("avg_by_group_dsl", AVG_BY_GROUP_SQL)
def avg_by_group_dsl(spark: SparkSession, folder: str) -> DataFrame:
    means = mean_by(_balances(spark, folder), "c_mktsegment", "balance", "avg_acctbal")
    return means.withColumn("avg_acctbal", F.col("avg_acctbal").cast("double"))


TOP10_SQL = """
    SELECT l_partkey, (200 * s + n) // (2 * n) / 100.0 AS avg_rating, n AS cnt_rating
    FROM (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS s, count(*) AS n FROM lineitem GROUP BY l_partkey)
    WHERE n > 30 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 10
"""


def _top10(spark: SparkSession, folder: str, form) -> DataFrame:
    return form(load(spark, folder, "lineitem"), "l_partkey", "l_quantity", min_count=30, k=10)


@query("top10_rated_sql", TOP10_SQL)
def top10_rated_sql(spark: SparkSession, folder: str) -> DataFrame:
    return _top10(spark, folder, ratings.top_rated_sql)


@query("top10_rated_dsl", TOP10_SQL)
def top10_rated_dsl(spark: SparkSession, folder: str) -> DataFrame:
    return _top10(spark, folder, ratings.top_rated)


@query("top10_csv_roundtrip", TOP10_SQL)
def top10_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "top10")
    report = _top10(spark, folder, ratings.top_rated)
    ratings.write_top_rated(report, path)
    return spark.read.schema(report.schema).csv(path)


@query(
    "pivot_sum",
    """
    SELECT CAST(sum(CASE WHEN o_orderstatus = 'F' THEN c END) AS DOUBLE) / 100 AS F,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN c END) AS DOUBLE) / 100 AS O,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN c END) AS DOUBLE) / 100 AS P
    FROM (SELECT o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
    """,
)
def pivot_sums(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderstatus", money("o_totalprice").alias("price"))
    wide = pivot_sum(orders, "o_orderstatus", "price", ["F", "O", "P"])
    return wide.select(*[F.col(name).cast("double").alias(name) for name in wide.columns])


@query("json_scan", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS count FROM events GROUP BY 1")
def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = write_text(load(spark, folder, "events").select("props"), new_folder(spark, "props"))
    return read_json(spark, path).groupBy("k").count()


@query(
    "typed_rows",
    """
    SELECT coalesce(label, 'other') AS label, count(*) AS count
    FROM events LEFT JOIN (VALUES ('click', 'engaged'), ('purchase', 'engaged'), ('view', 'passive'), ('signup', 'new'))
         AS kinds(event_type, label) USING (event_type)
    GROUP BY 1
    """,
)
def typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    kinds = literal_rows(
        spark,
        [("click", "engaged"), ("purchase", "engaged"), ("view", "passive"), ("signup", "new")],
        "event_type string, label string",
    )
    counts = load(spark, folder, "events").groupBy("event_type").count()
    labelled = counts.join(kinds, "event_type", "left").withColumn("label", F.coalesce("label", F.lit("other")))
    return labelled.groupBy("label").agg(F.sum("count").alias("count"))


@query(
    "region_count_report",
    """SELECT '2024-01-31' AS report_date, c_nationkey, c_mktsegment, count(*) AS count FROM customer
    GROUP BY c_nationkey, c_mktsegment""",
)
def region_count_report(spark: SparkSession, folder: str) -> DataFrame:
    return ads.region_counts(load(spark, folder, "customer"), ("c_nationkey", "c_mktsegment"), AS_OF)


def kpi_sql(strict: bool, source: str = AD_EVENTS_SQL, by: str = "province, city") -> str:
    ordered = " AND adorderid <> 0" if strict else ""
    bought = " AND isbid = 1 AND iswin = 1" if strict else ""
    bid = " AND isbid = 1" if strict else ""
    rtb = "adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1"
    paid = f"{rtb} AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000"
    rate = lambda a, b: f"(200 * {a} + {b}) // (2 * {b}) / 100.0"
    return f"""
    SELECT *, {rate('success_rtx_cnt', 'join_rtx_cnt')} AS success_rtx_rate,
           {rate('ad_click_cnt', 'ad_show_cnt')} AS ad_click_rate,
           {rate('media_click_cnt', 'media_show_cnt')} AS media_click_rate
    FROM (SELECT '2024-01-31' AS report_date, {by},
                 count(*) FILTER (requestmode = 1 AND processnode >= 1) AS orginal_req_cnt,
                 count(*) FILTER (requestmode = 1 AND processnode >= 2) AS valid_req_cnt,
                 count(*) FILTER (requestmode = 1 AND processnode = 3) AS ad_req_cnt,
                 count(*) FILTER ({rtb} AND isbid = 1 AND adorderid <> 0) AS join_rtx_cnt,
                 count(*) FILTER ({rtb} AND iswin = 1{ordered}) AS success_rtx_cnt,
                 count(*) FILTER (requestmode = 2 AND iseffective = 1) AS ad_show_cnt,
                 count(*) FILTER (requestmode = 3 AND iseffective = 1{ordered}) AS ad_click_cnt,
                 count(*) FILTER (requestmode = 2 AND iseffective = 1 AND isbilling = 1{bought}) AS media_show_cnt,
                 count(*) FILTER (requestmode = 3 AND iseffective = 1 AND isbilling = 1{bought}) AS media_click_cnt,
                 CAST(coalesce(sum(CAST(floor(winprice / 1000) AS BIGINT)) FILTER ({paid}), 0) AS BIGINT)
                     AS dsp_pay_money,
                 CAST(coalesce(sum(CAST(floor(adpayment / 1000) AS BIGINT)) FILTER ({paid}{bid}), 0) AS BIGINT)
                     AS dsp_cost_money
          FROM ({source}) GROUP BY {by})
    WHERE 0 NOT IN (join_rtx_cnt, success_rtx_cnt, ad_show_cnt, ad_click_cnt, media_show_cnt, media_click_cnt)
    """


@query("kpi_strict_dsl", kpi_sql(strict=True))
def kpi_strict_dsl(spark: SparkSession, folder: str) -> DataFrame:
    return ads.region_kpis(ad_events(spark, folder), as_of=AS_OF)


@query("kpi_basic_dsl", kpi_sql(strict=False))
def kpi_basic_dsl(spark: SparkSession, folder: str) -> DataFrame:
    return ads.region_kpis(ad_events(spark, folder), as_of=AS_OF, variant="basic")


@query("kpi_basic_sql", kpi_sql(strict=False))
def kpi_basic_sql(spark: SparkSession, folder: str) -> DataFrame:
    return ads.region_kpis_sql(ad_events(spark, folder), AS_OF)


@query("kpi_basic_two_step", kpi_sql(strict=False))
def kpi_basic_two_step(spark: SparkSession, folder: str) -> DataFrame:
    return ads.region_kpis_two_step(ad_events(spark, folder), AS_OF)


EVENT_ADDRESS_SQL = """
    event_id % 1000 * 4294967 + CASE WHEN event_id % 1000 % 5 = 0 THEN (event_id // 1000) % 150
                                     ELSE (event_id * 7919) % 4294967 END
"""
LOOKUP_SQL = f"""
    SELECT event_id, province, city
    FROM (SELECT event_id, {EVENT_ADDRESS_SQL} AS ip_number FROM events)
    LEFT JOIN ({IP_RANGES_SQL}) ON ip_number BETWEEN ip_from AND ip_to
"""


def _addressed(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return events.select("event_id", long_to_ipv4(address(F.col("event_id"))).alias("ip"))


@query("ip_region_lookup", LOOKUP_SQL)
def ip_region_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return locate_ips(_addressed(spark, folder), ip_ranges(spark, folder), disjoint=True).drop("ip")


@query("ip_region_lookup_shuffled", LOOKUP_SQL)
def ip_region_lookup_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same lookup on the way taken when the ranges are too many to broadcast."""
    return locate_ips(_addressed(spark, folder), ip_ranges(spark, folder), broadcast_rows=0, disjoint=True).drop("ip")


@query(
    "ip_text_roundtrip",
    f"""
    SELECT event_id, (n // 16777216) || '.' || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) AS ip,
           n AS ip_number
    FROM (SELECT event_id, {EVENT_ADDRESS_SQL} AS n FROM events)
    """,
)
def ip_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _addressed(spark, folder).withColumn("ip_number", ipv4_to_long("ip"))


@query(
    "key_city_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def key_city_filter(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return keep_listed(customers, "c_mktsegment", ["BUILDING", "MACHINERY"])
