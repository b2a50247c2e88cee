import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyflow.functions import (
    dated_key,
    day_before,
    day_text,
    field_count,
    ipv4_to_long,
    java_split,
    line_words,
    long_to_ipv4,
    order_row_key,
    query_terms,
    trim_ws,
)

PATTERNS = [r"\s+", ",", "\t", "|", ";", "::", r"\|"]


def model_split(text, pattern):
    """Trailing empty fields go; text without a match stays whole."""
    parts = re.split(re.escape(pattern) if len(pattern) == 1 else pattern, text, flags=re.ASCII)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "value string").select(column).first()[0]


@pytest.mark.parametrize(
    "text, pattern, expected",
    [
        (",,", ",", []),
        ("a,b,,", ",", ["a", "b"]),
        ("", ",", [""]),
        (" hive spark ", r"\s+", ["", "hive", "spark"]),
        ("   ", r"\s+", []),
        ("4::20::5::", "::", ["4", "20", "5"]),
        ("a:::", "::", ["a", ":"]),
        ("中国|0|湖北省|武汉市|电信", "|", ["中国", "0", "湖北省", "武汉市", "电信"]),
    ],
)
def test_split_goldens(spark, text, pattern, expected):
    assert one(spark, text, java_split("value", pattern)) == expected


def test_split_against_model(spark):
    samples = []

    @settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet=" \t,:|;ab中\n", max_size=12))
    def draw(text):
        samples.append(text)

    draw()
    frame = spark.createDataFrame([(s,) for s in samples], "value string")
    rows = frame.select("value", *[java_split("value", p).alias(str(i)) for i, p in enumerate(PATTERNS)]).collect()
    for row in rows:
        for i, pattern in enumerate(PATTERNS):
            assert row[str(i)] == model_split(row["value"], pattern), (row["value"], pattern)


def test_trim_takes_all_low_characters(spark):
    text = "\x00\x01\t \n\x1f a b  \x0b\x20"
    assert one(spark, text, trim_ws("value")) == "a b "
    assert one(spark, None, trim_ws("value")) is None


def test_field_count(spark):
    assert one(spark, "  a\tb\tc\td \t", field_count("value", "\t")) == 4
    assert one(spark, " , ,", field_count("value", ",")) == 2


def test_line_words_keep_leading_empty_word(spark, lines):
    got = lines("hadoop spark spark", " hive spark", "").select(F.explode(line_words("value")).alias("w"))
    counts = {r.w: r["count"] for r in got.groupBy("w").count().collect()}
    assert counts == {"spark": 3, "hadoop": 1, "hive": 1, "": 2}


@pytest.mark.parametrize(
    "text, terms",
    [
        ("spark 3.5", ["spark", "3", "5"]),
        ("中华人民", ["中华", "华人", "人民"]),
        ("中", ["中"]),
        ("买spark书籍", ["买", "spark", "书籍"]),
        ("été déjà-vu", ["été", "déjà", "vu"]),
        ("", []),
    ],
)
def test_query_terms(spark, text, terms):
    assert one(spark, text, query_terms("value")) == terms


@pytest.mark.parametrize(
    "ip, number",
    [
        ("203.0.113.148", 3405803924),
        ("192.0.2.68", 3221226052),
        ("198.51.100.127", 3325256831),
        ("233.252.0.201", 3925606601),
        ("255.255.255.255", 2**32 - 1),
        ("0.0.0.0", 0),
    ],
)
def test_ipv4_both_ways(spark, ip, number):
    assert one(spark, ip, ipv4_to_long("value")) == number
    assert one(spark, ip, long_to_ipv4(ipv4_to_long("value"))) == ip


@pytest.mark.parametrize("bad", ["1.2.3", "1.2.3.4.5", "1.2.3.256", "a.b.c.d", "", None, "1.2.3.-4"])
def test_bad_addresses_are_null(spark, bad):
    assert one(spark, bad, ipv4_to_long("value")) is None


def test_negative_integer_address(spark):
    assert spark.sql("select -1 as n").select(long_to_ipv4("n")).first()[0] == "255.255.255.255"


def test_keys_and_days(spark):
    from datetime import date

    row = spark.createDataFrame([("730046185", "2024-02-29 07:08:09.010")], "userId string, orderTime string")
    assert row.select(order_row_key()).first()[0] == "581640037_2024-02-29 07:08:09.010"
    keyed = row.select(dated_key("orders:money:total", F.lit("2020-05-19")))
    assert keyed.first()[0] == "orders:money:total:2020-05-19"
    days = row.select(day_text(date(2024, 3, 1)), day_before(date(2024, 3, 1))).first()
    assert tuple(days) == ("2024-03-01", "2024-02-29")
    assert row.where(day_before() == F.date_sub(F.current_date(), 1).cast("string")).count() == 1
