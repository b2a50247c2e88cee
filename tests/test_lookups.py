import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyflow.functions import ipv4_to_long
from tallyflow.operators.lookups import fits_broadcast, keep_in_table, keep_listed, locate_ips, overlapping_ranges, parse_ranges
from tallyflow.operators.parsing import timed_words
from tallyflow.schemas import IP_RANGE
from tallyflow.session import setting

RANGES = [
    (3221225984, 3221226239, "湖北省", "武汉市"),
    (3405803776, 3405804031, "河北省", "保定市"),
    (3325256704, 3325256959, "四川省", "绵阳市"),
    (3925606400, 3925606655, "陕西省", "西安市"),
]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ranges(spark):
    return spark.createDataFrame(RANGES, IP_RANGE)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_known_addresses(spark, ranges, broadcast_rows):
    ips = ["203.0.113.148", "192.0.2.68", "198.51.100.127", "233.252.0.201", "10.16.48.97", "bad", None]
    frame = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    found = {r.ip: (r.province, r.city) for r in locate_ips(frame, ranges, broadcast_rows=broadcast_rows).collect()}
    assert found == {
        "203.0.113.148": ("河北省", "保定市"),
        "192.0.2.68": ("湖北省", "武汉市"),
        "198.51.100.127": ("四川省", "绵阳市"),
        "233.252.0.201": ("陕西省", "西安市"),
        "10.16.48.97": (None, None),
        "bad": (None, None),
        None: (None, None),
    }


@pytest.mark.parametrize("broadcast_rows, hot_rows", [(10_000, 10**6), (0, 10**6), (0, 400)])
def test_against_brute_force_with_dense_blocks_and_a_hot_address(spark, broadcast_rows, hot_rows):
    rng = random.Random(5)
    edges = sorted(rng.sample(range(10 << 24, (10 << 24) + 400_000), 1500))
    table = [(a, b - 1 - (i % 2), f"p{i}", f"c{i}") for i, (a, b) in enumerate(zip(edges, edges[1:])) if b - 1 - (i % 2) >= a]
    table.append((20 << 24, (22 << 24) - 1, "wide", "wide"))  # 512 blocks of /16
    table.append((0, 5, "low", "low"))
    table.append((2**32 - 3, 2**32 - 1, "high", "high"))
    probes = [rng.randrange(10 << 24, (10 << 24) + 400_000) for _ in range(2000)]
    probes += [n for a, b, *_ in table[:50] for n in (a - 1, a, b, b + 1)]
    probes += [0, 5, 6, 2**32 - 1, 2**32 - 4, 20 << 24, (21 << 24) + 77, 22 << 24]
    probes += [edges[3]] * 1500  # a third of all rows
    rows = spark.createDataFrame(list(enumerate(probes)), "id int, n bigint").withColumn(
        "ip", F.concat_ws(".", *[(F.shiftright("n", s).bitwiseAND(255)).cast("string") for s in (24, 16, 8, 0)])
    )
    ranges = spark.createDataFrame(table, IP_RANGE)
    # without automatic broadcasts the large way really shuffles and merges
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1" if broadcast_rows == 0 else "10MB"):
        located = locate_ips(rows.repartition(6), ranges, broadcast_rows=broadcast_rows, hot_rows=hot_rows)
        found = located.collect()
        assert ("SortMergeJoin" in plan_of(located)) == (broadcast_rows == 0)
    got = {r.id: r.city for r in found}
    assert len(found) == len(got) == len(probes)

    def brute(n):
        return next((city for a, b, _, city in table if a <= n <= b), None)

    assert got == {i: brute(n) for i, n in enumerate(probes)}


def test_no_row_is_lost_or_repeated(spark, ranges):
    rows = spark.createDataFrame([(i % 3, "203.0.113.148") for i in range(300)], "id int, ip string")
    for limit in (1000, 0):
        assert locate_ips(rows, ranges, broadcast_rows=limit).count() == 300


def test_plans(spark, ranges):
    rows = spark.range(1000).select(F.concat(F.lit("203.0.113."), F.col("id") % 256).alias("ip"))
    small = plan_of(locate_ips(rows, ranges))
    assert small.count("BroadcastHashJoin") == 2 and "NestedLoop" not in small and "Python" not in small
    large = plan_of(locate_ips(rows, ranges, broadcast_rows=0))
    assert "NestedLoop" not in large and "Cartesian" not in large
    assert large.count("SortMergeJoin") == 1  # under default settings


def test_rows_are_shuffled_once_and_nulls_not_at_all(spark, ranges):
    """Executed plan of the large way: one exchange of the rows, filtered to those with an address, and no repeats."""
    ip = F.when(F.col("id") % 3 > 0, F.concat(F.lit("203.0.113."), F.col("id") % 256))
    rows = spark.range(0, 3000, 1, 4).select("id", ip.alias("ip"))
    located = locate_ips(rows, ranges, broadcast_rows=0)
    assert located.count() == 3000 and located.where("city IS NOT NULL").count() == 2000
    located.collect()
    final = plan_of(located).split("== Initial Plan ==")[0]
    whole, none = final.split("SortMergeJoin")[1].split("Generate")[0], final.split("Union")[1]
    assert final.count("Range (0, 3000") == 2 and "isnotnull" in whole
    assert whole.split("Range (0, 3000")[0].count("Exchange hashpartitioning") == 1
    assert "Exchange" not in none.split("Range (0, 3000")[-2].rsplit("isnull", 1)[-1]


def test_only_hot_blocks_are_dealt_out(spark, ranges):
    from tallyflow.operators.lookups import hot_blocks, region_blocks

    placed = spark.range(1000).select(F.lit(16).alias("_level"), F.when(F.col("id") < 600, 7).otherwise(F.col("id")).cast("bigint").alias("_block"))
    assert hot_blocks(placed, 100) == [(16, 7, 6)] and hot_blocks(placed, 1000) == [] and hot_blocks(placed.limit(0), 1) == []
    dense = spark.createDataFrame([(i * 4, i * 4 + 3, "p", "c") for i in range(300)] + [(1 << 20, 1 << 24, "q", "d")], IP_RANGE)
    blocks = region_blocks(dense)
    assert {r.level: r["count"] for r in blocks.groupBy("level").count().collect()} == {24: 300, 16: 241}
    assert blocks.groupBy("level", "block").count().agg(F.max("count")).first()[0] == 64


def test_size_check_sends_one_row_a_task(spark, ranges):
    assert fits_broadcast(ranges, 4) and not fits_broadcast(ranges, 3)


def test_overlapping_ranges_are_refused(spark, ranges):
    rows = spark.createDataFrame([("203.0.113.148",)], "ip string")
    with pytest.raises(ValueError, match="starts inside another"):
        locate_ips(rows, ranges.unionByName(ranges))


def test_overlaps_are_found(spark, ranges):
    assert overlapping_ranges(ranges).count() == 0
    extra = spark.createDataFrame([(3405803800, 3405803900, "x", "y"), (5, 9, "a", "b")], IP_RANGE)
    assert [tuple(r) for r in overlapping_ranges(ranges.unionByName(extra)).collect()] == [(3405803800, 3405803900)]
    twice = ranges.unionByName(ranges)
    assert overlapping_ranges(twice).count() == len(RANGES)
    touching = spark.createDataFrame([(0, 9, "x", "y"), (10, 2**32 - 1, "a", "b")], IP_RANGE)
    assert overlapping_ranges(touching).isEmpty()


def test_listed_values(spark):
    rows = spark.createDataFrame([("西安市",), ("保定市",), (None,)], "city string")
    assert keep_listed(rows, "city", ["西安市", "武汉市"]).count() == 1
    table = spark.createDataFrame([("西安市",), ("武汉市",)], "name string")
    for limit in (10, 1):
        assert keep_in_table(rows, "city", table, limit).count() == 1
    assert fits_broadcast(table, 2) and not fits_broadcast(table, 1)


def test_address_parsing_stays_in_the_engine(spark):
    assert "Python" not in plan_of(spark.range(3).select(ipv4_to_long(F.col("id").cast("string"))))


def test_unreadable_lines_are_counted(spark):
    read = Observation("ranges")
    lines = ["1.0.0.0|1.0.0.9|c|0|p|q|x", "short|line", "1.0.0.9|1.0.0.0|c|0|p|q|x", "a|b|c|0|p|q|x", ""]
    assert parse_ranges(spark.createDataFrame([(x,) for x in lines], "value string"), rejected=read).count() == 1
    assert read.get == {"lines": 5, "kept": 1}
    times = Observation("times")
    timed = timed_words(spark.createDataFrame([("2024-01-01 00:00:00,a b",), ("never,a",), ("alone",)], "value string"), rejected=times)
    assert timed.count() == 2 and times.get == {"lines": 3, "kept": 1}
