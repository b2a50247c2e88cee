"""The published region dictionary and the streams that read it."""

import json

import pytest
from pyspark.sql import functions as F

from tallyflow.plans import orders
from tallyflow.schemas import IP_RANGE
from tallyflow.sinks.streams import topic_sink
from tallyflow.sources import newest_edition, publish_regions, read_regions, topic_stream
from tallyflow.sources.regions import octets_of
from tallyflow.streaming.lifecycle import drain

# documentation blocks: 192.0.2.0/24, 198.51.100.0/24, 203.0.113.0/24
FIRST = [(3221225984, 3221226239, "north", "Anvil"), (3325256704, 3325256959, "south", "Bellow"), (3405803776, 3405804031, "east", "Cinder")]
LATER = [(a, b, p, f"new {c}") for a, b, p, c in FIRST]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def order(n, ip, status=0):
    value = json.dumps({"orderId": str(n), "userId": f"u{n}", "orderTime": "2031-02-03 04:05:06.000", "ip": ip, "orderMoney": "7.50", "orderStatus": status})
    return json.dumps({"key": str(n), "value": value})


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(records) + "\n")


def cities(spark, target):
    rows = spark.read.parquet(str(target)).select(F.get_json_object("value", "$.orderId").alias("id"), F.get_json_object("value", "$.city").alias("city"))
    return {r.id: r.city for r in rows.collect()}


def test_editions_are_tables_of_blocks(spark, tmp_path):
    path = str(tmp_path / "regions")
    with pytest.raises(FileNotFoundError):
        newest_edition(spark, path)
    publish_regions(spark.createDataFrame(FIRST, IP_RANGE), path, 20310101)
    publish_regions(spark.createDataFrame(LATER, IP_RANGE), path, 20310201)
    publish_regions(spark.createDataFrame(LATER, IP_RANGE), path, 20310201)
    assert newest_edition(spark, path) == 20310201
    assert {r.city for r in read_regions(spark, path, 20310101).collect()} == {"Anvil", "Bellow", "Cinder"}
    assert read_regions(spark, path, 20310201).count() == 3
    some = read_regions(spark, path, 20310201, [192])
    assert [r.city for r in some.collect()] == ["new Anvil"] and "octet" in plan_of(some).split("PushedFilters")[1] and "edition" in plan_of(some).split("PartitionFilters")[1]
    assert read_regions(spark, path, 20310201, []).count() == 0
    with pytest.raises(ValueError, match="starts inside another"):
        publish_regions(spark.createDataFrame([*FIRST, FIRST[0]], IP_RANGE), path, 1)
    assert octets_of(spark.createDataFrame([("192.0.2.1",), ("203.0.113.9",), ("no",), (None,)], "ip string")) == [192, 203]


def test_batches_follow_editions_and_repeat_with_their_own(spark, tmp_path):
    regions, target, source = str(tmp_path / "regions"), tmp_path / "topic", tmp_path / "in"
    publish_regions(spark.createDataFrame(FIRST, IP_RANGE), regions, 1)
    put(source, "a.json", order(1, "192.0.2.7"), order(2, "203.0.113.200"), order(3, "10.0.0.1"), order(4, None), order(5, "192.0.2.7", 1))

    def go():
        drain(orders.enrich_in_batches(topic_stream(spark, str(source)), regions, str(target), str(tmp_path / "ck")))

    go()
    assert cities(spark, target) == {"1": "Anvil", "2": "Cinder", "3": None, "4": None}
    # the batch is taken back, as after a failure before its commit, while a new edition is there
    publish_regions(spark.createDataFrame(LATER, IP_RANGE), regions, 2)
    for name in ("0", ".0.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    put(source, "b.json", order(6, "198.51.100.3"))
    go()
    assert cities(spark, target) == {"1": "Anvil", "2": "Cinder", "3": None, "4": None, "6": "new Bellow"}
    assert {(r.state_batch, r.edition) for r in orders.editions_used(spark, str(target)).collect()} == {(0, 1), (1, 2)}
    assert spark.read.parquet(str(target)).count() == 5


def test_no_batch_parses_the_dictionary(spark, tmp_path):
    """Micro-batches of the plain stream scan block files; neither text nor cutting is in their plan."""
    regions, source = str(tmp_path / "regions"), tmp_path / "in"
    publish_regions(spark.createDataFrame(FIRST, IP_RANGE), regions, 1)
    put(source, "a.json", order(1, "192.0.2.7"))
    cleaned = orders.enrich_orders(topic_stream(spark, str(source)), read_regions(spark, regions, 1))
    query = drain(topic_sink(cleaned, str(tmp_path / "ck"), str(tmp_path / "out"), file_format="parquet"))[0]
    plan = query._jsq.explainInternal(True)
    assert "piece_from" in plan and "FileScan parquet" in plan
    assert "sequence(" not in plan and "Window" not in plan and "FileScan text" not in plan
    assert cities(spark, tmp_path / "out") == {"1": "Anvil"}
