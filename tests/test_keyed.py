"""Latest-state tables: nothing that was written is lost."""

import json

import pytest
from pyspark.sql import functions as F

from tallyflow.plans import orders, sales
from tallyflow.sinks.cells import FIELD_KEYS
from tallyflow.sinks.keyed import keyed_table, timed
from tallyflow.sinks.streams import batch_sink
from tallyflow.sources import topic_stream
from tallyflow.streaming.lifecycle import drain
from tallyflow.workspace import new_folder

DOCUMENTS = "id string, at string, money string, city string"


def docs(spark, *rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def rows_of(table):
    return sorted(tuple(r) for r in table.read().select("id", "at", "money", "city").collect())


@pytest.mark.parametrize("merge", ["row", "field"])
def test_a_missing_order_value_keeps_the_row(spark, merge):
    table = keyed_table(spark, new_folder(spark, "missing"), "id", merge=merge)
    table.upsert(docs(spark, ("1", None, "5.00", "X")), order_by="at")
    assert rows_of(table) == [("1", None, "5.00", "X")]
    table.upsert(docs(spark, ("1", None, "6.00", "Y"), ("1", "2020", "7.00", "Z")), order_by="at")
    assert rows_of(table) == [("1", "2020", "7.00", "Z")]


def test_ties_are_settled_the_same_way(spark):
    found = set()
    for order in (0, 1):
        rows = [("1", "t", "5.00", "X"), ("1", "t", "6.00", "Y")]
        table = keyed_table(spark, new_folder(spark, "ties"), "id")
        table.upsert(docs(spark, *(rows if order else rows[::-1])).coalesce(1), order_by="at")
        found.add(tuple(rows_of(table)))
    assert len(found) == 1


def test_partial_documents_keep_the_other_fields(spark):
    table = keyed_table(spark, new_folder(spark, "partial"), "id", merge="field")
    table.upsert(docs(spark, ("1", "2020", "5.00", "X"), ("2", "2020", "1.00", "Q")), order_by="at")
    for _ in range(2):
        table.upsert(docs(spark, ("1", "2021", None, None)), order_by="at")
        table.upsert(docs(spark, ("1", None, "9.00", None), ("3", None, None, "N")), order_by="at")
        assert rows_of(table) == [("1", "2021", "9.00", "X"), ("2", "2020", "1.00", "Q"), ("3", None, None, "N")]
    within = keyed_table(spark, new_folder(spark, "within"), "id", merge="field")
    within.upsert(docs(spark, ("1", "1", "5.00", "X"), ("1", "2", None, "Y"), ("1", None, "0.00", "0")), order_by="at")
    assert rows_of(within) == [("1", "2", "5.00", "Y")]


def test_batches_are_known_by_their_stream(spark):
    table = keyed_table(spark, new_folder(spark, "streams"), "id")
    one = lambda n, stream, batch, money="1": table.upsert(docs(spark, (str(n), "t", money, stream)), batch, order_by="at", stream=stream)
    one(1, "a", 0)
    one(2, "b", 0)  # another checkpoint starts at 0 again
    one(1, "a", 0)  # a replay replaces what it put
    assert [r[0] for r in rows_of(table)] == ["1", "2"] and table.history().count() == 2
    one(3, "b", 1)
    one(4, "c", 0)
    one(1, "c", 1, "2")
    assert [r[0] for r in rows_of(table)] == ["1", "2", "3", "4"] and table.history().count() == 5
    assert rows_of(table)[0] == ("1", "t", "2", "c")


def test_a_replayed_batch_keeps_its_place(spark, tmp_path):
    """Another stream puts a key after a batch; the batch running again after a failure does not win it back."""
    table = keyed_table(spark, str(tmp_path / "table"), "id")
    source = topic(tmp_path / "in", record(id="1", city="first"))
    fail = [True]

    def write(batch, batch_id):
        table.upsert(batch, batch_id, unique=True, stream="a")
        if fail.pop():
            raise RuntimeError("driver lost after the write")

    rows = timed(topic_stream(spark, source).select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.city").alias("city")))
    with pytest.raises(Exception, match="driver lost"):
        drain(batch_sink(rows, str(tmp_path / "ck"), write, "append"))
    table.upsert(spark.createDataFrame([("1", "second")], "id string, city string"), 0, unique=True, stream="b")
    fail.append(False)
    drain(batch_sink(rows, str(tmp_path / "ck"), write, "append"))
    assert [tuple(r) for r in table.read().collect()] == [("1", "second")] and table.history().count() == 2


def test_an_empty_first_put_leaves_the_columns(spark):
    table = keyed_table(spark, new_folder(spark, "none"), "id", merge="field")
    table.upsert(docs(spark), 0, unique=True)
    assert table.read().columns == DOCUMENTS.replace(" string", "").split(", ") and table.read().count() == 0
    table.upsert(docs(spark, ("1", "t", "5.00", "X")), 0, unique=True)
    assert rows_of(table) == [("1", "t", "5.00", "X")]


def test_a_complete_batch_replaces_the_one_before(spark):
    table = keyed_table(spark, new_folder(spark, "whole"), "id")
    table.replace(docs(spark, ("1", "t", "5.00", "X"), ("2", "t", "5.00", "X")))
    table.replace(docs(spark, ("2", "u", "6.00", "Y")))
    assert rows_of(table) == [("2", "u", "6.00", "Y")]


def record(**fields):
    return json.dumps({"key": "k", "value": json.dumps(fields)})


def topic(path, *records):
    path.mkdir()
    (path / "part.json").write_text("\n".join(records) + "\n")
    return str(path)


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "table"), "orderId", merge="field")
    for n in (1, 2):
        source = topic(tmp_path / f"in{n}", record(orderId=str(n), orderMoney="5.00"), record(orderId=str(n), province=f"p{n}"))
        for _ in range(2):
            drain(orders.index_orders(topic_stream(spark, source), table, str(tmp_path / f"ck{n}")))
    found = sorted((r.orderId, r.orderMoney, r.province) for r in table.read().collect())
    assert found == [("1", "5.00", "p1"), ("2", "5.00", "p2")]


def test_bad_records_go_to_their_folder(spark, tmp_path):
    good = dict(orderId="1", userId="12", orderTime="2020-05-19 10:00:00", orderMoney="5.00")
    source = topic(tmp_path / "in", record(**good), json.dumps({"key": "k", "value": "{broken"}), record(province="no id"))
    table = keyed_table(spark, str(tmp_path / "rows"), "row_key")
    drain(orders.put_orders(topic_stream(spark, source), table, str(tmp_path / "ck"), str(tmp_path / "bad")))
    assert [r.orderId for r in table.read().collect()] == ["1"]
    assert sorted(r.payload for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [json.dumps({"province": "no id"}), "{broken"]
    with pytest.raises(Exception, match="null in key column"):
        drain(orders.put_orders(topic_stream(spark, source), table, str(tmp_path / "other")))


def test_large_amounts_count(spark, tmp_path):
    source = topic(
        tmp_path / "in",
        record(orderId="1", orderMoney="100000000.00", orderTime="2020-05-19 10:00:00", province="p", city="c"),
        record(orderId="2", orderMoney="5.00", orderTime="2020-05-19 11:00:00", province="p", city="d"),
    )
    table = keyed_table(spark, str(tmp_path / "totals"), *FIELD_KEYS)
    money = sales.order_money(topic_stream(spark, source))
    drain(sales.all_totals_writer(money, table, str(tmp_path / "ck"), key_cities=["d"]))
    found = {(r.key.rpartition(":")[2], r.field): r.value for r in table.read().collect()}
    assert found == {("total", "global"): "100000005.00", ("province", "p"): "100000005.00", ("city", "d"): "5.00"}
