"""Batches, files and state read back from checkpoints."""

import json
import os

from pyspark.sql import functions as F

from tallyflow.plans import sales
from tallyflow.session import setting
from tallyflow.sinks.cells import FIELD_KEYS
from tallyflow.sinks.keyed import keyed_table
from tallyflow.sources import line_stream, topic_stream
from tallyflow.streaming.checkpoints import RETAIN, batch_files, batch_log, state_operators, state_sizes
from tallyflow.streaming.lifecycle import drain
from tallyflow.streaming.stateful import first_per_key


def feed(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    at = 1_900_000_000 + len(list(folder.iterdir()))  # files are read in the order they came
    os.utime(folder / name, (at, at))


def test_logs_say_which_files_a_batch_read(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    for n in range(12):  # past a compaction of the source's log
        feed(source, f"f{n:02}.txt", "a b")

    def go():
        drain(line_stream(spark, str(source), max_files=1).writeStream.format("noop").option("checkpointLocation", checkpoint))

    with setting(spark, RETAIN, "100"):
        go()
    log = {r.batch: r for r in batch_log(spark, checkpoint).collect()}
    assert sorted(log) == list(range(12)) and all(r.committed and r.planned_at is not None for r in log.values())
    assert all(json.loads(r.offsets[0])["logOffset"] == n for n, r in log.items())
    files = [(r.batch, r.path.rpartition("/")[2]) for r in batch_files(spark, checkpoint).collect()]
    assert sorted(n for n, _ in files) == list(range(12)) and len({name for _, name in files}) == 12
    for name in ("11", ".11.crc"):
        (tmp_path / "ck/commits" / name).unlink()
    assert [r.batch for r in batch_log(spark, checkpoint).where("NOT committed").collect()] == [11]
    with setting(spark, RETAIN, "100"):
        go()
    assert batch_log(spark, checkpoint).where("NOT committed").count() == 0
    assert batch_files(spark, checkpoint).count() == 12


def test_state_of_bounded_dedup_stays_bounded(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    for day in range(1, 9):
        feed(source, f"d{day}.txt", *[f"2031-03-0{day} 10:{m:02}:00,k{day}-{m % 20}" for m in range(40)])
    parts = F.split("value", ",")
    rows = line_stream(spark, str(source), max_files=1).select(parts[0].cast("timestamp").alias("at"), parts[1].alias("key"))
    first = first_per_key(rows, ["key"], within=("at", "1 hour"))
    drain(first.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", checkpoint))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 160
    sizes = state_sizes(spark, checkpoint)
    assert sizes and max(sizes.values()) <= 2 * 20  # the days behind the watermark are gone
    assert state_operators(spark, checkpoint).count() == len(sizes)


def test_state_of_bounded_days_stays_bounded(spark, tmp_path):
    source = tmp_path / "in"
    for day in range(1, 10):
        value = lambda n: json.dumps({"orderId": f"{day}-{n}", "orderTime": f"2031-04-0{day} 12:00:00", "orderMoney": "2.00", "province": f"p{n % 5}"})  # noqa: B023, E731
        feed(source, f"d{day}.json", *[json.dumps({"key": "k", "value": value(n)}) for n in range(30)])
    sizes, values = {}, {}
    for bounded in (True, False):
        table = keyed_table(spark, str(tmp_path / f"table-{bounded}"), *FIELD_KEYS)
        money = sales.order_money(topic_stream(spark, str(source), max_files=1))
        checkpoint = str(tmp_path / f"ck-{bounded}")
        drain(*sales.totals_writers(money, {"province": table}, checkpoint, True, bounded=bounded).values())
        sizes[bounded] = state_sizes(spark, f"{checkpoint}/province")[0]
        values[bounded] = {(r.key, r.field): r.value for r in table.read().collect()}
    assert values[True] == values[False] and len(values[True]) == 45 and set(values[True].values()) == {"12.00"}
    assert sizes[False] == 45 and sizes[True] <= 10
