import os
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyflow.operators.parsing import timed_words
from tallyflow.plans import calls, devices, orders, persons, sales, words
from tallyflow.schemas import IP_RANGE, PERSON, USER_EVENT
from tallyflow.operators.parsing import parse_payload
from tallyflow.sinks.cells import FIELD_KEYS
from tallyflow.sinks.jdbc import RowReplacer
from tallyflow.sinks.keyed import keyed_table
from tallyflow.sinks.streams import batch_sink, console_sink, keyed_sink, topic_sink
from tallyflow.sources import kafka_options, line_stream, rate_stream, separated_stream, topic_stream
from tallyflow.streaming import lifecycle
from tallyflow.streaming.late import read_late_rows, read_windows, windows_with_late_rows
from tallyflow.streaming.lifecycle import drain, late_rows, offset_audit, ProgressLog, start, stop_on_marker
from tallyflow.streaming.stateful import deduplicated_counts, first_per_key, flat_windows, windowed_counts
from tests.test_lookups import RANGES


@pytest.fixture()
def feed(tmp_path):
    """Adds one text file per call, with rising modification times, so each becomes a micro-batch."""

    class Feed:
        folder = str(tmp_path / "in")
        count = 0

        def __call__(self, *text):
            Path(self.folder).mkdir(exist_ok=True)
            path = Path(self.folder, f"{self.count:04}.txt")
            path.write_text("\n".join(text) + "\n")
            stamp = 1_600_000_000 + self.count
            os.utime(path, (stamp, stamp))
            self.count += 1

    return Feed()


class Batches:
    """Collects what each micro-batch emits."""

    def __init__(self):
        self.seen = {}

    def __call__(self, batch, batch_id):
        self.seen[batch_id] = sorted(tuple(r) for r in batch.collect())

    def rows(self):
        return [rows for rows in self.seen.values() if rows]


def run(frame, tmp_path, mode, label="ck"):
    batches = Batches()
    query = drain(frame.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / label)).foreachBatch(batches))[0]
    return batches.rows(), query


def step(frame, feed, texts, tmp_path, mode, label="ck"):
    """Feed one file at a time and let the stream go idle in between, as a live source would.

    Idle time lets the empty batch run that puts a new watermark into force.
    """
    batches = Batches()
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / label)).foreachBatch(batches)
    query = start(writer)
    try:
        for text in texts:
            feed(*text)
            query.processAllAvailable()
    finally:
        query.stop()
    return batches.rows(), query


def test_running_counts_over_batches(spark, feed, tmp_path):
    feed("hadoop spark spark", " hive spark", "")
    feed("spark flink")
    counts = words.stream_word_counts(line_stream(spark, feed.folder, max_files=1))
    rows, query = run(counts, tmp_path, "update")
    assert rows == [[("hadoop", 1), ("hive", 1), ("spark", 3)], [("flink", 1), ("spark", 4)]]
    assert [a["rows"] for a in offset_audit(query)][:2] == [3, 1]
    rows, _ = run(counts, tmp_path, "complete", "ck2")
    assert rows[-1] == [("flink", 1), ("hadoop", 1), ("hive", 1), ("spark", 4)]
    with pytest.raises(Exception, match="append"):
        run(counts, tmp_path, "append", "ck3")


def test_restart_goes_on_from_the_checkpoint(spark, feed, tmp_path):
    table = keyed_table(spark, str(tmp_path / "table"), "word")

    def go():
        counts = words.stream_word_counts(line_stream(spark, feed.folder, max_files=1))
        drain(keyed_sink(counts, table, str(tmp_path / "ck")))
        return {r.word: r["count"] for r in table.read().collect()}

    feed("a b")
    feed("a c")
    assert go() == {"a": 2, "b": 1, "c": 1}
    assert go() == {"a": 2, "b": 1, "c": 1}
    feed("a d")
    assert go() == {"a": 3, "b": 1, "c": 1, "d": 1}
    assert {r.n for r in table.history().groupBy("state_stream").agg(F.countDistinct("state_batch").alias("n")).collect()} == {3}


def test_lost_output_commit_is_replayed_once(spark, feed, tmp_path):
    """The batch after an unfinished write is replayed under the same id and counted once."""
    table = keyed_table(spark, str(tmp_path / "table"), "word")
    fails = [True]
    feed("a b")

    def write(batch, batch_id):
        table.upsert(batch, batch_id, unique=True)
        if fails.pop():
            raise RuntimeError("driver lost after the write")

    counts = words.stream_word_counts(line_stream(spark, feed.folder))
    with pytest.raises(Exception, match="driver lost"):
        drain(batch_sink(counts, str(tmp_path / "ck"), write))
    fails.append(False)
    drain(batch_sink(counts, str(tmp_path / "ck"), write))
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 1), ("b", 1)]


def test_sliding_window(spark, feed, tmp_path):
    feed(
        "2021-03-15 14:30:01,tea tea",
        "2021-03-15 14:30:04,milk",
        "2021-03-15 14:30:09,salt tea",
        "no clock,tea",
        "2021-03-15 14:30:12,milk milk",
        "2021-03-15 14:30:16,salt",
        "2021-03-15 14:30:16",
    )
    timed = timed_words(line_stream(spark, feed.folder))
    rows, _ = run(flat_windows(windowed_counts(timed).orderBy("window", "word")), tmp_path, "complete")
    got = {(str(r[0])[11:], r[2]): r[3] for r in rows[-1]}
    assert got == {
        ("14:29:55", "tea"): 2, ("14:29:55", "milk"): 1,
        ("14:30:00", "tea"): 3, ("14:30:00", "milk"): 1, ("14:30:00", "salt"): 1,
        ("14:30:05", "salt"): 1, ("14:30:05", "tea"): 1, ("14:30:05", "milk"): 2,
        ("14:30:10", "milk"): 2, ("14:30:10", "salt"): 1, ("14:30:15", "salt"): 1,
    }


WATERMARK_BATCHES = [
    ["tea,2021-03-15 14:00:11", "salt,2021-03-15 14:00:12"],
    ["milk,2021-03-15 14:00:19", "tea,2021-03-15 14:00:13"],
    ["salt,2021-03-15 14:00:12", "tea,2021-03-15 14:00:20", "milk,2021-03-15 14:00:26"],
    ["milk,2021-03-15 14:00:23", "tea,2021-03-15 14:00:06"],
]
LATEST_BATCH = ["late,2021-03-15 14:00:01", "milk,2021-03-15 14:00:12", "late,2021-03-15 14:01:00"]


def test_watermark_update(spark, feed, tmp_path):
    Path(feed.folder).mkdir()
    timed = timed_words(line_stream(spark, feed.folder, max_files=1), time_first=False)
    counts = flat_windows(windowed_counts(timed, watermark="10 seconds"))
    rows, query = step(counts, feed, WATERMARK_BATCHES, tmp_path, "update")
    got = [{(str(r[0])[14:], r[2]): r[3] for r in batch} for batch in rows]
    assert got == [
        {("00:05", "tea"): 1, ("00:05", "salt"): 1, ("00:10", "tea"): 1, ("00:10", "salt"): 1},
        {("00:05", "tea"): 2, ("00:10", "tea"): 2, ("00:10", "milk"): 1, ("00:15", "milk"): 1},
        {
            ("00:05", "salt"): 2, ("00:10", "salt"): 2, ("00:15", "tea"): 1, ("00:20", "tea"): 1,
            ("00:20", "milk"): 1, ("00:25", "milk"): 1,
        },
        {("00:15", "milk"): 2, ("00:20", "milk"): 2},
    ]
    assert late_rows(query) >= 1


def test_watermark_append_gives_closed_windows(spark, feed, tmp_path):
    Path(feed.folder).mkdir()
    timed = timed_words(line_stream(spark, feed.folder), time_first=False)
    counts = flat_windows(windowed_counts(timed, watermark="10 seconds"))
    closed, _ = step(counts, feed, WATERMARK_BATCHES, tmp_path, "append")
    first = {(str(r[0])[14:], r[2]): r[3] for r in closed[0]}
    assert first == {("00:05", "tea"): 2, ("00:05", "salt"): 2}


def split_by_hand(batches, delay, length, slide):
    """Windows of each word, and the rows whose window had ended by the watermark of their batch."""
    counts, late, top = {}, [], 0
    for lines in batches:
        mark, times = max(0, top - delay), []
        for word, _, clock in (line.partition(",") for line in lines):
            at = sum(int(x) * unit for x, unit in zip(clock[11:].split(":"), (3600, 60, 1)))
            times.append(at)
            for start in range(at - at % slide - length + slide, at + 1, slide):
                if top and start + length <= mark:
                    late.append((at, word, start))
                else:
                    counts[start, word] = counts.get((start, word), 0) + 1
        top = max(top, *times)
    return counts, sorted(late)


def test_late_rows_are_kept_and_replays_change_nothing(spark, feed, tmp_path):
    counts, late, checkpoint = (str(tmp_path / name) for name in ("counts", "late", "ck"))
    seconds = lambda t: t.hour * 3600 + t.minute * 60 + t.second

    def go():
        timed = timed_words(line_stream(spark, feed.folder, max_files=1), time_first=False)
        drain(windows_with_late_rows(timed, counts, late, checkpoint))

    def found():
        windows = {(seconds(r.window_start), r.word): r["count"] for r in read_windows(spark, counts).collect()}
        return windows, sorted((seconds(r.time), r.word, seconds(r.window_start)) for r in read_late_rows(spark, late).collect())

    for lines in WATERMARK_BATCHES[:3]:
        feed(*lines)
    go()
    feed(*WATERMARK_BATCHES[3])
    feed(*LATEST_BATCH)
    go()
    want = split_by_hand([*WATERMARK_BATCHES, LATEST_BATCH], 10, 10, 5)
    assert found() == want and len(want[1]) >= 4
    marks = {r.watermark for r in read_late_rows(spark, late).collect()}
    assert {str(m)[14:19] for m in marks} == {"00:16"}
    for name in ("4", ".4.crc"):  # the last batch was written but not committed
        Path(checkpoint, "commits", name).unlink(missing_ok=True)
    go()
    assert found() == want


def test_late_rows_of_nothing(spark, feed, tmp_path):
    folders = [str(tmp_path / name) for name in ("counts", "late")]
    feed("not a timed line")
    drain(windows_with_late_rows(timed_words(line_stream(spark, feed.folder), time_first=False), *folders, str(tmp_path / "ck")))
    assert read_windows(spark, folders[0]).count() == read_late_rows(spark, folders[1]).count() == 0


EVENTS = [
    ['{"eventTime":"2021-03-15 14:01:50","eventType":"click","userID":"u1"}'],
    [
        '{"eventTime":"2021-03-15 14:01:50","eventType":"click","userID":"u1"}',
        '{"eventTime":"2021-03-15 14:01:51","eventType":"click","userID":"u2"}',
    ],
]


def user_events(spark, feed):
    rows = parse_payload(line_stream(spark, feed.folder, max_files=1), USER_EVENT)
    return rows.select(
        F.col("eventTime").try_cast("timestamp").alias("event_time"),
        F.col("eventType").alias("event_type"),
        F.col("userID").alias("user_id"),
    )


def test_deduplicated_counts(spark, feed, tmp_path):
    for batch in EVENTS:
        feed(*batch)
    counts = deduplicated_counts(user_events(spark, feed), ["user_id", "event_type"])
    rows, _ = run(counts, tmp_path, "complete")
    changes = [r for i, r in enumerate(rows) if i == 0 or r != rows[i - 1]]  # a batch without data says the same again
    assert changes == [[("u1", "click", 1)], [("u1", "click", 1), ("u2", "click", 1)]]
    rows, _ = run(counts, tmp_path, "update", "ck2")
    assert rows == [[("u1", "click", 1)], [("u2", "click", 1)]]
    with pytest.raises(Exception, match="append"):
        run(counts, tmp_path, "append", "ck3")


@pytest.mark.parametrize("salts", [1, 16])
def test_first_per_key(spark, feed, tmp_path, salts):
    feed(*EVENTS[1] * 40)
    feed(*EVENTS[0] * 40)
    first = first_per_key(user_events(spark, feed), ["user_id", "event_type"], salts=salts)
    rows, _ = run(first.select("user_id"), tmp_path, "append")
    assert rows == [[("u1",), ("u2",)]]
    within = first_per_key(user_events(spark, feed), ["user_id", "event_type"], within=("event_time", "1 hour"))
    rows, _ = run(within.select("user_id"), tmp_path, "append", "ck2")
    assert rows == [[("u1",), ("u2",)]]


def test_hobby_stream(spark, feed, tmp_path):
    feed("mia;21;chess", "leo;18;chess", "eva;24;sailing")
    feed("ben;25;sailing", "ida;52;sailing")
    ranking = persons.hobby_ranking(separated_stream(spark, feed.folder, PERSON, max_files=1))
    rows, _ = run(ranking, tmp_path, "complete")
    assert rows[-1] == [("chess", 2), ("sailing", 1)]


def test_device_stream_both_forms(spark, feed, tmp_path):
    feed('{"device":"sensor_a","deviceType":"meter","signal":71.5,"time":1700000000000}')
    feed(
        '{"device":"sensor_b","deviceType":"meter","signal":12.0,"time":1700000000000}',
        '{"device":"sensor_c","deviceType":"meter","signal":72.5,"time":1700000000000}',
    )
    signals = devices.device_signals(line_stream(spark, feed.folder, max_files=1))
    for i, form in enumerate((devices.device_stats, devices.device_stats_sql)):
        rows, _ = run(form(signals), tmp_path, "complete", f"ck{i}")
        assert rows[-1] == [("meter", 2, 72.0)]


RAW = [
    ("o-0001", "u17", "2023-03-04 08:15:00.125", "203.0.113.148", 120.45, 0),
    ("o-0002", "u23", "2022-11-12 17:30:10.250", "192.0.2.68", 75.15, 0),
    ("o-0003", "u31", "2022-06-07 09:05:06.007", "198.51.100.127", 210.05, 0),
    ("o-0004", "u42", "2022-06-07 18:40:20.500", "233.252.0.201", 98.65, 0),
    ("o-0005", "u42", "2022-06-07 18:40:20.500", "233.252.0.201", 98.65, 1),
]
NOWHERE = ("o-0009", "u58", "2022-06-06 20:00:01.001", "10.16.48.97", 64.9, 0)
FIELDS = ("orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus")


def record(order):
    import json

    value = json.dumps(dict(zip(FIELDS, order)), ensure_ascii=False)
    return json.dumps({"key": order[0], "value": value}, ensure_ascii=False)


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_orders_from_topic_to_totals(spark, feed, tmp_path, file_format):
    feed(*[record(o) for o in RAW[:2]])
    feed(*[record(o) for o in RAW[2:]], '{"key":"x","value":"not json"}', '{"key":"y"}')
    ranges = spark.createDataFrame(RANGES, IP_RANGE)
    clean = orders.enrich_orders(topic_stream(spark, feed.folder, max_files=1), ranges)
    drain(topic_sink(clean, str(tmp_path / "ck"), str(tmp_path / "topic"), file_format=file_format))
    stored = {r.key: r.value for r in spark.read.format(file_format).load(str(tmp_path / "topic")).collect()}
    assert len(stored) == 4
    assert stored[RAW[0][0]] == (
        '{"orderId":"o-0001","userId":"u17","orderTime":"2023-03-04 08:15:00.125",'
        '"ip":"203.0.113.148","orderMoney":"120.45","orderStatus":0,"province":"河北省","city":"保定市"}'
    )

    def topic():
        return topic_stream(spark, str(tmp_path / "topic"), file_format=file_format, max_files=1)

    expected = {
        False: {
            ("orders:money:total", "global"): "504.30",
            ("orders:money:province", "河北省"): "120.45",
            ("orders:money:province", "湖北省"): "75.15",
            ("orders:money:province", "四川省"): "210.05",
            ("orders:money:province", "陕西省"): "98.65",
            ("orders:money:city", "武汉市"): "75.15",
            ("orders:money:city", "西安市"): "98.65",
        },
        True: {
            ("orders:money:total:2022-06-07", "global"): "308.70",
            ("orders:money:total:2022-11-12", "global"): "75.15",
            ("orders:money:total:2023-03-04", "global"): "120.45",
            ("orders:money:province:2023-03-04", "河北省"): "120.45",
            ("orders:money:province:2022-11-12", "湖北省"): "75.15",
            ("orders:money:province:2022-06-07", "四川省"): "210.05",
            ("orders:money:province:2022-06-07", "陕西省"): "98.65",
            ("orders:money:city:2022-11-12", "武汉市"): "75.15",
            ("orders:money:city:2022-06-07", "西安市"): "98.65",
        },
    }
    for daily, wanted in expected.items():
        tables = {k: keyed_table(spark, str(tmp_path / f"{k}-{daily}"), *FIELD_KEYS) for k in sales.KINDS}
        writers = sales.totals_writers(sales.order_money(topic()), tables, str(tmp_path / f"tck-{daily}"), daily)
        drain(*writers.values())
        got = {(r.key, r.field): r.value for t in tables.values() for r in t.read().collect()}
        assert got == wanted
    index = keyed_table(spark, str(tmp_path / "index"), "orderId")
    rows = keyed_table(spark, str(tmp_path / "rows"), "row_key")
    drain(
        orders.index_orders(topic(), index, str(tmp_path / "ick")),
        orders.put_orders(topic(), rows, str(tmp_path / "rck")),
    )
    assert index.read().count() == 4
    assert "71u_2023-03-04 08:15:00.125" in {r.row_key for r in rows.read().collect()}


def test_unknown_region_is_kept_and_left_out_of_the_json(spark):
    rows = spark.createDataFrame([(record(NOWHERE),)], "line string").select(F.get_json_object("line", "$.value").alias("value"))
    value = orders.enrich_orders(rows, spark.createDataFrame(RANGES, IP_RANGE)).first().value
    assert value.endswith('"orderMoney":"64.9","orderStatus":0}')
    total = sales.running_totals(sales.order_money(spark.createDataFrame([(value,)], "value string")), "total")
    assert str(total.first()[0]) == "64.90"


def daily_rows(spark, feed):
    rows = timed_words(line_stream(spark, feed.folder, max_files=1), time_first=False)
    return rows.select(
        F.to_date("time").alias("order_date"),
        F.col("time").alias("order_timestamp"),
        F.lit("1.00").cast("decimal(10,2)").alias("money"),
        F.lit("p").alias("province"),
        F.lit("c").alias("city"),
    )


DAYS = [["x,2024-01-01 10:00:00"], ["x,2024-01-03 10:00:00"], ["x,2024-01-01 11:00:00"], ["x,2024-01-03 11:00:00"]]


def test_daily_totals_count_late_orders(spark, feed, tmp_path):
    Path(feed.folder).mkdir()
    rows = daily_rows(spark, feed)
    got, _ = step(sales.daily_totals(rows, "total"), feed, DAYS, tmp_path, "update")
    assert got[2] == [("orders:money:total:2024-01-01", "global", "2.00")]
    with pytest.raises(Exception, match="append"):
        run(sales.daily_totals(rows, "total"), tmp_path, "append", "ck2")


def test_bounded_daily_totals_drop_them(spark, feed, tmp_path):
    Path(feed.folder).mkdir()
    totals = sales.daily_totals(daily_rows(spark, feed), "total", bounded=True)
    got, query = step(totals, feed, DAYS, tmp_path, "update")
    assert [r for batch in got for r in batch if "2024-01-01" in r[0]] == [("orders:money:total:2024-01-01", "global", "1.00")]
    assert late_rows(query) >= 1


def test_call_stream_micro_batch(spark, feed, tmp_path):
    import json

    good = "mast_7,155 0001234,13300004321,success,1700000000000,61"
    feed(*[json.dumps({"key": "k", "value": v}) for v in (good, good.replace("success", "busy"))])
    passed = calls.calls_with_status(topic_stream(spark, feed.folder))
    drain(topic_sink(passed, str(tmp_path / "ck"), str(tmp_path / "out")))
    assert [r.value for r in spark.read.json(str(tmp_path / "out")).collect()] == [good]


def test_rate_sources_and_modes(spark, tmp_path):
    exact = rate_stream(spark, rows_per_second=5, partitions=2, per_batch=True)
    query = start(exact.writeStream.outputMode("append").format("memory"), name="exact_rate")
    time.sleep(3)
    query.stop()
    values = [r.value for r in spark.table("exact_rate").collect()]
    assert sorted(values) == list(range(len(values))) and len(values) % 5 == 0 and values
    timed = start(rate_stream(spark).writeStream.format("memory"), name="timed_rate", every="1 second")
    time.sleep(4)
    timed.stop()
    assert spark.table("timed_rate").columns == ["timestamp", "value"] and spark.table("timed_rate").count() > 0


def test_continuous_trigger_on_a_stateless_plan(spark, tmp_path):
    rows = rate_stream(spark, rows_per_second=20).where("value % 2 = 0").select("value")
    query = start(rows.writeStream.format("memory"), name="continuous_rows", continuous="1 second")
    deadline = time.time() + 40
    while time.time() < deadline and spark.table("continuous_rows").count() == 0:
        time.sleep(1)
    query.stop()
    assert spark.table("continuous_rows").where("value % 2 = 1").count() == 0
    assert spark.table("continuous_rows").count() > 0


def test_marker_stops_all_queries(spark, tmp_path):
    marker = tmp_path / "stop"
    queries = [
        start(rate_stream(spark).writeStream.format("memory"), name=f"marked_{i}") for i in range(2)
    ]
    threading.Timer(2, marker.touch).start()
    began = time.time()
    stop_on_marker(spark, str(marker), queries, interval=0.5)
    assert time.time() - began < 20 and not any(q.isActive for q in queries)


def _three(spark, feed, tmp_path):
    """Writers of three endless queries, of which the second fails."""
    feed("a")

    def broken(batch, batch_id):
        raise ValueError("sink is down")

    lines = line_stream(spark, feed.folder)
    good = lambda n: rate_stream(spark).writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"good-{n}"))
    return [good(1), batch_sink(lines, str(tmp_path / "bad"), broken, "append"), good(3)]


def test_any_failing_query_stops_the_rest(spark, feed, tmp_path):
    queries = [start(writer) for writer in _three(spark, feed, tmp_path)]
    with pytest.raises(Exception, match="sink is down"):
        stop_on_marker(spark, str(tmp_path / "never"), queries, interval=1)
    assert not any(q.isActive for q in queries)


def test_draining_stops_the_rest_on_a_failure(spark, feed, tmp_path, monkeypatch):
    writers = _three(spark, feed, tmp_path)
    started = []
    monkeypatch.setattr(lifecycle, "start", lambda w, available_now: started.append(start(w)) or started[-1])
    with pytest.raises(Exception, match="sink is down"):
        drain(*writers)
    assert len(started) == 3 and not any(q.isActive for q in started)


def test_progress_of_more_than_a_hundred_batches(spark, feed, tmp_path):
    for i in range(105):
        feed(f"w{i}")
    log = ProgressLog().watch(spark)
    lines = line_stream(spark, feed.folder, 1).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck"))
    (query,) = drain(lines)
    assert sum(r["rows"] for r in offset_audit(query, log)) == 105 and len(offset_audit(query, log)) >= 105
    assert late_rows(query, log) == 0
    spark.streams.removeListener(log)


def test_stopping_raises_the_failure_of_a_query(spark, feed, tmp_path):
    feed("a")

    def broken(batch, batch_id):
        raise ValueError("sink is down")

    query = start(batch_sink(line_stream(spark, feed.folder), str(tmp_path / "ck"), broken, "append"))
    with pytest.raises(Exception, match="sink is down"):
        stop_on_marker(spark, str(tmp_path / "never"), [query], interval=1)


def test_row_writer_object(spark, feed, tmp_path):
    import tests.test_sinks as sinks

    feed("a b a")
    folder = tmp_path / "db"
    folder.mkdir()
    where = str(folder)
    counts = words.stream_word_counts(line_stream(spark, feed.folder))
    writer = RowReplacer(lambda: sinks.FileConnection(where), "tb_word_count", ["word", "count"])
    drain(counts.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).foreach(writer))
    assert [line.partition("|")[2] for line in sinks.written(folder)] == ["('a', 2)", "('b', 1)"]


def test_console_and_kafka_settings(spark, feed, tmp_path):
    feed("hello")
    lines = line_stream(spark, feed.folder)
    query = drain(console_sink(lines, "append", 10).option("checkpointLocation", str(tmp_path / "ck")))[0]
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    assert kafka_options("h:9092", "orders", 1000) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "orders", "maxOffsetsPerTrigger": "1000",
    }
