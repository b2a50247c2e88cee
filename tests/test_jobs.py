import json

import pytest

from tallyflow.jobs import main
from tallyflow.sinks.cells import FIELD_KEYS
from tallyflow.sinks.keyed import keyed_table
from tests.test_reports import KPI_INPUTS, KPI_ROWS, RATING_LINES, SEARCH_LINES, STRICT
from tests.test_streaming import RAW, record

DICTIONARY = [
    "192.0.2.0|192.0.2.255|中国|0|湖北省|武汉市|one",
    "203.0.113.0|203.0.113.255|中国|0|河北省|保定市|电信",
    "198.51.100.0|198.51.100.255|中国|0|四川省|绵阳市|two",
    "233.252.0.0|233.252.0.255|中国|0|陕西省|西安市|电信",
    "1.0.0.0|1.0.0.255|too|short",
]


@pytest.fixture()
def text(tmp_path):
    def write(name, lines):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / "part.txt").write_text("\n".join(lines) + "\n")
        return str(folder)

    return write


def test_usage():
    with pytest.raises(SystemExit):
        main(["word-count", "only-input"])


def test_text_jobs(spark, text, tmp_path):
    main(["word-count", text("w", ["a b a"]), str(tmp_path / "out")], spark)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out-*")).collect()) == ["a\t2", "b\t1"]
    for _ in range(2):
        main(["word-count", text("w", ["a b a"]), str(tmp_path / "cells"), "--to", "cells"], spark)
        main(["word-count", text("w", ["a b a"]), str(tmp_path / "table"), "--to", "table"], spark)
    cells = keyed_table(spark, str(tmp_path / "cells"), "row_key", "family", "qualifier").read()
    assert sorted((r.row_key, r.value) for r in cells.collect()) == [("a", "2"), ("b", "1")]
    assert keyed_table(spark, str(tmp_path / "table"), "word").read().count() == 2
    main(["search-report", text("s", SEARCH_LINES), str(tmp_path / "search")], spark)
    assert spark.read.parquet(str(tmp_path / "search/click_summary")).first().max_count == 2
    main(["top-rated", text("r", RATING_LINES), str(tmp_path / "top"), "--min-count", "1"], spark)
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "top")).collect()] == [("10", "4.5", "2")]


def test_ads_jobs(spark, text, tmp_path):
    events = [json.dumps({**dict(zip(KPI_INPUTS, map(int, row))), "ip": "203.0.113.148"}) for row in KPI_ROWS]
    events.append(json.dumps({"ip": "10.16.48.97"}))
    run = ["ads-extract", text("events", events), text("ips", DICTIONARY), "ads_jobs", "--as-of", "2024-02-01"]
    main([*run, "--path", str(tmp_path / "table")], spark)
    for _ in range(2):
        main([*run, "--replace"], spark)
    assert spark.read.table("ads_jobs").count() == 10
    for _ in range(2):
        main(["ads-report", "ads_jobs", str(tmp_path / "report"), "--as-of", "2024-02-01"], spark)
    kpis = keyed_table(spark, str(tmp_path / "report/ads_region_analysis"), "report_date", "province", "city").read()
    assert [tuple(r) for r in kpis.collect()] == [("2024-01-31", "河北省", "保定市", *STRICT)]  # a rate of the unknown region would divide by zero
    counts = keyed_table(spark, str(tmp_path / "report/region_stat_analysis"), "report_date", "province", "city").read()
    assert sorted(tuple(r) for r in counts.collect()) == [("2024-01-31", "unknown", "unknown", 1), ("2024-01-31", "河北省", "保定市", 9)]


def test_overlapping_dictionary_is_refused(spark, text, tmp_path):
    ranges = text("ips", [*DICTIONARY, "203.0.113.9|203.0.113.20|中国|0|x|y|z"])
    with pytest.raises(ValueError, match="starts inside another"):
        main(["ads-extract", text("e", ['{"ip":"1.1.1.1"}']), ranges, "never"], spark)


def test_order_jobs(spark, text, tmp_path):
    source, ranges = text("orders", [record(o) for o in RAW]), text("ips", DICTIONARY)
    topic = str(tmp_path / "topic")
    main(["order-etl", source, ranges, topic, str(tmp_path / "c1"), "--once"], spark)
    main(["sales-totals", topic, str(tmp_path / "running"), str(tmp_path / "c2"), "--once"], spark)
    main(["sales-totals", topic, str(tmp_path / "daily"), str(tmp_path / "c3"), "--once", "--daily"], spark)
    total = keyed_table(spark, str(tmp_path / "running"), *FIELD_KEYS).read()
    assert total.where("field = 'global'").first().value == "504.30"
    days = keyed_table(spark, str(tmp_path / "daily"), *FIELD_KEYS).read()
    assert {r.key[-10:]: r.value for r in days.where("field = 'global'").collect()}["2022-06-07"] == "308.70"
    main(["index-orders", topic, str(tmp_path / "index"), str(tmp_path / "c4"), "--once"], spark)
    main(["put-orders", topic, str(tmp_path / "rows"), str(tmp_path / "c5"), "--once"], spark)
    assert keyed_table(spark, str(tmp_path / "index"), "orderId").read().count() == 4
    assert keyed_table(spark, str(tmp_path / "rows"), "row_key").read().count() == 4


def test_other_stream_jobs(spark, text, tmp_path):
    main(["word-totals", text("lines", ["a b a"]), str(tmp_path / "words"), str(tmp_path / "c1"), "--once"], spark)
    assert keyed_table(spark, str(tmp_path / "words"), "word").read().count() == 2
    line = "station_0,1,2,success,3,4"
    call = text("calls", [json.dumps({"key": "k", "value": v}) for v in (line, line.replace("success", "fail"))])
    main(["call-etl", call, str(tmp_path / "passed"), str(tmp_path / "c2"), "--once"], spark)
    assert [r.value for r in spark.read.json(str(tmp_path / "passed")).collect()] == [line]
    signal = text("devices", [json.dumps({"key": "k", "value": '{"deviceType":"db","signal":50}'})])
    main(["device-stats", signal, str(tmp_path / "c3"), "--once"], spark)


def test_marker_ends_a_job(spark, text, tmp_path):
    marker = tmp_path / "stop"
    marker.touch()
    run = ["word-totals", text("lines", ["a"]), str(tmp_path / "words"), str(tmp_path / "c1")]
    main([*run, "--stop-marker", str(marker), "--every", "1 second"], spark)
    assert not spark.streams.active
