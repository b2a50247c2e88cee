from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyflow.operators.aggregates import mean_by, mean_by_sql, pivot_sum
from tallyflow.operators.parsing import has_fields, non_blank, parse_lines
from tallyflow.plans import ads, calls, devices, persons, ratings, search, words
from tallyflow.schemas import AD_EVENT, PERSON, RATING, SEARCH_LOG
from tallyflow.sources import literal_rows, read_json, read_lines

SEARCH_LINES = [
    "00:00:01\tu1\t[spark]\t1\t1\thttp://a",
    "00:10:00\tu1\t[spark]\t2\t2\thttp://b",
    "01:00:00\tu2\t[flink sql]\t1\t1\thttp://d",
    "01:30:00\tu2\t[hive]\t1\t1\thttp://c",
    "x y",
]


def test_word_counts_batch_and_stream_rules(lines):
    text = lines("hadoop spark spark", " hive spark", "")
    assert {r.word: r["count"] for r in words.word_counts(text).collect()} == {"spark": 3, "hadoop": 1, "hive": 1, "": 2}
    assert {r.word: r["count"] for r in words.stream_word_counts(text).collect()} == {"spark": 3, "hadoop": 1, "hive": 1}


def test_top_k_ways(lines):
    counts = words.word_counts(lines("a a a b b c c d"))
    assert [r.word for r in words.most_frequent(counts, 3).collect()] == ["a", "b", "c"]
    assert [r.word for r in words.least_frequent(counts, 2).collect()] == ["d", "b"]


def test_search_log(lines):
    records = search.search_records(lines(*SEARCH_LINES))
    assert records.count() == 3
    assert records.schema.simpleString() == SEARCH_LOG.simpleString()
    clicks = {(r.user_id, r.query_words): r["count"] for r in search.clicks_per_query(records).collect()}
    assert clicks == {("u1", "spark"): 2, ("u2", "hive"): 1}
    assert tuple(search.click_summary(records).first()) == (2, 1, 1.5)
    assert [tuple(r) for r in search.searches_per_hour(records).collect()] == [("00", 2), ("01", 1)]
    assert [tuple(r) for r in search.top_terms(records).collect()] == [("spark", 2), ("hive", 1)]


def test_search_reports_written(spark, lines, tmp_path):
    search.write_search_reports(lines(*SEARCH_LINES), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/top_clicks").count() == 2
    assert spark.read.parquet(f"{tmp_path}/searches_per_hour").count() == 2


RATING_LINES = ["1::10::5::978300760", "2::10::4::978300761", "3::20::3::978300762", "bad::row", "4::20::5::"]


def test_ratings(lines):
    records = ratings.rating_records(lines(*RATING_LINES))
    assert records.schema.simpleString() == RATING.simpleString()
    for form in (ratings.top_rated, ratings.top_rated_sql):
        assert [tuple(r) for r in form(records, min_count=0).collect()] == [("10", 4.5, 2), ("20", 3.0, 1)]
        assert [r.item_id for r in form(records, min_count=1).collect()] == ["10"]


def test_top_rated_is_stable_on_ties(spark):
    rows = spark.createDataFrame([(str(i), 3.0) for i in range(30)], "item_id string, rating double")
    expected = sorted(str(i) for i in range(30))[:10]
    for parts in (1, 7):
        assert [r.item_id for r in ratings.top_rated(rows.repartition(parts), min_count=0).collect()] == expected


def test_ratings_written(spark, lines, tmp_path):
    report = ratings.top_rated(ratings.rating_records(lines(*RATING_LINES)), min_count=0)
    ratings.write_top_rated(report, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert spark.read.csv(str(tmp_path / "csv")).count() == 2


def test_strict_and_lenient_parsing(lines):
    bad = lines("1\t10\tfive\t978300760", "2\t10\t4\t978300761", "short\tline")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_lines(bad, "\t", RATING).collect()
    seen = Observation()
    assert [r.user_id for r in parse_lines(bad, "\t", RATING, strict=False, rejected=seen).collect()] == ["2"]
    assert seen.get == {"lines": 3, "kept": 1}


def test_line_filters(spark):
    frame = spark.createDataFrame([("a,b",), (" ,, ",), (",,",), ("  ",), (None,), ("",)], "value string")
    assert [r.value for r in non_blank(frame).collect()] == ["a,b", " ,, ", ",,"]
    assert [r.value for r in has_fields(frame).collect()] == ["a,b", "  ", ""]


def test_literal_tables(spark):
    counts = literal_rows(spark, [("spark", 3), ("hadoop", 1), ("hive", 2)], "value string, count int")
    for values in (None, ["hadoop", "hive", "spark"]):
        assert pivot_sum(counts, "value", "count", values).first().asDict() == {"hadoop": 1, "hive": 2, "spark": 3}
    said = counts.withColumnRenamed("value", "word")
    assert words.wide_counts(said, "spark", ["hadoop", "hive", "spark"]).first().asDict() == {"hadoop": 1, "hive": 2, "spark": 3, "type": "spark"}
    assert words.wide_counts(said, "spark").first().asDict() == {"type": "spark", "part": 0, "counts": {"hadoop": 1, "hive": 2, "spark": 3}}
    scores = literal_rows(spark, [("a", "x", 1), ("a", "y", 2), ("a", "z", 2), ("b", "x", 9)], "name string, subject string, score int")
    for form in (mean_by, mean_by_sql):
        got = {tuple(r) for r in form(scores, "name", "score", "avg_score").collect()}
        assert got == {("a", 1.67), ("b", 9.0)}


KPI_INPUTS = (
    "requestmode processnode adplatformproviderid iseffective isbilling isbid iswin adorderid adcreativeid winprice adpayment"
).split()
KPI_ROWS = [
    (1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    (1, 2, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    (1, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    (2, 0, 100000, 1, 1, 1, 1, 200001, 200001, 5500, 2500),
    (3, 0, 100000, 1, 1, 1, 1, 200001, 200001, 1999, 999),
    (3, 0, 100000, 1, 1, 0, 1, 0, 0, 0, 0),
    (2, 0, 99999, 1, 1, 0, 0, 1, 1, 0, 0),
    (1, 0, 100000, 1, 1, 1, 0, 5, 0, 0, 0),
    (2, 0, 100000, 1, 1, 0, 1, 200001, 200001, 3000, 4000),
]
STRICT = (3, 2, 1, 3, 3, 3, 1, 1, 1, 9, 2, 1.0, 0.33, 1.0)
BASIC = (3, 2, 1, 3, 4, 3, 2, 3, 2, 9, 6, 1.33, 0.67, 0.67)


@pytest.fixture()
def ad_rows(spark):
    rows = [("P", "C", *map(float, r)) for r in KPI_ROWS] + [("P", "D", 1.0, 1.0, *[0.0] * 9)]
    frame = spark.createDataFrame(rows, ["province", "city", *KPI_INPUTS])
    return frame.select(
        "province",
        "city",
        *[F.col(c).cast("double" if c in ("winprice", "adpayment") else "bigint").alias(c) for c in KPI_INPUTS],
    )


def test_kpi_variants(ad_rows):
    day = date(2024, 2, 1)
    measures = (*ads.REGION_KPIS.values,)
    for variant, expected in (("strict", STRICT), ("basic", BASIC)):
        rows = ads.region_kpis(ad_rows, as_of=day, variant=variant).collect()
        assert [(r.province, r.city, r.report_date) for r in rows] == [("P", "C", "2024-01-31")]
        assert tuple(rows[0][m] for m in measures) == expected
    for form in (ads.region_kpis_sql, ads.region_kpis_two_step):
        report = form(ad_rows, day)
        assert report.columns[:3] == ["report_date", "province", "city"]
        assert [tuple(r[m] for m in measures) for r in report.collect()] == [BASIC]
        assert form(ad_rows, None).where("report_date = cast(date_sub(current_date(), 1) as string)").count() == 1


def test_kpi_types_and_other_groupings(ad_rows):
    report = ads.region_kpis(ad_rows, by=("city",))
    types = dict(report.dtypes)
    assert {types[m] for m in ads.REGION_KPIS.values[:11]} == {"bigint"}
    assert {types[m] for m in ads.REGION_KPIS.values[11:]} == {"double"}
    assert report.count() == 1


def test_region_counts(ad_rows):
    rows = ads.region_counts(ad_rows, as_of=date(2024, 2, 1)).collect()
    assert [tuple(r) for r in rows] == [("P", "C", 9, "2024-01-31"), ("P", "D", 1, "2024-01-31")]


def test_ad_event_schema():
    kinds = [f.dataType.simpleString() for f in AD_EVENT.fields[:-1]]
    assert (len(kinds), kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (93, 25, 12, 56)
    assert AD_EVENT.fieldNames()[-1] == "date_str"


def test_calls(lines):
    good = "mast_7,155 0001234,13300004321,success,1700000000000,61"
    got = calls.calls_with_status(lines(good, good.replace("success", "busy"), good.rpartition(",")[0]))
    assert [r.value for r in got.collect()] == [good]


DEVICE_LINES = [
    '{"device":"sensor_a","deviceType":"meter","signal":71.5,"time":1700000000000}',
    '{"device":"sensor_b","deviceType":"meter","signal":12.0,"time":1700000000000}',
    '{"device":"sensor_c","deviceType":"meter","signal":72.5,"time":1700000000000}',
    '{"device":"sensor_d","deviceType":"meter","signal":"weak","time":1700000000000}',
    "  ",
]


def test_devices(lines):
    signals = devices.device_signals(lines(*DEVICE_LINES))
    for form in (devices.device_stats, devices.device_stats_sql):
        assert [tuple(r) for r in form(signals).collect()] == [("meter", 2, 72.0)]


def test_hobbies(spark):
    rows = [("mia", 21, "chess"), ("leo", 18, "chess"), ("eva", 24, "sailing"), ("ben", 25, "sailing"), ("ida", 52, "sailing")]
    got = persons.hobby_ranking(spark.createDataFrame(rows, PERSON)).collect()
    assert [tuple(r) for r in got] == [("chess", 2), ("sailing", 1)]


def test_text_and_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"name":"x","n":1}\n{"name":"y"}\n')
    path = str(tmp_path / "a.json")
    assert read_lines(spark, path).columns == ["value"]
    assert read_json(spark, path).dtypes == [("n", "bigint"), ("name", "string")]
    assert read_json(spark, path, PERSON).columns == ["name", "age", "hobby"]


def test_terms_counted_by_run_equal_terms_of_whole_texts(spark):
    from tallyflow.functions import query_terms

    texts = ["买spark书籍 spark 中华人民 中", "中华 人民,spark2 ⺀中 été-été 買", "", " 中 ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "query_words string")
    direct = rows.select(F.explode(query_terms("query_words")).alias("word")).groupBy("word").count()
    expected = {r["word"]: r["count"] for r in direct.collect()}
    assert {r["word"]: r["count"] for r in search.term_counts(rows).collect()} == expected
    assert expected["中华"] == 2 and expected["spark"] == 2
