"""Every registered query against its SQL at the smallest scale."""

import pytest

import showcase
from __spark_entry__ import SMOKE_DATA, entry, oracle_sql, queries
from showcase import streams
from tallyflow.streaming.checkpoints import batch_files
from tests.compare import difference, duck


@pytest.fixture(scope="module")
def connection():
    return duck(SMOKE_DATA)


@pytest.mark.parametrize("name", sorted(showcase.QUERIES))
def test_query(spark, connection, name):
    assert difference(queries()[name](spark, SMOKE_DATA), connection, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_deliveries_grow_by_files_and_not_by_their_size(spark, connection, monkeypatch):
    made = {}
    keep = streams.new_folder
    monkeypatch.setattr(streams, "new_folder", lambda session, label: made.setdefault(label, keep(session, label)))
    monkeypatch.setattr(streams, "FILE_ROWS", 100, raising=False)
    assert difference(queries()["stream_amt_rejects"](spark, SMOKE_DATA), connection, oracle_sql()["stream_amt_rejects"]) is None
    files = spark.read.parquet(made["checked-orders"]).selectExpr("_metadata.file_path AS file").groupBy("file").count().collect()
    assert len(files) > 4 and max(r["count"] for r in files) <= 100
    read = batch_files(spark, f"{made['checked-totals']}/checkpoint")
    assert read.count() == len(files) and 1 < read.select("batch").distinct().count() <= 4
