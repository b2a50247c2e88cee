"""Search-log analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import query_terms, script_runs, text_runs
from ..operators.aggregates import count_by, count_summary
from ..operators.caching import cached
from ..operators.parsing import explode_words, parse_search_log
from ..operators.ranking import ranked, top_k
from ..operators.terms import han_terms, is_han
from ..schemas import SEARCH_LOG
from ..workspace import new_folder


def search_records(lines: DataFrame, **options) -> DataFrame:
    return parse_search_log(lines, SEARCH_LOG, **options)


def term_counts(records: DataFrame, text: str = "query_words") -> DataFrame:
    """How often each term occurs.

    Runs are counted first and only the distinct ones are taken apart into terms, so the costly
    pattern runs over the vocabulary and not over the texts.
    """
    runs = count_by(explode_words(records, text_runs(text)), "word", name="runs")
    terms = runs.select(F.explode(query_terms("word")).alias("word"), "runs")
    return terms.groupBy("word").agg(F.sum("runs").alias("count"))


def learned_term_counts(records: DataFrame, text: str = "query_words", **limits) -> DataFrame:
    """How often each term occurs, Han runs being cut into the terms that the texts themselves teach.

    Texts are read once for their distinct runs; everything after works on these. ``limits`` are those of
    ``operators.terms.learned_terms`` and ``longest``.
    """
    spark = records.sparkSession
    path = new_folder(spark, "runs")
    count_by(explode_words(records, script_runs(text)), "word", name="runs").write.parquet(path)
    runs = spark.read.parquet(path)
    cut = han_terms(runs.where(is_han(F.col("word"))), **limits)
    terms = cut.select(F.explode("terms").alias("word"), "runs").unionByName(runs.where(~is_han(F.col("word"))))
    return terms.groupBy("word").agg(F.sum("runs").alias("count"))


def top_terms(records: DataFrame, text: str = "query_words", k: int = 10) -> DataFrame:
    return top_k(term_counts(records, text), {"count": "desc"}, ["word"], k)


def clicks_per_query(records: DataFrame, user: str = "user_id", query: str = "query_words") -> DataFrame:
    return count_by(records, user, query)


def top_clicks(records: DataFrame, user: str = "user_id", query: str = "query_words", k: int = 10) -> DataFrame:
    return top_k(clicks_per_query(records, user, query), {"count": "desc"}, [user, query], k)


def click_summary(records: DataFrame, user: str = "user_id", query: str = "query_words") -> DataFrame:
    return count_summary(clicks_per_query(records, user, query))


def searches_per_hour(records: DataFrame, time: str = "query_time") -> DataFrame:
    """Searches per hour of day, busiest first; the hour is the first two characters of the time."""
    return ranked(count_by(records, F.substring(time, 1, 2).alias("hour")), {"count": "desc"}, ["hour"])


def write_search_reports(lines: DataFrame, folder: str) -> None:
    """All four reports from one parse of the log."""
    with cached(search_records(lines)) as records:
        reports = {
            "top_terms": top_terms(records),
            "top_clicks": top_clicks(records),
            "click_summary": click_summary(records),
            "searches_per_hour": searches_per_hour(records),
        }
        for name, report in reports.items():
            report.write.mode("overwrite").parquet(f"{folder}/{name}")
