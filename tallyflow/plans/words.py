"""Word counts, from tables and from line streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed_words
from ..operators.aggregates import count_by, pivot_sum
from ..operators.parsing import explode_line_words, explode_words, non_blank
from ..operators.ranking import top_k
from ..sinks.cells import wide_maps


def word_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Counts over untrimmed lines; indented and empty lines count an empty word."""
    return count_by(explode_line_words(lines, value), "word")


def stream_word_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Running counts over trimmed, non-blank lines."""
    return count_by(explode_words(non_blank(lines, value), trimmed_words(value)), "word")


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, {"count": "desc"}, ["word"], k)


def least_frequent(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, {"count": "asc"}, ["word"], k)


def wide_counts(counts: DataFrame, kind: str, words: list[str] | None = None) -> DataFrame:
    """Counts as wide rows tagged with their ``type``.

    Named ``words`` give one row with a column each. Without them the vocabulary is open: rows hold a map from word to count.
    """
    if words is not None:
        return pivot_sum(counts, "word", "count", words).withColumn("type", F.lit(kind))
    fields = counts.select(F.lit(kind).alias("key"), F.col("word").alias("field"), F.col("count").alias("value"))
    return wide_maps(fields, F.sum).withColumnsRenamed({"key": "type", "fields": "counts"})
