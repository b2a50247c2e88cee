"""Line and payload parsing; every function works on tables and on streams."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.text import SPACES, field_count, trimmed_fields
from .rejects import PAYLOAD, REASON, good_rows, with_reason

PLAIN_TYPES = (StringType,)


def non_blank(lines: DataFrame, value: str = "value") -> DataFrame:
    """Drop null lines and lines that trim to nothing; the match ends at the first visible character."""
    return lines.where(F.col(value).rlike(r"[^\x00-\x20]"))


def has_fields(lines: DataFrame, value: str = "value", delimiter: str = ",") -> DataFrame:
    """Keep records with at least one field; only null and delimiter-only text goes.

    Blank text counts as one field and stays.
    """
    only_delimiters = rf"\A[\x00-\x20]*(?:{re.escape(delimiter)})+[\x00-\x20]*\z"
    return lines.where(~F.col(value).rlike(only_delimiters))


def well_formed(lines: DataFrame, delimiter: str, fields: int, value: str = "value") -> DataFrame:
    """Keep lines whose trimmed text has exactly ``fields`` fields."""
    return lines.where(field_count(value, delimiter) == fields)


def field(value: str, delimiter: str, position: int) -> Column:
    """One field of the trimmed text, null when the line is shorter."""
    return F.get(trimmed_fields(value, delimiter), F.lit(position))


def parse_lines(
    lines: DataFrame,
    delimiter: str,
    schema: StructType,
    value: str = "value",
    strict: bool = True,
    rejected: Observation | None = None,
) -> DataFrame:
    """Typed records from delimited lines with the right number of fields.

    ``strict`` fails on a field that does not convert, as the text jobs do; otherwise such a record
    is dropped. ``rejected`` observes how many lines were read and how many were kept.
    """
    names = schema.fieldNames()
    parts = lines.select(trimmed_fields(value, delimiter).alias("parts"))
    right_size = F.coalesce(F.size("parts") == len(names), F.lit(False))
    columns, converts = [], F.lit(True)
    for position, target in enumerate(schema.fields):
        text = F.get("parts", F.lit(position))
        if isinstance(target.dataType, PLAIN_TYPES):
            columns.append(text.alias(target.name))
            continue
        columns.append((text.cast if strict else text.try_cast)(target.dataType).alias(target.name))
        if not strict:
            converts = converts & text.try_cast(target.dataType).isNotNull()
    kept = right_size & converts
    if rejected is not None:
        parts = parts.observe(
            rejected, F.count(F.lit(1)).alias("lines"), F.count_if(kept).alias("kept")
        )
    return parts.where(kept).select(*columns)


def checked_lines(lines: DataFrame, delimiter: str, schema: StructType, value: str = "value") -> DataFrame:
    """The columns of ``schema`` beside each line and the reason it is rejected for: its ``fields`` or a column's type.

    Fields that do not convert are null; a good line has the right number of fields and converts in all of them.
    """
    names = schema.fieldNames()
    parts = lines.select(F.col(value).alias(PAYLOAD), trimmed_fields(value, delimiter).alias("parts"))
    texts = {name: F.get("parts", F.lit(position)) for position, name in enumerate(names)}
    columns = {f.name: texts[f.name].try_cast(f.dataType) for f in schema.fields}
    faults = {"fields": F.coalesce(F.size("parts") != len(names), F.lit(True))}
    for f in schema.fields:
        if not isinstance(f.dataType, PLAIN_TYPES):
            faults[f.name] = columns[f.name].isNull()
    return with_reason(parts, faults).select(*[c.alias(n) for n, c in columns.items()], PAYLOAD, REASON)


def parse_search_log(lines: DataFrame, schema: StructType, **options) -> DataFrame:
    """Search-log records; the brackets around the query text are removed."""
    return parse_lines(lines, SPACES, schema, **options).withColumn(
        "query_words", F.regexp_replace("query_words", r"\[|\]", "")
    )


def explode_words(lines: DataFrame, words: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word, carrying the columns named in ``keep``."""
    return lines.select(*keep, F.explode(words).alias("word"))


def explode_line_words(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word of each untrimmed line.

    An empty word counts where it leads: for an empty line, and for an indented line with text.
    Splitting leaves one at either end, so the leading one is told by its position.
    """
    leads = (F.col(value) == "") | F.col(value).rlike(r"\S")
    split = lines.select(*keep, leads.alias("leads"), F.posexplode(F.split(value, SPACES)).alias("at", "word"))
    return split.where("word <> '' OR (at = 0 AND leads)").select(*keep, "word")


def timed_words(
    lines: DataFrame, time_first: bool = True, value: str = "value", strict: bool = False, rejected: Observation | None = None
) -> DataFrame:
    """Words with their event time from ``time,words`` lines (or ``words,time``).

    A line without both parts or with an unreadable time is dropped; ``strict`` fails instead.
    ``rejected`` observes how many lines were read and how many had a time; a stream names its
    observation and finds the counts in its progress.
    """
    parts = non_blank(lines, value).select(trimmed_fields(value, ",").alias("parts"))
    time_at, words_at = (0, 1) if time_first else (1, 0)
    if strict:
        stamp = F.to_timestamp(F.element_at("parts", time_at + 1))
        words = F.element_at("parts", words_at + 1)
    else:
        stamp = F.get("parts", F.lit(time_at)).try_cast("timestamp")
        words = F.get("parts", F.lit(words_at))
    timed = parts.select(stamp.alias("time"), words.alias("words"))
    if rejected is not None:
        timed = timed.observe(rejected, F.count(F.lit(1)).alias("lines"), F.count("time").alias("kept"))
    if not strict:
        timed = timed.where("time IS NOT NULL")
    return explode_line_words(timed, "words", ("time",))


def checked_times(lines: DataFrame, time_first: bool = True, value: str = "value") -> DataFrame:
    """``time`` and ``words`` of each line with text, beside the line and the reason it is rejected for."""
    parts = non_blank(lines, value).select(F.col(value).alias(PAYLOAD), trimmed_fields(value, ",").alias("parts"))
    time_at, words_at = (0, 1) if time_first else (1, 0)
    timed = parts.select(F.get("parts", F.lit(time_at)).try_cast("timestamp").alias("time"), F.get("parts", F.lit(words_at)).alias("words"), PAYLOAD)
    return with_reason(timed, {"time": F.col("time").isNull(), "words": F.col("words").isNull()})


def words_at_times(checked: DataFrame) -> DataFrame:
    """One row per word of the good lines of ``checked_times``, with the time of the line."""
    return explode_line_words(good_rows(checked), "words", ("time",))


def parse_payload(records: DataFrame, schema: StructType, value: str = "value", payload: bool = False) -> DataFrame:
    """Flat columns from a JSON payload, parsed once for all fields; ``payload`` keeps its text beside them."""
    text = F.col(value).cast("string")
    parsed = records.select(F.from_json(text, schema).alias("parsed"), text.alias("payload"))
    return parsed.select("parsed.*", *["payload"] * payload)


def to_payload(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key`` and JSON ``value`` columns; null fields are left out of the JSON."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
