from .cells import cells_of
from .files import (
    line_stream,
    literal_rows,
    parquet_stream,
    read_day,
    read_json,
    read_lines,
    read_table,
    separated_stream,
)
from .regions import newest_edition, publish_regions, read_regions
from .topics import kafka_options, rate_stream, topic_stream

__all__ = [
    "cells_of",
    "kafka_options",
    "line_stream",
    "literal_rows",
    "newest_edition",
    "parquet_stream",
    "publish_regions",
    "rate_stream",
    "read_day",
    "read_json",
    "read_lines",
    "read_regions",
    "read_table",
    "separated_stream",
    "topic_stream",
]
