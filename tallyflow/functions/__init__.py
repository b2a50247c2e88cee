from .dates import day_before, day_text
from .keys import dated_key, order_row_key
from .net import ipv4_to_long, long_to_ipv4
from .text import field_count, java_split, line_words, query_terms, trim_ws, trimmed_words

__all__ = [
    "dated_key",
    "day_before",
    "day_text",
    "field_count",
    "ipv4_to_long",
    "java_split",
    "line_words",
    "long_to_ipv4",
    "order_row_key",
    "query_terms",
    "trim_ws",
    "trimmed_words",
]
