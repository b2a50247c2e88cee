"""Text columns with the split and trim rules the line formats rely on.

Trimming removes every character up to U+0020, and splitting drops trailing empty fields. Spark's
own ``trim`` and ``split`` do neither, so the helpers below restate both with built-in expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# characters removed by trimming, and those matched by the regex class \s
LOW_CHARS = "".join(chr(code) for code in range(0x21))
SPACE_CHARS = " \t\n\x0b\f\r"
SPACES = r"\s+"

_HAN = r"\p{IsHan}"
_WORD = r"[\p{L}\p{N}&&[^\p{IsHan}]]"
# Looking ahead from each position captures a Han pair, a lone Han character, or a whole word that
# starts there; one character is then consumed, so pairs overlap and every text is read once.
RUN_PATTERN = r"[\p{L}\p{N}\p{IsHan}]+"
TERM_PATTERN = f"(?=({_HAN}{{2}}|(?<!{_HAN}){_HAN}(?!{_HAN})|(?<!{_WORD}){_WORD}+))(?s:.)"

HAN_RUN = f"{_HAN}+"
SCRIPT_RUN_PATTERN = f"{HAN_RUN}|{_WORD}+"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_ws(value: Column | str) -> Column:
    """Strip all characters up to U+0020 from both ends."""
    return F.trim(_column(value), F.lit(LOW_CHARS))


def java_split(value: Column | str, delimiter: str) -> Column:
    """Split on a regex and drop trailing empty fields; text without the delimiter stays whole."""
    text = _column(value)
    if delimiter == SPACES:
        tail, only_tail = SPACE_CHARS, r"\A\s+\z"
    elif len(delimiter) == 1:
        tail, delimiter = delimiter, re.escape(delimiter)
        only_tail = rf"\A(?:{delimiter})+\z"
    else:
        return _split_any(text, delimiter)
    nothing = F.array().cast("array<string>")
    return F.when(text.rlike(only_tail), nothing).otherwise(F.split(F.rtrim(text, F.lit(tail)), delimiter))


def _split_any(text: Column, delimiter: str) -> Column:
    parts = F.split(text, delimiter)
    from_end = F.array_position(F.reverse(F.transform(parts, lambda part: part != "")), True)
    kept = F.when(from_end == 0, 0).otherwise(F.size(parts) - from_end + 1)
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, 1, kept.cast("int")))


def trimmed_fields(value: Column | str, delimiter: str) -> Column:
    """Fields of the trimmed text."""
    text = trim_ws(value)
    # trimmed text cannot end in white space, so there is no trailing field to drop
    return F.split(text, delimiter) if delimiter in (SPACES, "\t") else java_split(text, delimiter)


def field_count(value: Column | str, delimiter: str) -> Column:
    """Number of fields in the trimmed text."""
    return F.size(trimmed_fields(value, delimiter))


def line_words(value: Column | str) -> Column:
    """Words of an untrimmed line: an indented or empty line keeps its leading empty word."""
    return java_split(value, SPACES)


def trimmed_words(value: Column | str) -> Column:
    """Words of a trimmed line."""
    return F.split(trim_ws(value), SPACES)


def text_runs(value: Column | str) -> Column:
    """Unbroken runs of letters, digits and Han characters; each holds whole terms."""
    return F.regexp_extract_all(_column(value), F.lit(RUN_PATTERN), 0)


def script_runs(value: Column | str) -> Column:
    """As ``text_runs``, but Han characters and others apart."""
    return F.regexp_extract_all(_column(value), F.lit(SCRIPT_RUN_PATTERN), 0)


def query_terms(value: Column | str) -> Column:
    """Search terms of a query text.

    Letter and digit runs are terms; a run of Han characters gives its overlapping pairs. This
    needs no statistics; ``operators.terms`` cuts Han runs by what the texts teach.
    """
    return F.regexp_extract_all(_column(value), F.lit(TERM_PATTERN), 1)
