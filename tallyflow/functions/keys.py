"""Composed keys of the key-value outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_row_key(user_id: Column | str = "userId", order_time: Column | str = "orderTime") -> Column:
    """Reversed user id and order time; reversing spreads neighbouring ids over the key space."""
    return F.concat(F.reverse(user_id), F.lit("_"), order_time)


def dated_key(prefix: str, day: Column | str) -> Column:
    """``prefix:yyyy-MM-dd``; a row without a day has the key ``prefix:unknown``, which no undated total uses."""
    day = F.col(day) if isinstance(day, str) else day
    return F.concat_ws(":", F.lit(prefix), F.coalesce(day.cast("string"), F.lit("unknown")))
