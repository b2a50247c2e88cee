"""Report days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_text(as_of: date | None = None) -> Column:
    """``as_of`` (default: the current day) as ``yyyy-MM-dd`` text."""
    return F.date_format(_day(as_of), "yyyy-MM-dd")


def day_before(as_of: date | None = None) -> Column:
    """The day before ``as_of`` as ``yyyy-MM-dd`` text, the partition value reports read."""
    return F.date_sub(_day(as_of), 1).cast("string")


def _day(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)
