"""Hobby ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count_by
from ..operators.ranking import ranked

AGE_LIMIT = 25


def hobby_ranking(persons: DataFrame, under: int = AGE_LIMIT) -> DataFrame:
    """People under the age limit per hobby, most first; a stream needs complete mode to sort."""
    return ranked(count_by(persons.where(F.col("age") < under), "hobby"), {"count": "desc"}, ["hobby"])
