"""Sorted and limited results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranked(rows: DataFrame, by: dict[str, str], ties: list[str]) -> DataFrame:
    """Order by ``by`` (column to ``"asc"``/``"desc"``), then by the unique ``ties`` columns."""
    return rows.orderBy(*_sort_keys(by, ties))


def top_k(rows: DataFrame, by: dict[str, str], ties: list[str], k: int) -> DataFrame:
    """First ``k`` rows of that order; each task keeps only its own best ``k``."""
    return ranked(rows, by, ties).limit(k)


def _sort_keys(by: dict[str, str], ties: list[str]) -> list[Column]:
    keys = [F.col(name).desc() if way == "desc" else F.col(name).asc() for name, way in by.items()]
    return keys + [F.col(name).asc() for name in ties]
