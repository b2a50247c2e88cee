"""Reuse of a table that several actions read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(rows: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist within a ``with`` block. Blocks lost with an executor are recomputed from lineage."""
    kept = rows.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
