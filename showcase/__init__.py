"""Queries over the supplied tables, each with an equivalent SQL text where one exists."""

from . import batch, streams, tables  # noqa: F401  (their queries register on import)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
