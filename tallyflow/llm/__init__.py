"""Operators for preparing training text. Nothing outside this subpackage and the corpus pipeline imports it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# functions that run on executors travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from . import (  # noqa: E402,F401
    decontaminate,
    language,
    line_rules,
    mixing,
    pieces,
    pii,
    pivots,
    sharding,
    simhash,
    spelling,
    stripes,
    tag_paths,
    toxicity,
)
from .common import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
