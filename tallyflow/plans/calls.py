"""Call-log cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.parsing import field, well_formed
from ..schemas import CALL_LOG

STATUS_AT = CALL_LOG.fieldNames().index("call_status")


def calls_with_status(
    records: DataFrame, status: str = "success", value: str = "value", position: int = STATUS_AT
) -> DataFrame:
    """Call lines of one status, unchanged; a stateless filter, so any trigger can run it."""
    lines = well_formed(records, ",", len(CALL_LOG.fields), value)
    return lines.where(field(value, ",", position) == status)
