"""Job settings."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# The nine cities the key-city report keeps.
KEY_CITIES = ("北京市", "上海市", "深圳市", "广州市", "杭州市", "成都市", "南京市", "武汉市", "西安市")


@dataclass(frozen=True)
class Settings:
    """Parameters shared by the jobs.

    ``as_of`` is read once, so an extract and the reports that follow it agree on the day even
    when the run crosses midnight.
    """

    as_of: date = field(default_factory=date.today)
    min_ratings: int = 2000
    top_items: int = 10
