"""Ad events: daily extract and the region reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_before
from ..operators.aggregates import count_by
from ..operators.lookups import locate_ips
from ..operators.ranking import ranked
from ..sinks.keyed import KeyedTable
from ..sinks.tables import REGION_COUNTS, REGION_KPIS

REGION = ("province", "city")
REPORT_DAY = "report_date"

# The bounds the measures are defined with.
RTB_PLATFORM = 100000
REAL_ORDER = 200000
REAL_CREATIVE = 200000
MONEY_UNIT = 1000

RATES = {
    "success_rtx_rate": ("success_rtx_cnt", "join_rtx_cnt"),
    "ad_click_rate": ("ad_click_cnt", "ad_show_cnt"),
    "media_click_rate": ("media_click_cnt", "media_show_cnt"),
}
NON_ZERO = ("join_rtx_cnt", "success_rtx_cnt", "ad_show_cnt", "ad_click_cnt", "media_show_cnt", "media_click_cnt")


UNKNOWN = "unknown"
#: Columns the region reports read.
REPORT_COLUMNS = (
    *REGION, "requestmode", "processnode", "adplatformproviderid", "iseffective", "isbilling", "isbid", "iswin", "adorderid", "adcreativeid",
    "winprice", "adpayment",
)


def known_regions(events: DataFrame) -> DataFrame:
    """Events with a named region: what could not be located is reported under ``unknown``, not left out."""
    return events.withColumns({name: F.coalesce(name, F.lit(UNKNOWN)) for name in REGION})


def daily_extract(events: DataFrame, ranges: DataFrame, as_of: date | None = None) -> DataFrame:
    """Events with the region of their address and the day they belong to."""
    return locate_ips(events, ranges).withColumn("date_str", day_before(as_of))


def region_counts(events: DataFrame, by: Sequence[str] = REGION, as_of: date | None = None) -> DataFrame:
    """Events per region, most first."""
    counts = ranked(count_by(events, *by), {"count": "desc"}, list(by))
    return counts.withColumn(REPORT_DAY, day_before(as_of))


def _all(*conditions: Column) -> Column:
    return reduce(Column.__and__, conditions)


def _count_conditions(strict: bool) -> dict[str, Column]:
    mode, node = F.col("requestmode"), F.col("processnode")
    effective, billing = F.col("iseffective") == 1, F.col("isbilling") == 1
    bid, win, ordered = F.col("isbid") == 1, F.col("iswin") == 1, F.col("adorderid") != 0
    rtb = _all(F.col("adplatformproviderid") >= RTB_PLATFORM, effective, billing)
    only_strict = lambda *conditions: conditions if strict else ()
    return {
        "orginal_req_cnt": (mode == 1) & (node >= 1),
        "valid_req_cnt": (mode == 1) & (node >= 2),
        "ad_req_cnt": (mode == 1) & (node == 3),
        "join_rtx_cnt": _all(rtb, bid, ordered),
        "success_rtx_cnt": _all(rtb, win, *only_strict(ordered)),
        "ad_show_cnt": (mode == 2) & effective,
        "ad_click_cnt": _all(mode == 3, effective, *only_strict(ordered)),
        "media_show_cnt": _all(mode == 2, effective, billing, *only_strict(bid, win)),
        "media_click_cnt": _all(mode == 3, effective, billing, *only_strict(bid, win)),
    }


def _money_measures(strict: bool) -> dict[str, Column]:
    paid = _all(
        F.col("adplatformproviderid") >= RTB_PLATFORM,
        F.col("iseffective") == 1,
        F.col("isbilling") == 1,
        F.col("iswin") == 1,
        F.col("adorderid") > REAL_ORDER,
        F.col("adcreativeid") > REAL_CREATIVE,
    )
    cost = paid & (F.col("isbid") == 1) if strict else paid
    return {
        name: F.sum(F.when(condition, F.floor(F.col(price) / MONEY_UNIT)).otherwise(0))
        for name, condition, price in (("dsp_pay_money", paid, "winprice"), ("dsp_cost_money", cost, "adpayment"))
    }


def region_measures(events: DataFrame, by: Sequence[str] = REGION, variant: str = "strict") -> DataFrame:
    """The eleven measures per region in one aggregation.

    ``strict`` is the definition reports are run with; ``basic`` is the looser one of the SQL
    reports, without the order check on wins and clicks and the bid checks on media and cost.
    """
    strict = {"strict": True, "basic": False}[variant]
    counts = [F.count_if(condition).alias(name) for name, condition in _count_conditions(strict).items()]
    money = [total.alias(name) for name, total in _money_measures(strict).items()]
    return events.groupBy(*by).agg(*counts, *money)


def with_rates(measures: DataFrame) -> DataFrame:
    """Drop regions with a zero among the rate inputs, then add the three rates."""
    usable = measures.where(_all(*[F.col(name) != 0 for name in NON_ZERO]))
    return usable.withColumns({name: F.round(F.col(a) / F.col(b), 2) for name, (a, b) in RATES.items()})


def region_kpis(
    events: DataFrame, by: Sequence[str] = REGION, as_of: date | None = None, variant: str = "strict"
) -> DataFrame:
    return with_rates(region_measures(events, by, variant)).withColumn(REPORT_DAY, day_before(as_of))


# One SQL text of the basic measures serves both SQL forms; {events} is the input, :as_of the run day.
_FLAGS = """
    SELECT *,
           adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1 AS rtb,
           coalesce(adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1 AND iswin = 1
                    AND adorderid > 200000 AND adcreativeid > 200000, false) AS paid
    FROM {events}
"""
_MEASURES = f"""
    SELECT cast(date_sub(coalesce(:as_of, current_date()), 1) AS string) AS report_date, province, city,
           count_if(requestmode = 1 AND processnode >= 1) AS orginal_req_cnt,
           count_if(requestmode = 1 AND processnode >= 2) AS valid_req_cnt,
           count_if(requestmode = 1 AND processnode = 3) AS ad_req_cnt,
           count_if(rtb AND isbid = 1 AND adorderid <> 0) AS join_rtx_cnt,
           count_if(rtb AND iswin = 1) AS success_rtx_cnt,
           count_if(requestmode = 2 AND iseffective = 1) AS ad_show_cnt,
           count_if(requestmode = 3 AND iseffective = 1) AS ad_click_cnt,
           count_if(requestmode = 2 AND iseffective = 1 AND isbilling = 1) AS media_show_cnt,
           count_if(requestmode = 3 AND iseffective = 1 AND isbilling = 1) AS media_click_cnt,
           sum(if(paid, floor(winprice / 1000), 0)) AS dsp_pay_money,
           sum(if(paid, floor(adpayment / 1000), 0)) AS dsp_cost_money
    FROM ({_FLAGS})
    GROUP BY province, city
"""
_RATES = """
    SELECT *,
           round(success_rtx_cnt / join_rtx_cnt, 2) AS success_rtx_rate,
           round(ad_click_cnt / ad_show_cnt, 2) AS ad_click_rate,
           round(media_click_cnt / media_show_cnt, 2) AS media_click_rate
    FROM {measures}
    WHERE 0 NOT IN (join_rtx_cnt, success_rtx_cnt, ad_show_cnt, ad_click_cnt, media_show_cnt, media_click_cnt)
"""


def region_kpis_sql(events: DataFrame, as_of: date | None = None) -> DataFrame:
    """Basic report as one statement with a common table expression."""
    text = f"WITH measures AS ({_MEASURES})" + _RATES.replace("{measures}", "measures")
    return events.sparkSession.sql(text, args={"as_of": as_of}, events=events)


def region_kpis_two_step(events: DataFrame, as_of: date | None = None) -> DataFrame:
    """Basic report as two statements, the second over a view of the first."""
    spark = events.sparkSession
    events.createOrReplaceTempView("ad_events_view")
    measures = spark.sql(_MEASURES.replace("{events}", "ad_events_view"), args={"as_of": as_of})
    measures.createOrReplaceTempView("ad_measures_view")
    return spark.sql(_RATES.replace("{measures}", "ad_measures_view"))


def store_region_counts(report: DataFrame, table: KeyedTable) -> None:
    table.upsert(report.select(*REGION_COUNTS.keys, *REGION_COUNTS.values), unique=True)


def store_region_kpis(report: DataFrame, table: KeyedTable) -> None:
    table.upsert(report.select(*REGION_KPIS.keys, *REGION_KPIS.values), unique=True)
