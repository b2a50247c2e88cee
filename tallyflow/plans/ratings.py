"""Top rated items and score averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import rounded_mean
from ..operators.caching import cached
from ..operators.parsing import parse_lines
from ..operators.ranking import top_k
from ..schemas import RATING
from ..sinks.files import write_csv
from ..sinks.jdbc import write_jdbc


def rating_records(lines: DataFrame, delimiter: str = "::", **options) -> DataFrame:
    return parse_lines(lines, delimiter, RATING, **options)


def top_rated(
    ratings: DataFrame, item: str = "item_id", rating: str = "rating", min_count: int = 2000, k: int = 10
) -> DataFrame:
    """Best average rating among items with more than ``min_count`` ratings."""
    items = ratings.groupBy(item).agg(
        rounded_mean(rating).alias("avg_rating"), F.count(item).alias("cnt_rating")
    )
    frequent = items.where(F.col("cnt_rating") > min_count)
    return top_k(frequent, {"avg_rating": "desc", "cnt_rating": "desc"}, [item], k)


def top_rated_sql(
    ratings: DataFrame, item: str = "item_id", rating: str = "rating", min_count: int = 2000, k: int = 10
) -> DataFrame:
    """The same report in SQL."""
    return ratings.sparkSession.sql(
        f"""
        SELECT {item}, round(avg({rating}), 2) AS avg_rating, count({item}) AS cnt_rating
        FROM {{ratings}}
        GROUP BY {item}
        HAVING cnt_rating > {int(min_count)}
        ORDER BY avg_rating DESC, cnt_rating DESC, {item}
        LIMIT {int(k)}
        """,
        ratings=ratings,
    )


def write_top_rated(report: DataFrame, csv_path: str, jdbc: dict[str, str] | None = None) -> None:
    """Store a report of ``k`` rows as one CSV file and, when configured, as a database table."""
    with cached(report) as rows:
        if jdbc is not None:
            write_jdbc(rows, jdbc, mode="overwrite", connections=1)
        write_csv(rows, csv_path, single_file=True)
