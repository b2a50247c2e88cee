"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, packed, query, table, unpacked, words_of

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SMALL = 10_000  # sources up to which their table is broadcast


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``source`` and ``size``.

    Sources take the weights in turn, in code point order with null last. The budget is ``share`` times all sizes; a
    source gets ``most`` times its size at the utmost, and what it can't take goes to the others by weight. Filling in
    order of ``most * size / weight`` settles that in one pass: a source is full when the level of the rest reaches it.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1)
    ratio = F.col("source_size") * most / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    full = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(full) * F.lit(float(share))
    level = (budget - most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    filled = sums.withColumn("weight", weight.cast("bigint")).withColumn("level", level)
    top = F.max(F.when(ratio > F.col("level"), F.col("level"))).over(full)
    return filled.select(
        "source",
        "source_size",
        F.when(ratio <= F.col("level"), (F.col("source_size") * most).cast("double")).otherwise(F.col("weight") * top).alias("target"),
    )


def _chance(seed: int, *parts: Column) -> Column:
    """Number in [0, 1) from the MD5 of seed and parts, the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def with_copies(documents: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``documents`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    Each document is taken ``floor(rate)`` times, rate being its source's target over its size, and once more where the
    hash of seed, ``doc_id`` and size falls below the fraction. Null and blank texts have size 0; a null source is a
    source of its own; a source without words has target 0 and rate 0; repeated rows get the same copies. Other columns
    are kept, columns with one of the four names are replaced.
    """
    return unpacked(_planned(documents, seed, weights, share, most), PLAN, *PLAN)


PLAN = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _planned(documents: DataFrame, seed: int, weights: Sequence[int], share: float, most: int) -> DataFrame:
    key = F.struct(F.col("source").alias("s"))  # never null, so a null source is joined like any other
    sized = packed(documents, "doc_id", "source", "text").withColumn("mix_size", F.size(words_of(F.col("text"))).cast("bigint"))
    targets = source_targets(sized.select("source", F.col("mix_size").alias("size")), weights, share, most).select(
        key.alias("mix_key"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")
    )
    if documents.select("source").distinct().limit(SMALL + 1).count() <= SMALL:
        targets = F.broadcast(targets)
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    once = _chance(seed, F.col("doc_id"), F.col("mix_size")) < rate - F.floor(rate)
    return (
        sized.drop("text").withColumn("mix_key", key)
        .join(targets, "mix_key")
        .drop("mix_key")
        .withColumn("mix_copies", F.least(F.floor(rate) + once.cast("int"), F.lit(most)).cast("int"))
    )


def mixed(documents: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of ``documents``."""
    plan = _planned(documents, seed, weights, share, most).where("mix_copies > 0")
    return unpacked(plan.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies"))))


def mix_sql(documents: str = "documents") -> str:
    """The plan above in DuckDB's SQL."""
    return f"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+'))::BIGINT AS size FROM {documents}),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
        SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight
        FROM sums),
    levelled AS (
        SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
                   - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size * 2 / weight, source ASC NULLS LAST
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                  / (sum(weight) OVER (ORDER BY source_size * 2 / weight, source ASC NULLS LAST
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM weighed),
    targets AS (
        SELECT source, source_size,
               CASE WHEN source_size * 2 / weight <= level THEN (source_size * 2)::DOUBLE
                    ELSE weight::DOUBLE * max(CASE WHEN source_size * 2 / weight > level THEN level END) OVER () END AS target
        FROM levelled),
    rated AS (
        SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
               ('0x' || substr(md5('0:' || coalesce(s.doc_id::VARCHAR, 'null') || ':' || s.size), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS chance
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, source, size, source_size, target,
           least(floor(rate)::BIGINT + (chance < rate - floor(rate))::BIGINT, 2) AS copies FROM rated"""


@query("op9_mixing", f"SELECT doc_id, size, source_size, target, size * copies AS taken FROM ({mix_sql()})")
def op9_mixing(spark, folder):
    plan = with_copies(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )
