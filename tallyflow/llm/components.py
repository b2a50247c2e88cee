"""Connected components of a table of edges, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffles_dropped, stored


def _pairs(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node of its neighbourhood."""
    around = _both_ways(edges)
    low = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = down.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(low.select("u", F.col("m").alias("v")))


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``: no further step changes such edges."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("downs"))
    with shuffles_dropped(edges.sparkSession):
        return nodes.where("ups > 1 OR ups = 1 AND downs = 1").agg(F.count("*")).first()[0] == 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Return ``(node, root)`` for every node of ``edges``; the root is the smallest node of its component.

    Large-star and small-star steps alternate until every component is a star around its root; edges that are such stars
    already take no step.
    The joins keep to the shuffled rows, so that no smallest neighbours are gathered on the driver.
    Every round is written to the shared folder, so lineage stays short and a lost executor costs one round at most.
    Self-loops and repeated edges are allowed; an end that is null makes no edge.
    """
    now = stored(_pairs(edges, a, b).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_star_forest(now):
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "stars")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
