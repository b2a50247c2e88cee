"""Near-duplicate vectors through an index of pivot permutations.

A few reference vectors, the pivots, are drawn by a hash. A vector is described by its nearest pivots in order; vectors
that are alike have many of them in common. Inverted lists hold, per label and pivot, the vectors that count it among
theirs. Pairs of a list that share enough pivots are candidates, and candidates are verified by the exact cosine.

Two sets of ``NEAREST`` that share ``SHARED`` must, in any fixed order of pivots, meet among the first
``NEAREST - SHARED + 1`` of each; only those lists are filled. A pair met in several lists counts in the first one.
Every task hands on link counts and a spanning forest, so what leaves it grows with the vectors and not with the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, stored, table
from .components import connected_components

COSINE = 0.98
NEAREST, SHARED = 8, 4
FEWEST_PIVOTS, MOST_PIVOTS = 128, 4096
DRAWN, APART = 4, 0.9  # vectors drawn for each pivot, and the cosine two pivots stay below
TILE = 1024  # vectors of a list that meet another tile at a time
BLOCK = 1 << 16  # pairs verified at a time


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link: label and vector not null, all components finite, not all zero."""
    wide = F.col("vector")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("label").isNotNull() & wide.isNotNull()).where(finite & F.exists(wide, lambda x: x != 0))


def _normal(stack: np.ndarray) -> np.ndarray:
    stack = stack / np.abs(stack).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return stack / np.sqrt((stack * stack).sum(axis=1, keepdims=True))


def _fitted(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors cut or filled up to the width of the pivots; only their description depends on it."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : min(width, len(row))] = row[:width]
    return out


def describe(distinct: DataFrame, pivots: np.ndarray, nearest: int = NEAREST) -> DataFrame:
    """``distinct`` with ``near``, the numbers of the nearest pivots of ``vector``, nearest first."""
    schema = distinct.withColumn("near", F.array().cast("array<int>")).schema
    shared = distinct.sparkSession.sparkContext.broadcast(pivots)
    at, k = distinct.columns.index("vector"), min(nearest, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = shared.value
        for batch in batches:
            rows = [np.asarray(x, float) for x in batch.column(at).to_pylist()]
            near = np.argsort(-(_fitted(rows, reference.shape[1]) @ reference.T), axis=1, kind="stable")[:, :k]
            lists = pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], schema.names)

    return distinct.mapInArrow(run, schema)


def choose_pivots(distinct: DataFrame, count: int) -> np.ndarray:
    """A bounded sample of distinct vectors, by hash: the only thing fitted, and the only vectors the driver sees.

    Pivots keep their distance from each other. Many in one dense region would be the nearest of all its vectors in an
    order that is mere noise, and alike vectors would share few of them.
    """
    rows = distinct.select("vector", "node").orderBy(F.xxhash64("node"), "node").limit(DRAWN * count).collect()
    width = max((len(r["vector"]) for r in rows), default=1)
    if not rows:
        return np.zeros((0, 1))
    drawn = _fitted([np.asarray(r["vector"], float) for r in rows], width)
    drawn = _normal(drawn[(drawn != 0).any(axis=1)])
    kept = np.zeros((0, width))
    for vector in drawn:
        if len(kept) < count and (not len(kept) or (kept @ vector).max() < APART):
            kept = np.vstack([kept, vector])
    return kept


def _forest(size: int, x: np.ndarray, y: np.ndarray, label: np.ndarray) -> np.ndarray:
    while True:
        p, q = label[x], label[y]
        apart = p != q
        if not apart.any():
            return label
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label[label] != label).any():
            label = label[label]


def link_list(frame: pd.DataFrame, pivot: int, same: bool, shared: int, head: int, cosine: float) -> pd.DataFrame:
    """Links among one tile of a list, or between two: per vector its links and one vector of its local component."""
    near = np.array(frame["near"].tolist())
    ids, place = np.unique(near, return_inverse=True)
    place = place.reshape(near.shape)
    every = np.zeros((len(frame), len(ids)), np.float32)
    np.put_along_axis(every, place, 1, 1)
    early = np.zeros_like(every)
    np.put_along_axis(early, np.sort(place, axis=1)[:, :head], 1, 1)
    early = early[:, ids < pivot]
    side = frame["side"].to_numpy()
    left = np.nonzero(side == 0)[0]
    right = left if same else np.nonzero(side == 1)[0]
    unit = _normal(np.array(frame["vector"].tolist(), float))
    copies = frame["copies"].to_numpy()
    links, label = np.zeros(len(frame), np.int64), np.arange(len(frame))
    if len(left) and len(right):
        found = (every[left] @ every[right].T >= shared) & (early[left] @ early[right].T == 0)
        if same:
            found = np.triu(found, 1)
        x, y = np.nonzero(found)
        for i in range(0, len(x), BLOCK):
            a, b = left[x[i : i + BLOCK]], right[y[i : i + BLOCK]]
            close = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            a, b = a[close], b[close]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            label = _forest(len(frame), a, b, label)
    linked = links > 0
    nodes = frame["node"].to_numpy()
    return pd.DataFrame({"node": nodes[linked], "links": links[linked], "root": nodes[label[linked]]})


def vector_groups(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, pivots: int | None = None
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Rows link if labels and lengths are equal and the cosine reaches the bound. Unusable vectors (null, zero, with null
    or non-finite components, or without a label) link with nothing and are their own component. Equal vectors are
    compared once and counted with their copies. Components are named by the smallest ``vec_id``; rows with a null id
    count as links, and are named null only where no other id is at hand. Repeated rows are copies like others. All
    vectors are indexed; the sample is the pivots', whose number follows the square root of the vectors'.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    good = _usable(rows).select("vec_id", "vector", "label")
    name = F.concat(F.hex(F.xxhash64("label", "vector")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "vector", "label")))
    named = stored(good.withColumn("node", name), "vectors")
    distinct = stored(
        named.groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")),
        "distinct",
    )
    total = distinct.count()
    count = pivots or min(MOST_PIVOTS, max(FEWEST_PIVOTS, math.isqrt(total)))
    reference = choose_pivots(distinct, count)
    head = max(1, min(NEAREST, len(reference)) - SHARED + 1)
    shared = min(SHARED, max(1, len(reference)))
    near = describe(distinct.select("node", "copies", "label", "vector"), reference)
    heads = F.slice(F.array_sort("near"), 1, head)
    listed = stored(near.withColumn("pivot", F.explode(heads)).withColumn("width", F.size("vector")), "lists")
    key = ["label", "width", "pivot"]
    sizes = listed.groupBy(*key).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = listed.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")).cast("int"))
    # tile t meets the tiles from t on: on side 0 for those, on side 1 for the tiles before it
    others = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda o: F.struct(F.least(o, F.col("tile")).alias("low"), F.greatest(o, F.col("tile")).alias("high"), (F.col("tile") > o).cast("int").alias("side")),
    )
    met = dealt.withColumn("m", F.explode(others)).select(*key, "m.low", "m.high", "m.side", "node", "copies", "near", "vector")

    def run(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, low, high = group
        return link_list(frame, pivot, low == high, shared, head, cosine)

    found = stored(met.groupBy(*key, "low", "high").applyInPandas(run, "node string, links bigint, root string"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "root")
    by_node = distinct.select("node", "first_id", "copies").join(links, "node", "left").join(roots, "node", "left")
    by_node = by_node.withColumn("root", F.coalesce("root", "node"))
    ids = by_node.groupBy("root").agg(F.min("first_id").alias("component_id"))
    each = by_node.join(ids, "root").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = named.select("vec_id", "node").join(each, "node").select("vec_id", "n_links", "component_id")
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query("op3_pivots")
def op3_pivots(spark, folder):
    groups = vector_groups(table(spark, folder, "embeddings"))
    return groups.select(F.col("vec_id").cast("bigint").alias("vec_id"), "n_links", F.col("component_id").cast("bigint").alias("component_id"), "kept")
