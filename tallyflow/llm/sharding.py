"""Balanced label propagation of documents over shards.

Documents that share a link key (here: equal texts) pull each other into one shard; quotas keep shards at equal bytes.
Links are kept as memberships (document, key), never as pairs, so a key of any size costs its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, query, stored, table, unpacked

SHARDS, ROUNDS = 16, 6
BUCKET_ROWS = 20_000  # rows that are numbered together
#: Lowest sizes of the classes that are poured one after the other, the largest first.
CLASSES = (65_536, 16_384, 4_096, 1_024, 0)


def _draw(round_no: int) -> Column:
    """Number in [0, 1) that depends on the document and the round only."""
    return F.pmod(F.xxhash64("node", F.lit(round_no)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _bytes_by_shard(rows: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["b"] for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    return [int(found.get(s, 0)) for s in range(shards)]


def _lookup(values: list) -> Column:
    return F.array(*map(F.lit, values))


def propagate(linked: DataFrame, capacity: float, shards: int, rounds: int) -> DataFrame:
    """Labels of linked documents after some rounds: rows of ``node``, ``key``, ``size`` become ``node``, ``size``, ``shard``.

    In a round every document looks at the bytes of its keys in each shard and wishes for the best shard that still has
    room. Wishes are summed by (from, to); what a full shard cannot take is cut to its quota by drawing documents with
    a hash. A group larger than a shard so fills one after the other. The sums held by the driver are shards squared.
    """
    first = F.pmod(F.xxhash64("node", F.lit(99)), F.lit(shards)).cast("int")
    now = stored(linked.withColumn("shard", first), "labels")
    for turn in range(rounds):
        loads = _bytes_by_shard(now, shards)
        room = [capacity - x for x in loads]
        tally = now.groupBy("key", "shard").agg(F.sum("size").alias("b"))
        open_ = F.element_at(_lookup([x > 0 for x in room]), F.col("shard") + 1)
        # ties go to the shard that the key's hash prefers, so both copies of a pair wish for the same one
        rank = F.struct("b", F.xxhash64("key", "shard"), "shard")
        best = tally.groupBy("key").agg(F.max(F.when(open_, rank))["shard"].alias("goal"), F.max(F.when(open_, F.col("b"))).alias("goal_b"))
        wishes = (
            now.join(tally.withColumnRenamed("b", "own_b"), ["key", "shard"])
            .join(best, "key")
            .withColumn("moves", F.coalesce((F.col("goal") != F.col("shard")) & (F.col("goal_b") >= F.col("own_b")), F.lit(False)))
        )
        asked = {(r["shard"], r["goal"]): r["b"] for r in wishes.where("moves").groupBy("shard", "goal").agg(F.sum("size").alias("b")).collect()}
        if not asked:
            break
        into = [sum(b for (_, t), b in asked.items() if t == s) for s in range(shards)]
        out = [sum(b for (f, _), b in asked.items() if f == s) for s in range(shards)]
        quota = [min(1.0, max(0.0, room[s] + out[s] / 2) / into[s]) if into[s] else 0.0 for s in range(shards)]
        allowed = F.element_at(_lookup(quota), F.col("goal") + 1)
        now = stored(
            wishes.select("node", "key", "size", F.when(F.col("moves") & (_draw(turn) < allowed), F.col("goal")).otherwise(F.col("shard")).alias("shard")),
            "labels",
        )
    return now.select("node", "size", "shard")


def _running(rows: DataFrame, by: list[str], value: Column, name: str, buckets: int) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before, within ``by``, in the order of a hash of ``node``.

    Sums within a hash bucket are windows of bounded size; the buckets' totals are added up among themselves.
    """
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("node", F.lit(5)), F.lit(buckets)).cast("int"))
    totals = dealt.groupBy(*by, "bucket").agg(F.sum(value).alias("part"))
    whole = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "bucket", F.coalesce(F.sum("part").over(whole), F.lit(0)).alias("offset"))
    within = Window.partitionBy(*by, "bucket").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("part", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, [*by, "bucket"])
        .withColumn(name, F.col("part") + F.col("offset"))
        .drop("bucket", "part", "offset")
    )


def _pour(loose: DataFrame, loads: list[int], total: int, shards: int, buckets: int) -> DataFrame:
    """Give every loose document a shard so that bytes level out: large classes first, small ones fill the gaps.

    A class is laid out in hash order on a line; each shard owns an interval of it as long as its share of what is
    missing. After a class the real loads are counted, so its rounding is made good by the next.
    """
    done = None
    upper = None
    for low in CLASSES:
        part = loose.where((F.col("size") >= low) & (F.lit(True) if upper is None else F.col("size") < upper))
        upper = low
        mass = part.agg(F.sum("size")).first()[0]
        if not mass:
            continue
        level = _level(loads, mass)
        bounds, at = [], 0.0
        for load in loads:
            at += max(0.0, level - load)
            bounds.append(at)
        scale = mass / at if at else 1.0
        placed = _running(part.withColumn("one", F.lit(1)), ["one"], F.col("size"), "before", buckets)
        middle = F.col("before") + F.col("size") / 2
        shard = F.aggregate(_lookup([b * scale for b in bounds[:-1]]), F.lit(0), lambda n, b: n + (middle >= b).cast("int"))
        placed = stored(placed.select("node", "size", shard.alias("shard")), "poured")
        loads = [a + b for a, b in zip(loads, _bytes_by_shard(placed, shards), strict=True)]
        done = placed if done is None else done.unionByName(placed)
    return done if done is not None else loose.select("node", "size", F.lit(0).alias("shard")).where("false")


def _level(loads: list[int], mass: int) -> float:
    """Height to which ``mass`` fills vessels that hold ``loads`` already."""
    rising = sorted(loads)
    for n in range(len(rising), 0, -1):
        level = (sum(rising[:n]) + mass) / n
        if level >= rising[n - 1]:
            return level
    return float(rising[0] + mass)


def balanced_shards(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(node, shard, slot)`` for rows of ``node`` (unique), ``key`` (null: unlinked) and ``size``.

    Keys held by two documents or more are propagated; a shard that starts above its share gives up what exceeds it, and
    that, with all unlinked documents, levels the bytes. Slots number a shard's documents from 0 without gaps. The
    result depends on ids, keys and sizes only. An empty table gives an empty one.
    """
    sums = nodes.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    total, count = int(sums["b"] or 0), sums["n"]
    buckets = max(1, count // bucket_rows + 1)
    capacity = total / shards
    keys = nodes.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    linked = propagate(nodes.join(keys, "key"), capacity, shards, rounds)
    fits = _running(linked, ["shard"], F.col("size"), "before", buckets).withColumn("stays", F.col("before") + F.col("size") <= capacity)
    fixed = stored(fits.select("node", "size", "shard", "stays"), "linked")
    held = fixed.where("stays").select("node", "size", "shard")
    loose = nodes.select("node", "size").join(held.select("node"), "node", "left_anti")
    loose = stored(loose, "loose")
    placed = held.unionByName(_pour(loose, _bytes_by_shard(held, shards), total, shards, buckets))
    return _running(placed, ["shard"], F.lit(1), "slot", buckets).select("node", "shard", F.col("slot").cast("bigint").alias("slot"))


def sharded(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Documents with ``size`` (UTF-8 bytes and one), ``text_crc32``, ``shard`` and ``slot``; equal texts are linked.

    A null text has size 1 and no link, an empty one links with other empty ones. Rows are told apart by id, then by text;
    repeated rows are told apart by a number within their repetition, so each gets its own slot. Columns named like a
    result are replaced, the text is not returned.
    """
    data = F.col("row.text").cast("binary")
    base = packed(documents.select(*[F.col(f"`{c}`") for c in documents.columns if c != "text"], "text"), "doc_id").select(
        "doc_id",
        F.col("row").dropFields("text").alias("row"),
        (F.coalesce(F.octet_length("row.text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.md5(data).alias("key"),
    )
    ident = [F.col("doc_id"), F.col("key")]
    twice = base.groupBy(*ident).agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    tied = base.join(twice, base["doc_id"].eqNullSafe(twice["_id"]) & base["key"].eqNullSafe(twice["_key"]), "left")
    salted = tied.withColumn("nth", F.when(F.col("_id").isNotNull() | F.col("_key").isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)))
    rows = stored(salted.drop("_id", "_key").withColumn("node", F.struct("doc_id", "key", "nth")), "documents")
    placed = balanced_shards(rows.select("node", "key", "size"), shards, rounds, bucket_rows)
    return unpacked(rows.join(placed, "node"), ("size", "text_crc32", "shard", "slot"), "size", "text_crc32", "shard", "slot")


@query("op6_sharding")
def op6_sharding(spark, folder):
    placed = sharded(table(spark, folder, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
