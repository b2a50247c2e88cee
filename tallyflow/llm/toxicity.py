"""Toxic passages as maximum-scoring segments of token log-odds.

Weights are log-odds of toxic against other labelled text with Dirichlet priors: each token's own counts are joined by
prior counts from its overall frequency, and only odds that are sure enough count; every other token costs a little. One
pass over a text finds all maximal segments. Segment scores of clean text follow an extreme-value law, whose parameters
come from the token frequencies of clean text; a segment's expected number in a text of that length (its E-value) says
how significant it is. The best segments together are judged by the sum statistic of that law, and a logistic curve over
this evidence gives the document's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, query, stored, table
from .simhash import near_duplicates

TRAIN_LABELS = 200_000  # labelled documents learned from, at most
VOCABULARY = 50_000  # weighted tokens kept, the surest first
PRIOR, FLOOR = 1_000.0, 0.5  # prior counts: in all, dealt by overall frequency, and at least for each token
SURE, LEAST = 2.75, 1.5  # standard deviations and log-odds a weight must reach
DRIFT = -0.1
COPY_WIDTH, SAME = 3, 0.8  # runs of words that copies of a labelled text share, and the share from which they are copies
STEMS = (4, 5)  # lengths of word beginnings that stand in for rare words
EVIDENCE_BINS = 400
SIGNIFICANT = 0.05  # E-value below which a passage is reported
_TOKEN = re.compile(r"[^\W_]+")


class Model(NamedTuple):
    weights: dict[str, float]
    decay: float  # lambda of the extreme-value law
    factor: float  # its K
    intercept: float
    slope: float


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _stems(token: str) -> list[str]:
    return [token[:n] + "~" for n in STEMS if len(token) > n]


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence that scores ``drift`` but at ``places``.

    Ruzzo and Tompa's scan: segments on the list keep the running totals before and after them; a new one joins the
    nearest earlier one with a lower total before, unless that one's total after is as high. Each remembers that earlier one,
    so the search skips all between; where there is none, all earlier segments are final and leave it. Only weighted
    places are visited, so the time is linear in them.
    """
    final: list[tuple[int, int, float]] = []
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, total before, total after, nearest earlier with a lower total before
    total, at = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total += drift * (place - at)
        at = place + 1
        first, left = place, total
        total += score
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0:
                final += [(f, x, after - before) for f, x, before, after, _ in kept]
                kept.clear()
            if j < 0 or kept[j][3] >= total:
                kept.append((first, place, left, total, j))
                break
            first, _, left, _, before_it = kept[j]
            del kept[j:]
            j = before_it
    return final + [(f, x, after - before) for f, x, before, after, _ in kept]


def weighed(text: str | None, weights: dict[str, float]) -> tuple[list[int], list[float], int]:
    """Places and weights of the weighted tokens, and the number of tokens. A token said again at once adds nothing."""
    tokens = tokens_of(text)
    weigh = _weigher(weights)
    places, scores, before = [], [], None
    for i, token in enumerate(tokens):
        if token != before and (weight := weigh(token)):
            places.append(i)
            scores.append(weight)
        before = token
    return places, scores, len(tokens)


def passages(places: list[int], scores: list[float], size: int, model: Model) -> list[tuple[int, int, float, float]]:
    """Maximal segments with their E-values."""
    return [(a, b, s, model.factor * max(1, size) * math.exp(-model.decay * s)) for a, b, s in segments(places, scores)]


def _weigher(weights: dict[str, float]):
    get = weights.get

    def weigh(token: str) -> float:
        found = get(token)
        if found is None and len(token) > STEMS[0]:
            found = get(token[: STEMS[1]] + "~") if len(token) > STEMS[1] else None
            if found is None:
                found = get(token[: STEMS[0]] + "~")
        return found or 0.0

    return weigh


def evidence(found: list[tuple[int, int, float, float]]) -> float:
    """Largest ``-ln`` of the expected number of that many segments with such a sum, over the best 1, 2, ... segments."""
    best = total = 0.0
    for rank, e in enumerate(sorted(e for _, _, _, e in found), 1):
        total += math.log(rank) - math.log(max(e, 1e-300))
        best = max(best, total)
    return best


def _score(x: float, model: Model) -> float:
    z = model.intercept + model.slope * x
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def _mapped(documents: DataFrame, model: Model, columns: dict[str, str], make) -> DataFrame:
    """``documents`` with further columns made from ``text`` in batches."""
    others = [c for c in documents.columns if c not in columns]
    schema = documents.select(*others, *[F.lit(None).cast(t).alias(c) for c, t in columns.items()]).schema
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model))  # plain values: executors have no copy of the class
    text_at = others.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            rows = [make(x.as_py(), known) for x in batch.column(text_at)]
            made = [pa.array([r[i] for r in rows], _ARROW[t]) for i, t in enumerate(columns.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return documents.select(*others).mapInArrow(run, schema)


_MARKS_SQL = "struct<places:array<int>,scores:array<double>,size:int>"


def _marks(places: list[int], scores: list[float], size: int) -> dict:
    return {"places": places, "scores": scores, "size": size}


def _graded(marked: DataFrame, model: Model) -> DataFrame:
    """``(toxic, evidence)`` of documents whose weighted tokens are known."""
    law = model._replace(weights={})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [evidence(passages(m["places"], m["scores"], m["size"], law)) for m in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["toxic", "evidence"])

    return marked.select("toxic", "marks").mapInArrow(run, "toxic int, evidence double")


_PASSAGES = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))
_PASSAGES_SQL = "array<struct<first:int,last:int,score:double,e_value:double>>"
_ARROW = {
    "double": pa.float64(),
    _PASSAGES_SQL: _PASSAGES,
    _MARKS_SQL: pa.struct([("places", pa.list_(pa.int32())), ("scores", pa.list_(pa.float64())), ("size", pa.int32())]),
}


def _learned_once(labelled: DataFrame) -> DataFrame:
    """``labelled`` with one row of each group of copies and near copies: a toxic one if there is one, with its own text.

    Copies share ``SAME`` of their runs of three words, confirmed exactly; a single shared run makes none.
    """
    copies = near_duplicates(labelled, COPY_WIDTH, SAME)
    toxic = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = F.min(F.struct((-F.col("toxic")).alias("rank"), "doc_id", "text_hash", "n_rows")).alias("w")
    winners = copies.join(toxic, "doc_id").groupBy("root").agg(first).select(
        F.col("w.doc_id").alias("_id"), F.col("w.text_hash").alias("_hash"), F.col("w.n_rows").alias("_rows")
    )
    winners = stored(winners, "learned")
    kept = labelled.join(F.broadcast(winners), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
    single, repeated = kept.where("_rows = 1"), kept.where("_rows > 1").dropDuplicates(["_id", "_hash"])
    return single.unionByName(repeated).select("doc_id", "text", "toxic")


def _token_counts(labelled: DataFrame) -> DataFrame:
    """``(token, toxic_n, other_n)``: documents that hold a word or word beginning; tasks count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                words = set(tokens_of(text.as_py()))
                counts[toxic.as_py()].update(words.union(*map(_stems, words)))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[1][t] for t in names], pa.int64()), pa.array([counts[0][t] for t in names], pa.int64())],
                ["token", "toxic_n", "other_n"],
            )

    counted = labelled.select("text", "toxic").mapInArrow(run, "token string, toxic_n bigint, other_n bigint")
    return counted.groupBy("token").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("other_n").alias("other_n"))


def _weighted(counts: DataFrame, toxic: int, other: int, vocabulary: int) -> DataFrame:
    """Tokens whose log-odds are sure and high enough, with the log-odds as weight."""
    share = (F.col("toxic_n") + F.col("other_n")) * (PRIOR / (toxic + other)) + FLOOR
    a, b = F.col("toxic_n") + share, F.col("other_n") + share
    odds = F.log(a / (toxic + PRIOR - a)) - F.log(b / (other + PRIOR - b))
    sure = counts.withColumn("weight", odds).withColumn("z", odds / F.sqrt(1 / a + 1 / b))
    return sure.where((F.col("z") >= SURE) & (F.col("weight") >= LEAST)).orderBy(F.desc("z"), "token").limit(vocabulary)


def _extreme_value(weights: list[tuple[float, float]]) -> tuple[float, float]:
    """Lambda and K for independent scores ``(value, probability)`` with negative mean.

    Lambda is the positive root of ``sum p * exp(lambda * s) = 1``. K is at most 1; that bound is taken, so E-values err
    towards caution, and the logistic curve takes up the difference.
    """
    low, high = 1e-6, 1.0
    excess = lambda x: math.fsum(p * math.exp(min(700.0, x * s)) for s, p in weights) - 1
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2, 1.0


def _logistic(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope fitted to ``(evidence, toxic, other)`` counts by Newton steps with a small ridge."""
    a, b = 0.0, 0.0
    for _ in range(60):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, pos, neg in bins:
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, a + b * x))))
            n, w = pos + neg, (pos + neg) * p * (1 - p) + 1e-9
            g0 += pos - n * p
            g1 += (pos - n * p) * x
            h00 += w
            h01 += w * x
            h11 += w * x * x
        g1, h11, h00, g0 = g1 - 1e-3 * b, h11 + 1e-3, h00 + 1e-3, g0 - 1e-3 * a
        det = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        a, b = a + max(-2.0, min(2.0, da)), b + max(-2.0, min(2.0, db))
        if abs(da) + abs(db) < 1e-9:
            break
    return a, max(0.0, b)


def train(documents: DataFrame, labels: DataFrame, train_labels: int = TRAIN_LABELS, vocabulary: int = VOCABULARY) -> Model:
    """Fit weights, extreme-value law and curve to labelled documents.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null in either are left out, a document with several labels is
    toxic if one says so. At most ``train_labels`` are used, chosen by a hash; that bound is what lets them be broadcast
    to the texts. Without labels of both kinds nothing is weighted and every document gets the share of toxic labels.
    """
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    picked = named.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_labels)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    labelled = stored(texts.join(F.broadcast(picked), "doc_id"), "labelled")
    # copies and near copies of a text are learned from once, or each of its words would look sure
    labelled = _learned_once(labelled)
    counts = stored(_token_counts(labelled), "token_counts")
    words = counts.where(~F.col("token").endswith("~"))
    sums = words.agg(F.sum("toxic_n").alias("t"), F.sum("other_n").alias("o")).first()
    toxic, other = int(sums["t"] or 0), int(sums["o"] or 0)
    if not toxic or not other:
        shares = picked.agg(F.avg("toxic")).first()[0]
        rate = min(0.999, max(0.001, float(shares))) if shares is not None else 0.001
        return Model({}, 1.0, 1.0, math.log(rate / (1 - rate)), 0.0)
    rows = _weighted(counts, toxic, other, vocabulary).select("token", "weight").collect()
    model = Model({r["token"]: r["weight"] for r in rows}, 1.0, 1.0, 0.0, 0.0)
    marked = stored(_mapped(labelled, model, {"marks": _MARKS_SQL}, lambda t, m: (_marks(*weighed(t, m.weights)),)).select("toxic", "marks"), "marked")
    clean = marked.where("toxic = 0")
    size = clean.agg(F.sum("marks.size")).first()[0] or 1
    met = clean.select(F.explode("marks.scores").alias("w")).groupBy(F.round("w", 1).alias("w")).agg(F.count("*").alias("n")).collect()
    often = [(r["w"], (r["n"] + 0.5) / size) for r in met] + [(max(model.weights.values(), default=1.0), 1 / size)]
    decay, factor = _extreme_value([*often, (DRIFT, max(1e-9, 1 - math.fsum(p for _, p in often)))])
    model = model._replace(decay=decay, factor=factor)
    graded = _graded(marked, model)
    width = 0.25
    bins = graded.groupBy(F.least(F.floor(F.col("evidence") / width), F.lit(EVIDENCE_BINS)).alias("bin")).agg(
        F.sum("toxic").alias("pos"), F.count("*").alias("n")
    )
    found = [((r["bin"] + (0.5 if r["bin"] else 0.0)) * width, r["pos"], r["n"] - r["pos"]) for r in bins.collect()]
    return model._replace(**dict(zip(("intercept", "slope"), _logistic(sorted(found)), strict=True)))


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``tox_score`` (0 to 1) and ``tox_passages``, the significant segments by token numbers.

    Texts are read whole. Null, empty and wordless texts have no passage and the score of no evidence. Rows do not
    depend on each other; columns named like a result are replaced, all others stay.
    """

    def make(text: str | None, m: Model) -> tuple[float, list[dict]]:
        found = passages(*weighed(text, m.weights), m)
        listed = [{"first": a, "last": b, "score": s, "e_value": e} for a, b, s, e in found if e < SIGNIFICANT]
        return _score(evidence(found), m), listed

    return _mapped(documents, model, {"tox_score": "double", "tox_passages": _PASSAGES_SQL}, make)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(doc_crc(F.col(doc_id)) % 5 == 0, F.lit(False))


@query("op5_toxicity")
def op5_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~held_out())
    scored = score_toxicity(documents, train(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"))
