"""Language identification by a byte convolutional network in numpy.

A window of bytes is embedded, convolved with filters of several widths, max-pooled over its places and classified by
softmax. The network is trained here on windows of labelled texts; a text's prediction is the mean of its windows'
log-probabilities, weighted by their length, over all windows of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, query, table

WINDOW = 256  # bytes of a window
WIDTHS = (2, 3, 4)
FILTERS = 16  # per width
EMBEDDED = 8
TRAIN_DOCUMENTS = 3_000  # labelled documents drawn from, at most
TRAIN_WINDOWS = 4  # windows of each
EPOCHS, BATCH, RATE = 10, 64, 0.01
INFER = 512  # windows scored at a time
UNKNOWN = "und"


class Network(NamedTuple):
    labels: list[str]
    embed: np.ndarray  # 257 bytes (the last fills up) by EMBEDDED
    filters: np.ndarray  # MAX_WIDTH * EMBEDDED by all filters; narrower ones are zero at their end
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


_SPAN = max(WIDTHS)


def _mask() -> np.ndarray:
    parts = [np.repeat(np.arange(_SPAN) < w, EMBEDDED)[:, None] * np.ones(FILTERS) for w in WIDTHS]
    return np.concatenate(parts, axis=1).astype(np.float32)


def windows_of(text: str) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` byte values, the last filled up with 256."""
    raw = np.frombuffer(text.encode(), np.uint8)
    rows = max(1, -(-len(raw) // WINDOW))
    out = np.full(rows * WINDOW, 256, np.int16)
    out[: len(raw)] = raw
    return out.reshape(rows, WINDOW)


def _convolved(net: Network, windows: np.ndarray) -> np.ndarray:
    """Filter responses at all places: windows by places by filters."""
    n = len(windows)
    e = net.embed[windows]
    e = np.concatenate([e, np.broadcast_to(net.embed[256], (n, _SPAN - 1, EMBEDDED))], axis=1)
    places = np.lib.stride_tricks.sliding_window_view(e, _SPAN, axis=1).transpose(0, 1, 3, 2).reshape(n * WINDOW, _SPAN * EMBEDDED)
    return (places @ net.filters).reshape(n, WINDOW, -1)


def log_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    pooled = np.maximum(_convolved(net, windows).max(axis=1) + net.bias, 0)
    z = pooled @ net.out + net.out_bias
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit(windows: np.ndarray, labels: list[str], seed: int = 5) -> Network:
    """Train by Adam on cross-entropy; with a single label every prediction is that label."""
    names = sorted(set(labels))
    target = np.array([names.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    mask = _mask()
    embed = rng.normal(0, 0.5, (257, EMBEDDED)).astype(np.float32)
    embed[256] = 0
    weights = [embed, (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(total, np.float32)]
    weights += [rng.normal(0, 0.2, (total, len(names))).astype(np.float32), np.zeros(len(names), np.float32)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            net, x = Network(names, *weights), windows[pick]
            response = _convolved(net, x)
            at = response.argmax(axis=1)
            best = np.take_along_axis(response, at[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(best, 0)
            z = pooled @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), target[pick]] -= 1
            p /= len(pick)
            back = (p @ net.out.T) * (best > 0)
            # only the place of each maximum takes part in the gradient
            padded = np.concatenate([x, np.full((len(x), _SPAN - 1), 256, x.dtype)], axis=1)
            bytes_ = padded[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(_SPAN)]
            patch = net.embed[bytes_].reshape(len(x), total, -1)
            g_filter = np.einsum("bf,bfk->kf", back, patch) * mask
            g_patch = (back[:, :, None] * net.filters.T[None]).reshape(len(x), total, _SPAN, EMBEDDED)
            g_embed = np.zeros_like(embed)
            np.add.at(g_embed, bytes_.ravel(), g_patch.reshape(-1, EMBEDDED))
            g_embed[256] = 0
            step += 1
            for k, g in enumerate((g_embed, g_filter, back.sum(0), pooled.T @ p, p.sum(0))):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                scale = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] = (weights[k] - scale * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return Network(names, *weights)


def predict(net: Network, texts: list[str]) -> list[tuple[str, float]]:
    """Label and probability of each text over all its windows."""
    rows = [windows_of(t) for t in texts]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    total = np.zeros((len(rows), len(net.labels)))
    weight = np.zeros(len(rows))
    for i in range(0, len(owner), INFER):
        part = _gathered(rows, owner, i, i + INFER)
        size = np.maximum(1, (part < 256).sum(axis=1))
        np.add.at(total, owner[i : i + INFER], log_probabilities(net, part) * size[:, None])
        np.add.at(weight, owner[i : i + INFER], size)
    mean = total / np.maximum(weight, 1)[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return [(net.labels[b], float(min(1.0, p[i, b]))) for i, b in enumerate(best)]


def _gathered(rows: list[np.ndarray], owner: np.ndarray, start: int, end: int) -> np.ndarray:
    """Windows ``start`` to ``end`` of all texts in a row, without joining the texts."""
    parts = []
    for k in range(owner[start], owner[min(end, len(owner)) - 1] + 1):
        base = int(np.searchsorted(owner, k))
        parts.append(rows[k][max(0, start - base) : end - base])
    return np.concatenate(parts)


def train(documents: DataFrame, documents_at_most: int = TRAIN_DOCUMENTS) -> Network | None:
    """Network for the labels of ``lang``; None if there is no labelled text.

    Learns from up to ``TRAIN_WINDOWS`` windows, spread over the text, of each of at most ``documents_at_most`` documents
    per call, drawn by a hash and equally for each label as far as it has them.
    """
    usable = documents.where("lang is not null and text is not null and doc_id is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    each = max(1, documents_at_most // len(counts))
    picked = None
    for row in counts:
        ids = usable.where(F.col("lang") == row["lang"]).select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        picked = ids if picked is None else picked.unionByName(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = windows_of(text)
                for i in sorted({int(k * (len(rows) - 1) / max(1, TRAIN_WINDOWS - 1)) for k in range(TRAIN_WINDOWS)}):
                    langs.append(lang)
                    parts.append(rows[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["lang", "bytes"])

    chosen = usable.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"]).select("lang", "text")
    rows = sorted(chosen.mapInArrow(run, "lang string, bytes binary").collect())
    return fit(np.stack([np.frombuffer(r["bytes"], np.int16) for r in rows]), [r["lang"] for r in rows])


def identify(documents: DataFrame, net: Network | None) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``lang_score`` (0 to 1), computed from ``text`` alone.

    Null, empty and letterless texts, and all texts without a network, are ``und`` with score 0. Texts are read whole, in
    fixed windows; rows do not depend on each other. Columns named like a result are replaced, all others stay.
    """
    others = [c for c in documents.columns if c not in ("lang_pred", "lang_score", "lang_letters")]
    schema = documents.select(*others, F.lit("").alias("lang_pred"), F.lit(0.0).alias("lang_score")).schema
    shared = documents.sparkSession.sparkContext.broadcast(net and tuple(net))  # plain values: executors have no copy of the class
    text_at = others.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value and Network(*shared.value)
        for batch in batches:
            letters = batch.column(batch.num_columns - 1).to_pylist()
            todo = [i for i, x in enumerate(letters) if x and known]
            labels, scores = [UNKNOWN] * len(letters), [0.0] * len(letters)
            for k in range(0, len(todo), 64):
                some = todo[k : k + 64]
                for i, (name, p) in zip(some, predict(known, [batch.column(text_at)[i].as_py() for i in some]), strict=True):
                    labels[i], scores[i] = name, p
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(scores, pa.float64())], schema.names)

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lang_letters")
    return documents.select(*others, letters).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(doc_crc(F.col(doc_id)) % 3 == 1, F.lit(False))


@query("op2_language")
def op2_language(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = identify(documents.select("doc_id", "text"), train(documents.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
