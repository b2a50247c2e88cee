"""Corpus preparation: five stages over ``documents``, each writing what it keeps for the next.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import mixing, pieces, pii, simhash, toxicity
from tallyflow.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the segment scores, learned from the labels of these documents, do not call toxic."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scored.where("tox_score < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 0.8 of its runs of five words."""
    return simhash.without_near_duplicates(docs, width=5, similarity=0.8)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.redacted(docs).withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix as piece ids."""
    encoded = pieces.encode(docs.select("doc_id", "source", "lang", "text"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Learned scores, fingerprints and piece segmentation have no SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
