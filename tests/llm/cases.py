"""Small documents with the cases every operator must survive."""

from __future__ import annotations

import random

WORDS = "the river runs past old stone houses while children carry water from a quiet garden to their mothers kitchen".split()


def prose(seed: int, words: int = 120) -> str:
    pick = random.Random(seed)
    return " ".join(f"{pick.choice(WORDS)}{pick.randrange(400)}" for _ in range(words)) + "."


def edited(text: str, every: int) -> str:
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


HARD = [
    (1, prose(1), "en", "web"),
    (2, prose(1), "en", "web"),  # a copy
    (3, edited(prose(1), 60), "en", "web"),  # a near copy
    (4, None, None, None),
    (5, "", "en", ""),
    (6, " \t\n", "en", "web"),
    (7, "Word", "en", "web"),
    (8, "é 日本 🙂 \x00 ▁ mail a.b@c.de, call +1 (555) 010-0200 or 4111 1111 1111 1111 at 10.0.0.1\n" * 2, "fr", "web"),
    (9, prose(9, 30_000), "en", None),  # very long
    (10, prose(10), "en", "web"),
    (10, prose(10), "en", "web"),  # a repeated row
    (None, prose(11), "en", "web"),
    (None, prose(11), "en", "web"),
    (12, "1" * 40_000 + " " + "a" * 40_000 + "@", "en", "web"),
    (13, "idiot " + prose(13), "en", "web"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Columns that operators use for themselves somewhere.
CLASHING = (
    "row key node fp size shard slot words lines hashes windows n_words kept text_hash root label tile ids score "
    "tox_score lang_pred lang_letters mix_size mix_key _id _hash id hash part bucket"
).split()


def hard(spark, clashing: bool = False):
    rows = spark.createDataFrame(HARD, SCHEMA)
    return rows.selectExpr("*", *[f"'own' AS `{c}`" for c in CLASHING]) if clashing else rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
