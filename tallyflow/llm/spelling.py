"""Groups of spelling variants: one-edit neighbours found through a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, stored, table

SHORTEST, FEWEST, LEAD = 6, 5, 5
DAMAGED = 199  # one run in so many loses a letter
SPILL = 400_000  # words a task holds before it hands them on
SYMBOLS = 8  # size of the reduced alphabet: fewer mean fewer neighbours to generate and more candidates to verify
KEYS = 1 << 18  # neighbours generated in one step
STEP = 256

_RUN = re.compile("[a-zÀ-ÿ]+")
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def damaged(doc_id: str, run: str, every: int = DAMAGED) -> str:
    """The run, or where the checksum of document and run is a multiple of ``every``, the run without one letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _spilled(held: dict[str, int]):
    words = list(held)
    for at in range(0, len(words), 100_000):
        part = words[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], schema=_COUNTS)


def _counts_words(shortest: int):
    def run(batches):
        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                    # lower() of bytes changes A-Z only
                    for word, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                        if len(word) >= shortest:
                            word = damaged(doc_id, word)
                            if len(word) >= shortest:
                                held[word] += n
                    if len(held) >= SPILL:
                        yield from _spilled(held)
                        held.clear()
        yield from _spilled(held)

    return run


def vocabulary(documents: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``(word, n)``: the letter runs of all documents, some damaged, with their number of occurrences."""
    rows = documents.select(
        F.coalesce(F.col("`doc_id`").cast("string"), F.lit("")).alias("doc_id"), F.coalesce(F.col("`text`"), F.lit("")).alias("text")
    )
    parts = rows.mapInArrow(_counts_words(shortest), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def reduced(word: str, symbols: int = SYMBOLS) -> bytes:
    """The word over the reduced alphabet: every letter becomes its code point modulo the number of symbols."""
    return bytes(ord(c) % symbols for c in word)


class _Hash:
    """Hash of a reduced word as a polynomial modulo 2^64, so that an edit changes it by a few products."""

    def __init__(self, symbols: int):
        draw = np.random.RandomState(20_240_201)
        self.value = draw.randint(1, 2**62, symbols, dtype=np.int64).astype(np.uint64)
        self.base = int(draw.randint(1, 2**61, dtype=np.int64)) * 2 + 1
        self.inverse = np.uint64(pow(self.base, -1, 2**64))

    def powers(self, n: int) -> np.ndarray:
        base = np.full(n + 1, self.base, np.uint64)
        base[0] = 1
        return np.multiply.accumulate(base)

    def prefixes(self, words: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes of words of one length, the empty one first."""
        terms = self.value[words] * self.powers(words.shape[1])[:-1]
        found = np.zeros((words.shape[0], words.shape[1] + 1), np.uint64)
        np.cumsum(terms, axis=1, out=found[:, 1:])
        return found

    def edits(self, words: np.ndarray, prefixes: np.ndarray, first: int, last: int) -> np.ndarray:
        """Hashes of the words with one edit at the places ``first`` to ``last``, one row per word; the word itself first."""
        length = words.shape[1]
        place = np.arange(first, last)
        power, whole = self.powers(length)[first:last], prefixes[:, -1:]
        before, put = prefixes[:, first:last], self.value[None, :, None] * power[None, None, :]
        moved_on = (before + (whole - before) * np.uint64(self.base))[:, None, :] + put
        found = [whole, moved_on.reshape(len(words), -1)]
        inner = place < length
        if inner.any():
            past = prefixes[:, place[inner] + 1]
            found.append(before[:, inner] + (whole - past) * self.inverse)
            changed = (whole - (past - before[:, inner]))[:, None, :] + put[:, :, inner]
            found.append(changed.reshape(len(words), -1))
        return np.concatenate(found, axis=1)


def _by_length(words: list[str], symbols: int):
    """Indexes and reduced words as a matrix, for every length."""
    places: dict[int, list[int]] = defaultdict(list)
    for i, word in enumerate(words):
        places[len(word)].append(i)
    for length, index in places.items():
        step = max(1, KEYS // (2 * symbols * (length + 1)))
        for at in range(0, len(index), step):
            part = index[at : at + step]
            yield part, np.frombuffer(b"".join(reduced(words[i], symbols) for i in part), np.uint8).reshape(len(part), length)


def _keys_of(symbols: int):
    def run(batches):
        code = _Hash(symbols)
        for batch in batches:
            words = batch.column("word").to_pylist()
            keys = np.zeros(len(words), np.uint64)
            for index, matrix in _by_length(words, symbols):
                keys[index] = code.prefixes(matrix)[:, -1]
            form = pa.array([reduced(w, symbols) for w in words], pa.binary())
            yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "n": batch.column("n"), "form": form, "key": keys.view(np.int64)})

    return run


def _neighbours_of(symbols: int):
    def run(batches):
        code = _Hash(symbols)
        for batch in batches:
            forms: dict[int, list[bytes]] = defaultdict(list)
            for form in batch.column("form").to_pylist():
                forms[len(form)].append(form)
            for length, of_length in forms.items():
                rows = max(1, KEYS // (2 * symbols * (length + 1)))
                places = max(1, KEYS // (2 * symbols))
                for at in range(0, len(of_length), rows):
                    part = of_length[at : at + rows]
                    matrix = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), length)
                    prefixes = code.prefixes(matrix)
                    for first in range(0, length + 1, places):
                        near = np.sort(code.edits(matrix, prefixes, first, min(first + places, length + 1)), axis=1)
                        fresh = np.ones(near.shape, bool)
                        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
                        keys = np.broadcast_to(prefixes[:, -1:], near.shape)
                        yield pa.RecordBatch.from_pydict({"near": near[fresh].view(np.int64), "key": np.ascontiguousarray(keys[fresh]).view(np.int64)})

    return run


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``(word, n, other, other_n)`` for all ordered pairs of words that one edit of a code point tells apart.

    All one-edit neighbours of every distinct reduced word, itself included, are generated and joined with the reduced
    vocabulary. Two words that differ by one edit have reduced words that are equal or differ by one edit, so no pair is
    lost; every candidate is then verified on the words themselves.
    """
    keyed = stored(words.mapInArrow(_keys_of(symbols), "word string, n bigint, form binary, key bigint"), "reduced")
    forms = keyed.select("key", "form").distinct().select("form")
    near = forms.mapInArrow(_neighbours_of(symbols), "near bigint, key bigint")
    others = keyed.select(F.col("key").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    candidates = near.join(others.hint("shuffle_merge"), "near").join(keyed.select("key", "word", "n").hint("shuffle_merge"), "key")
    return candidates.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the ends of the chains of ``form``, by doubling the step each round.

    Every step multiplies the number of occurrences, so chains end and a few rounds do.
    """
    now = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("went")), "roots")
        if not moved.agg(F.max("went")).first()[0]:
            return moved.select("word", "root")
        now = moved.select("word", "root")


def spelling_groups(documents: DataFrame, lead: int = LEAD, symbols: int = SYMBOLS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of six letters and five occurrences or more.

    Words are letter runs of whole texts in lower case (A-Z only); every 199th pair of document and run loses a letter.
    ``form`` is the near word of largest ``n``, the first in code-point order among equals, if that is at least ``lead``
    times the word's; ``root`` is the end of the chain of forms. A null text has no words, a null ``doc_id`` reads as
    empty, repeated rows count as often as they come, and only these two columns are read. Words may be of any length:
    neighbours are generated some places at a time. No words: no rows.
    """
    words = stored(vocabulary(documents), "vocabulary")
    # pairs of words that two reduced neighbours lead to are one pair; both groupings use the one shuffle by word
    pairs = near_words(words, symbols).repartition("word").groupBy("word", "other").agg(F.first("other_n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    found = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    led = -F.col("best.less") >= lead * F.col("n")
    named = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(led, F.col("best.other")).alias("form"),
        F.when(led, -F.col("best.less")).alias("form_n"),
    )
    named = stored(named, "forms")
    return named.join(_roots(named), "word").select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = rf"""
WITH RECURSIVE bits(b, k, v) AS (
    SELECT range::UINTEGER, 0, range::UINTEGER FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UINTEGER) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (
    SELECT doc, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents) GROUP BY doc, run),
coded AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::UINTEGER, list_transform(range(1, octet_length(encode(doc || ':' || run)) + 1),
            lambda i: ('0x' || substr(hex(doc || ':' || run), 2 * i - 1, 2))::UINTEGER)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::UINTEGER)::BIGINT AS h FROM runs, crc_table),
formed AS (
    SELECT CASE WHEN h % {DAMAGED} = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n FROM coded),
words AS (SELECT word, sum(n)::BIGINT AS n FROM formed WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {FEWEST}),
shifted AS (
    SELECT word, n, length(word) AS len, unnest(list_distinct(list_transform(range(0, length(word) + 1), lambda i: left(word, i::INTEGER) || '_' || substr(word, i::INTEGER + 2)))) AS hole FROM words),
holes AS (
    SELECT DISTINCT word, n, hole FROM shifted
    UNION SELECT word, n, unnest(list_transform(range(0, length(word) + 1), lambda i: left(word, i::INTEGER) || '_' || substr(word, i::INTEGER + 1))) FROM words),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole
    WHERE a.word <> b.word AND abs(length(a.word) - length(b.word)) <= 1 AND levenshtein(a.word, b.word) <= 4),
verified AS (
    SELECT * FROM near WHERE CASE
        WHEN length(word) = length(other) THEN list_sum(list_transform(range(1, length(word) + 1), lambda i: (word[i] <> other[i])::INTEGER)) = 1
        WHEN length(word) < length(other) THEN list_contains(list_transform(range(0, length(other)), lambda i: left(other, i::INTEGER) || substr(other, i::INTEGER + 2)), word)
        ELSE list_contains(list_transform(range(0, length(word)), lambda i: left(word, i::INTEGER) || substr(word, i::INTEGER + 2)), other) END),
best AS (
    SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': encode(other)}}) AS b FROM verified GROUP BY word),
formal AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.less >= {LEAD} * w.n THEN decode(b.other) END AS form,
           CASE WHEN -b.less >= {LEAD} * w.n THEN -b.less END AS form_n
    FROM words w LEFT JOIN best ON w.word = best.word),
chain(word, root) AS (
    SELECT word, word FROM formal UNION ALL
    SELECT c.word, f.form FROM chain c JOIN formal f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM formal f JOIN chain c ON f.word = c.word JOIN formal e ON c.root = e.word WHERE e.form IS NULL"""


@query("op12_spelling", ORACLE)
def op12_spelling(spark, folder):
    return spelling_groups(table(spark, folder, "documents"))
