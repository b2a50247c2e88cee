"""Benchmark passages in documents: a prefix-filtered join of rare shingles, verified word by word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, query, stored, table, unpacked

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 500_000  # words in the windows that tasks hold at once; larger benchmarks are matched block by block
WORDS_AT_ONCE = 1 << 19
CANDIDATES = 1 << 19  # candidates verified in one step
STEP = 256

#: Bytes of a word as they are, A-Z in lower case, all others as spaces.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _windows_of(size: int):
    def run(batches):
        for batch in batches:
            items = batch.column("item").to_pylist()
            for item, text in zip(items, batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                starts = range(max(1, len(words) - size + 1)) if words else ()
                for at in range(0, len(starts), 5_000):
                    found = [b" ".join(words[i : i + size]) for i in starts[at : at + 5_000]]
                    yield pa.RecordBatch.from_pydict({"item": [item] * len(found), "words": pa.array(found, pa.binary())})

    return run


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct ``(item, words)``: runs of ``size`` words of each item; all words of an item that has fewer."""
    rows = benchmark.select(
        F.coalesce(F.col("`item_id`").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("`text`"), F.lit("")).alias("text")
    )
    return rows.mapInArrow(_windows_of(size), "item string, words binary").distinct()


def numbered_windows(rows: list[tuple[str, bytes]]) -> dict:
    """A block of windows as plain values: word numbers, one padded row of numbers per distinct window, and its items."""
    texts = sorted({words for _, words in rows})
    place = {words: i for i, words in enumerate(texts)}
    split = [t.split(b" ") for t in texts]
    number = {w: i for i, w in enumerate(sorted({w for ws in split for w in ws}), 1)}
    length = np.array([len(ws) for ws in split], np.int64)
    padded = np.zeros((len(split), int(length.max())), np.int64)
    for i, ws in enumerate(split):
        padded[i, : len(ws)] = [number[w] for w in ws]
    items: list[list[str]] = [[] for _ in texts]
    for item, words in rows:
        items[place[words]].append(item)
    return {"number": number, "length": length, "words": padded, "items": items}


def keys_at(numbers: np.ndarray, width: int) -> np.ndarray:
    """Keys of the shingles of ``width`` words that begin at each place; zero where a word is not the benchmark's.

    A block has under 2^20 different words, so three numbers and the width make a key that no other shingle has.
    """
    n = numbers.shape[-1] - width + 1
    shape = (*numbers.shape[:-1], max(0, n))
    key, whole = np.full(shape, width, np.int64), np.ones(shape, bool)
    for k in range(width if n > 0 else 0):
        part = numbers[..., k : k + n]
        key, whole = (key << 20) | part, whole & (part > 0)
    return np.where(whole, key, 0)


def _by_width(block: dict):
    """Width of the shingles, and which windows have shingles of that width: windows below three words are one."""
    width = np.minimum(block["length"], SHINGLE)
    for w in np.unique(width).tolist():
        yield w, np.flatnonzero(width == w)


def shingle_keys(block: dict) -> np.ndarray:
    """All shingle keys of the windows, each once, in order."""
    found = np.concatenate([keys_at(block["words"][mine], w).ravel() for w, mine in _by_width(block)])
    return np.unique(found[found > 0])


def rarest_shingles(block: dict, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(shingle, window, place)`` in order of the shingle: the necessary prefix of every window.

    With its shingles in order of rarity, a window that must be contained whole has a necessary prefix of one.
    """
    token = np.zeros(len(block["length"]), np.int64)
    place = np.zeros(len(token), np.int64)
    for w, mine in _by_width(block):
        found = keys_at(block["words"][mine], w)
        often = np.where(found > 0, counts[np.minimum(np.searchsorted(keys, found), len(keys) - 1)], np.iinfo(np.int64).max)
        first = np.argmin(often, axis=1)
        token[mine], place[mine] = found[np.arange(len(mine)), first], first
    order = np.argsort(token, kind="stable")
    return token[order], order, place[order]


def _numbered(texts: list[bytes], number: dict[bytes, int]):
    """Groups of texts as one array of word numbers with a zero after each text, and the places where texts begin."""
    ids: list[int] = []
    starts = [0]
    for text in texts:
        words = words_of(text)
        ids.extend([number.get(w, 0) for w in words])
        ids.append(0)
        starts.append(len(ids))
        if len(ids) >= WORDS_AT_ONCE:
            yield np.array(ids, np.int64), np.array(starts, np.int64)
            ids, starts = [], [0]
    if len(starts) > 1:
        yield np.array(ids, np.int64), np.array(starts, np.int64)


def _counts_shingles(shared):
    """Function for tasks: how often each shingle of the benchmark occurs in the task's documents."""

    def run(batches):
        number, keys, widths = shared.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                for ids, _ in _numbered(batch.column("text").slice(at, STEP).cast(pa.binary()).to_pylist(), number):
                    for w in widths:
                        found = keys_at(ids, w)
                        found = found[found > 0]
                        where = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                        counts += np.bincount(where[keys[where] == found], minlength=len(keys))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"key": keys[some], "n": counts[some]})

    return run


def occurrences(ids: np.ndarray, starts: np.ndarray, block: dict, prefix: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """``(place, window)`` of every occurrence of a window in the texts that ``ids`` holds one after another.

    Documents meet windows at the windows' rarest shingles. The place of the shingle in the window fixes where the window
    would begin; it must begin and end within the text, and then all its words are compared.
    """
    token, window, offset = prefix
    for w in {min(SHINGLE, n) for n in np.unique(block["length"]).tolist()}:
        keys = keys_at(ids, w)
        at = np.flatnonzero(keys)
        low, high = np.searchsorted(token, keys[at], "left"), np.searchsorted(token, keys[at], "right")
        at, low, n = at[high > low], low[high > low], (high - low)[high > low]
        upto = np.cumsum(n)
        begin = 0
        while begin < len(at):
            done = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, done + CANDIDATES, "right")))
            some = slice(begin, end)
            entry = np.repeat(low[some], n[some]) + np.arange(int(n[some].sum())) - np.repeat(upto[some] - n[some] - done, n[some])
            where = np.repeat(at[some], n[some]) - offset[entry]
            found = window[entry]
            text = np.searchsorted(starts, np.repeat(at[some], n[some]), "right")
            inside = (where >= starts[text - 1]) & (where + block["length"][found] < starts[text])
            where, found = where[inside], found[inside]
            for k in range(block["words"].shape[1]):
                over = block["length"][found] <= k
                same = over | (ids[np.where(over, 0, where + k)] == block["words"][found, k])
                where, found = where[same], found[same]
            yield where, found
            begin = end


def _adds_hits(shared, more: bool):
    """Function for tasks: adds the hit ranges of words and the items found to those that earlier blocks found."""

    def run(batches):
        number, block, prefix = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = [t or b"" for t in part.column("row").field("text").cast(pa.binary()).to_pylist()]
                known = zip(*[part.column(c).to_pylist() for c in FOUND[1:]]) if more else iter([None] * len(texts))
                rows = []
                for ids, starts in _numbered(texts, number):
                    rows += _hits_of(ids, starts, block, prefix, known)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)]
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns], names=["row", *FOUND])

    return run


def _hits_of(ids, starts, block, prefix, known) -> list[tuple]:
    """``(n_words, begins, ends, items)`` of each text; ``known`` gives what is known of it already."""
    steps = np.zeros(len(ids) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for where, found in occurrences(ids, starts, block, prefix):
        np.add.at(steps, where, 1)
        np.add.at(steps, where + block["length"][found], -1)
        text = np.searchsorted(starts, where, "right") - 1
        for t, f in np.unique(np.stack([text, found], axis=1), axis=0).tolist():
            items.setdefault(t, set()).update(block["items"][f])
    rows = []
    for t in range(len(starts) - 1):
        low, high = int(starts[t]), int(starts[t + 1])
        earlier = next(known)
        own = items.get(t, set())
        if earlier:
            begins, ends, names = earlier
            if not own:
                rows.append((high - low - 1, begins, ends, names))
                continue
            np.add.at(steps, np.array(begins, np.int64) + low, 1)
            np.add.at(steps, np.array(ends, np.int64) + low, -1)
            own = own | set(names)
        if not own:
            rows.append((high - low - 1, [], [], []))
            continue
        inside = np.concatenate([[False], np.cumsum(steps[low:high]) > 0])
        turns = np.flatnonzero(inside[1:] != inside[:-1]).tolist()
        rows.append((high - low - 1, turns[::2], turns[1::2], sorted(own)))
    return rows


FOUND = ("n_words", "begins", "ends", "items")
_KINDS = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_ranges", "items")


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``hit_ranges``, ``items``.

    A window is ``size`` consecutive words of an item, or all words of an item with fewer. Words of a document that lie in
    an occurrence of a window are hit; ``hit_ranges`` are their runs ``(begin, end)``, end exclusive. Null and blank texts
    have no words and no hit, items without words have no window, a null ``item_id`` reads as the empty string and rows of
    one ``item_id`` are one item. Columns named like a result are replaced, others pass through; repeated documents each
    get their row. Documents are not shuffled. The benchmark is the stated query set: tasks hold the windows of one block,
    about ``block_words`` words, and further blocks are matched in further passes that add to what is found.
    """
    queries = stored(windows(benchmark, size), "windows")
    count = queries.count()
    blocks = -(-count * size // block_words)
    rows = packed(documents)
    if "text" not in documents.columns:
        raise ValueError("documents need a column text")
    kind = rows.schema["row"].dataType.simpleString()
    context = documents.sparkSession.sparkContext
    texts = documents.select(F.coalesce(F.col("`text`"), F.lit("")).alias("text"))
    found = None
    for k in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k)
        collected = [(r["item"], bytes(r["words"])) for r in mine.collect()]
        if not collected:
            continue
        block = numbered_windows(collected)
        number, keys = block.pop("number"), shingle_keys(block)
        widths = [w for w, _ in _by_width(block)]
        often = texts.mapInArrow(_counts_shingles(context.broadcast((number, keys, widths))), "key bigint, n bigint")
        counts = np.zeros(len(keys), np.int64)
        for r in often.groupBy("key").agg(F.sum("n").alias("n")).collect():
            counts[np.searchsorted(keys, r["key"])] = r["n"]
        shared = context.broadcast((number, block, rarest_shingles(block, keys, counts)))
        schema = f"row {kind}, n_words bigint, begins array<bigint>, ends array<bigint>, items array<string>"
        found = (rows if found is None else found).mapInArrow(_adds_hits(shared, found is not None), schema)
        if k < blocks - 1:
            found = stored(found, "hits")
    if found is None:
        none = "cast(array() as array<bigint>)"
        count_words = F.size(F.array_remove(F.split(F.coalesce(F.col("row.text"), F.lit("")), NO_WORD), "")).cast("bigint")
        found = rows.select("row", count_words.alias("n_words"), F.expr(none).alias("begins"), F.expr(none).alias("ends"), F.expr("cast(array() as array<string>)").alias("items"))
    ranges = F.arrays_zip(F.col("begins").alias("begin"), F.col("ends").alias("end"))
    total = F.aggregate("ends", F.lit(0).cast("bigint"), lambda s, x: s + x) - F.aggregate("begins", F.lit(0).cast("bigint"), lambda s, x: s + x)
    done = found.select(
        "row",
        "n_words",
        total.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
        ranges.alias("hit_ranges"),
        "items",
    )
    return unpacked(done, RESULTS, *RESULTS)


NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS words FROM benchmark),
wins AS (
    SELECT DISTINCT item, least({WINDOW}, len(words)) AS len, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
    FROM (SELECT item, words, unnest(generate_series(1, greatest(1, len(words) - {WINDOW - 1}))) AS i FROM items WHERE len(words) > 0)),
places AS (
    SELECT row, len, i, array_to_string(words[i:i + len - 1], ' ') AS w
    FROM (SELECT row, words, len, unnest(generate_series(1, len(words) - len + 1)) AS i
          FROM docs, (SELECT DISTINCT len FROM wins) WHERE len(words) >= len)),
hits AS (SELECT p.row, p.len, p.i, w.item FROM places p JOIN wins w ON p.len = w.len AND p.w = w.w),
covered AS (SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(generate_series(i, i + len - 1)) AS j FROM hits) GROUP BY row),
named AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY encode(item)) AS names FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(n.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON d.row = c.row LEFT JOIN named n ON d.row = n.row"""


@query("op13_decontaminate", ORACLE)
def op13_decontaminate(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(documents, table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
