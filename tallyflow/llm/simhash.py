"""SimHash fingerprints compared tile against tile.

A fingerprint has one bit per column of its shingles' 64-bit hashes, set where over half of them have it. Distinct
fingerprints are put into cells by the population counts of their segments. Two cells whose counts differ by more
than the radius hold no pair within it and are skipped; the tiles of the others are compared completely with numpy:
exclusive-or, bit count, threshold. Each comparison hands on a spanning forest of its links, so a group of near copies
costs rows in proportion to its size, not to its square.

Near duplicates by the similarity of shingle sets need not compare all fingerprints: sets that are similar enough share a
shingle among the first of each in any common order, so only the texts that share such a shingle are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, query, stored, table, unpacked
from .components import connected_components

SEED = 42
CHUNK = 1 << 14  # shingles whose bits are unpacked at a time
ROWS = 256  # texts whose heads are handed on together
HEAD = 3  # words of a fingerprint compared for all pairs
SMALLEST_TILE, LARGEST_TILE, TILES = 8192, 1 << 20, 64
SAMPLE, FREQUENT = 64, 1 << 18  # one text of so many tells which shingles are frequent; of them so many are known at most
SHORT_LIST, PIVOTS = 64, 8  # lists compared side by side; members of longer ones that all others are compared with first


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, lower-cased in A-Z; shorter texts are one shingle, blank ones none."""
    words = (text or "").encode().lower().split()
    digest, runs = xxhash.xxh64_intdigest, max(1, len(words) - width + 1) if words else 0
    return np.fromiter((digest(b" ".join(words[i : i + width]), SEED) for i in range(runs)), np.uint64, runs)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """A second hash of hashes (the finaliser of SplitMix64), for fingerprints of more than 64 bits."""
    z = hashes + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1, lead: bool = False) -> list[int]:
    """The fingerprint as signed 64-bit integers; zero without shingles. The first is of the hashes themselves.

    Ties are zero, or with ``lead`` go with the first hash: fingerprints of few shingles are then as far apart as others.
    """
    out = []
    for _ in range(words):
        ones = np.zeros(64, np.int64)
        for start in range(0, len(hashes), CHUNK):
            part = np.ascontiguousarray(hashes[start : start + CHUNK])
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        ones *= 2
        if lead and len(hashes):
            ones += np.unpackbits(np.ascontiguousarray(hashes[:1]).view(np.uint8), bitorder="little")
        out.append(int(np.packbits(ones > len(hashes), bitorder="little").view("<i8")[0]))
        hashes = _mixed(hashes)
    return out


def set_fingerprint(distinct: np.ndarray, words: int) -> list[int]:
    """Fingerprint of a set of shingles, as the similarity counts them: each once, however often the text says it."""
    return fingerprint(distinct, words, lead=True)


def with_fingerprints(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``text_hash`` (XXH64 of the text) and ``fp``, an array of one integer."""
    columns = "doc_id bigint, text_hash bigint, fp array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(shingle_hashes(x.as_py(), width)) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.list_(pa.int64()))], ["doc_id", "text_hash", "fp"])

    return documents.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, columns)


def frequent_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that several texts of a sample hold, ascending, and how many texts each.

    They only decide which shingles of a set come last. Where there are more than ``FREQUENT``, the most frequent are taken.
    """
    sample = texts.select("text").where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(SAMPLE)) == 0).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(x.as_py(), width)).view(np.int64))], ["shingle"])

    counts = sample.mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts, "frequent")
    total, least = 0, 1
    for n, found in sorted(counts.groupBy("n").agg(F.count("*")).collect(), reverse=True):
        total, least = total + found, n
        if total > FREQUENT:
            least = n + 1
            break
    known = counts.where(F.col("n") >= least).toArrow()
    shingles, n = known.column("shingle").to_numpy().view(np.uint64), known.column("n").to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def heads(distinct: np.ndarray, similarity: float, frequent: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first shingles of a set, ascending hashes, in the common order: frequent ones last, the rarer before the others.

    Two sets share at least ``similarity`` times the size of either one if they are that similar, so at most the others
    come before the first shared one in each. A set without shingles has the head 0.
    """
    if not len(distinct):
        return np.zeros(1, np.uint64)
    many = len(distinct) - math.ceil(similarity * len(distinct) - 1e-6) + 1
    if not len(frequent):
        return distinct[:many].copy()
    place = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
    known = frequent[place] == distinct
    rare, last = distinct[~known], distinct[known]
    last = last[np.argsort(often[place[known]], kind="stable")]
    return np.concatenate([rare[:many], last[: max(0, many - len(rare))]])


def with_set_marks(texts: DataFrame, width: int, words: int, similarity: float) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` of the set of shingles, ``words`` integers, and its ``heads``."""
    columns = "doc_id bigint, text_hash bigint, fp array<bigint>, heads array<bigint>"
    shared = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, often = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):  # few sets and heads at a time
                part, marks, first = batch.slice(start, ROWS), [], []
                for x in part.column(2):
                    distinct = np.unique(shingle_hashes(x.as_py(), width))
                    marks.append(set_fingerprint(distinct, words))
                    first.append(heads(distinct, similarity, frequent, often).view(np.int64))
                arrays = [part.column(0), part.column(1), pa.array(marks, pa.list_(pa.int64())), pa.array(first, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "fp", "heads"])

    return texts.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, columns)


def _join_labels(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after the pairs ``(x, y)`` are joined: hooks to the smaller label until none differ."""
    while True:
        p, q = label[x], label[y]
        apart = p != q
        if not apart.any():
            return label
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label[label] != label).any():
            label = label[label]


def _distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of every row of ``left`` from every row of ``right``."""
    found = np.bitwise_count(left[:, None, 0] ^ right[None, :, 0])
    if left.shape[1] > HEAD:
        found = found.astype(np.uint16)  # 256 bits can differ in more than a byte holds
    for k in range(1, left.shape[1]):
        found += np.bitwise_count(left[:, None, k] ^ right[None, :, k])
    return found


def _row_distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``left`` from the same row of ``right``."""
    return np.bitwise_count(left ^ right).sum(1, dtype=np.int64)


def link_within(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs at ``radius`` bits or fewer, as places in ``left`` followed by ``right``."""
    shift = 0 if same else len(left)
    label = np.arange(len(left) + (0 if same else len(right)))
    rows, columns = 128, 1 << 13
    for i in range(0, len(left), rows):
        block = left[i : i + rows]
        for j in range(i if same else 0, len(right), columns):
            x, y = np.nonzero(_distance(block[:, :HEAD], right[j : j + columns, :HEAD]) <= radius)
            if left.shape[1] > HEAD:  # the first words rule out most pairs
                near = _row_distance(block[x], right[y + j]) <= radius
                x, y = x[near], y[near]
            label = _join_labels(label, x + i, y + j + shift)
    joined = np.nonzero(label != np.arange(len(label)))[0]
    return joined, label[joined]


def link_list(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of ``marks`` at ``radius`` bits or fewer.

    Some are compared with all first, so that near copies are joined in time linear in their number; then all pairs are
    compared but those within the largest part.
    """
    label, alone = np.arange(len(marks)), np.ones(len(marks), bool)
    for _ in range(PIVOTS):
        if not alone.any():
            break
        first = int(np.argmax(alone))
        near = np.nonzero(_distance(marks[first : first + 1], marks)[0] <= radius)[0]
        label = _join_labels(label, near, np.full(len(near), first))
        alone[near] = False
    large = label == np.argmax(np.bincount(label))
    here, rest = np.nonzero(large)[0], np.nonzero(~large)[0]
    for left, right, same in ((rest, rest, True), (here, rest, False)):
        if len(left) and len(right):
            places = left if same else np.concatenate([left, right])
            x, y = link_within(marks[left], marks[right], radius, same)
            label = _join_labels(label, places[x], places[y])
    joined = np.nonzero(label != np.arange(len(label)))[0]
    return joined, label[joined]


def _segment_counts(fp: Column, words: int, segments: int) -> Column:
    """Population counts of the segments of the first word, or of the whole fingerprint, as one array."""
    if segments == 1:
        total = F.bit_count(F.get(fp, 0))
        for k in range(1, words):
            total += F.bit_count(F.get(fp, k))
        return F.array(total.cast("int"))
    width = 64 // segments
    mask = F.lit((1 << width) - 1).cast("bigint")
    return F.array(*[F.bit_count(F.shiftrightunsigned(F.get(fp, 0), k * width).bitwiseAND(mask)).cast("int") for k in range(segments)])


def _offsets(segments: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of counts that are within the radius, one of each pair of opposites."""
    every = product(range(-radius, radius + 1), repeat=segments)
    return [o for o in every if sum(map(abs, o)) <= radius and o >= (0,) * segments]


def fingerprint_links(distinct: DataFrame, radius: int, words: int = 1) -> DataFrame:
    """Edges ``(a, b)`` between keys that connect all fingerprints which are ``radius`` bits or fewer apart.

    Each comparison gives stars around the smallest key of every part it found, which leaves the fewest steps to join them.
    ``distinct`` has ``key`` (bigint, unique) and ``fp``. Four segments prune best for a small radius; for a large one
    the neighbouring cells would be too many and the whole count is used, in steps of the radius, so that only the next
    cell is within it. A cell is dealt into tiles by a hash.
    """
    segments, step = (4, 1) if radius <= 3 else (1, radius)
    counts = F.transform(_segment_counts(F.col("fp"), words, segments), lambda n: F.floor(n / step).cast("int"))
    rows = distinct.select("key", "fp", counts.alias("cell"))
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    most = min(LARGEST_TILE, max(SMALLEST_TILE, total // TILES))
    dealt = rows.join(sizes, "cell").select(
        F.concat(F.array("key"), "fp").alias("row"), "cell", F.pmod(F.xxhash64("key", F.lit(7)), F.ceil(F.col("n") / most)).cast("int").alias("part")
    )
    tiles = stored(dealt.groupBy("cell", "part").agg(F.flatten(F.collect_list("row")).alias("rows")), "tiles")
    heads = tiles.select("cell", "part")
    steps = F.array(*[F.array(*map(F.lit, o)) for o in _offsets(segments, radius // step)])
    near = F.zip_with("cell", F.col("step"), lambda c, s: c + s)
    ahead = heads.select("cell", "part", F.explode(steps).alias("step")).select(
        F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), near.alias("cell")
    )
    pairs = ahead.join(heads, "cell").where("cell <> cell_a or part >= part_a")
    left = tiles.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("rows").alias("a"))
    right = tiles.select("cell", "part", F.col("rows").alias("b"))
    both = pairs.join(left, ["cell_a", "part_a"]).join(right, ["cell", "part"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b, same in frame.itertuples(index=False):
                a, b = (np.asarray(x, "<i8").reshape(-1, words + 1) for x in (a, b))
                u, v = link_within(np.ascontiguousarray(a[:, 1:]).view(np.uint64), np.ascontiguousarray(b[:, 1:]).view(np.uint64), radius, same)
                keys = a[:, 0] if same else np.concatenate([a[:, 0], b[:, 0]])
                centres = np.unique(v)
                smallest = keys.copy()
                np.minimum.at(smallest, v, keys[u])
                node, root = keys[np.concatenate([u, centres])], smallest[np.concatenate([v, centres])]
                yield pd.DataFrame({"a": node[node != root], "b": root[node != root]})

    same = (F.col("cell") == F.col("cell_a")) & (F.col("part") == F.col("part_a"))
    return both.select("a", "b", same.alias("same")).mapInPandas(run, "a bigint, b bigint")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted ``batches``, cut only where the first column changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        others = np.nonzero(columns[0] != columns[0][-1])[0] if batch.num_rows else columns[0]
        if held and batch.num_rows and held[-1][0][-1] != columns[0][0]:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        if len(others):
            cut = int(others[-1]) + 1
            yield [np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns], strict=True)]
            held, columns = [], [c[cut:] for c in columns]
        if batch.num_rows:
            held.append(columns)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def head_links(distinct: DataFrame, radius: int, words: int) -> DataFrame:
    """Edges ``(a, b)`` that connect the keys whose fingerprints are within ``radius``, of all that share one of their ``heads``.

    ``distinct`` is a stored table of ``key`` (unique), ``fp`` and ``heads``. A head that one text has goes no further than
    its shuffle; texts that share several heads, as copies of two do, are compared once. Fingerprints are sent only to
    the lists that are left.
    """

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, key in _runs(batches):
            starts = np.nonzero(np.concatenate([[True], head[1:] != head[:-1]]))[0]
            sizes = np.diff(np.concatenate([starts, [len(head)]]))
            several = sizes > 1
            offsets = np.concatenate([[0], np.cumsum(sizes[several])]).astype(np.int32)
            values = pa.array(key[np.repeat(several, sizes)])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), values)], ["keys"])

    dealt = distinct.select(F.explode("heads").alias("head"), "key").repartition("head").sortWithinPartitions("head", "key")
    lists = dealt.mapInArrow(together, "keys array<bigint>").distinct()
    # hashed before they are taken apart, or each member would hash its whole list; lists of one hash are compared as one
    members = lists.select(F.xxhash64("keys").alias("list"), "keys").select("list", F.explode("keys").alias("key"))
    marked = members.join(distinct.select("key", "fp"), "key").select("list", "key", *[F.get("fp", k).alias(f"f{k}") for k in range(words)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, key, *fp in _runs(batches):
            marks = np.stack(fp, 1).view(np.uint64)
            node, at = np.unique(key, return_inverse=True)
            label = np.arange(len(node))
            starts = np.nonzero(np.concatenate([[True], name[1:] != name[:-1]]))[0]
            sizes = np.diff(np.concatenate([starts, [len(name)]]))
            for start, size in zip(starts[sizes > SHORT_LIST].tolist(), sizes[sizes > SHORT_LIST].tolist(), strict=True):
                x, y = link_list(marks[start : start + size], radius)
                label = _join_labels(label, at[start + x], at[start + y])
            left = np.nonzero(np.repeat(sizes <= SHORT_LIST, sizes))[0]
            for ahead in range(1, SHORT_LIST):
                left = left[left + ahead < len(name)]
                left = left[name[left] == name[left + ahead]]
                if not len(left):
                    break
                near = left[_row_distance(marks[left], marks[left + ahead]) <= radius]
                label = _join_labels(label, at[near], at[near + ahead])
            joined = np.nonzero(label != np.arange(len(label)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(node[joined]), pa.array(node[label[joined]])], ["a", "b"])

    return marked.repartition("list").sortWithinPartitions("list", "key").mapInArrow(run, "a bigint, b bigint")


def _named(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def simhash_groups(documents: DataFrame, width: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Return ``doc_id``, ``fp`` and ``component_id``, one row per row of ``documents``.

    Components are taken over all fingerprints at ``radius`` bits or fewer; their id is the smallest ``doc_id`` in them.
    Null and blank texts have fingerprint zero and are linked like any other. Equal texts and repeated rows share a
    fingerprint. A null ``doc_id`` stays and never names a component that has another. Other columns are not read;
    an empty table gives an empty one.
    """
    marked = stored(with_fingerprints(_named(documents, doc_id, text), width).select("doc_id", F.get("fp", 0).alias("key")), "fingerprints")
    first = marked.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    linked = connected_components(fingerprint_links(first.select("key", F.array("key").alias("fp")), radius))
    named = first.join(linked, F.col("key") == F.col("node"), "left").select("key", "first_id", F.coalesce("root", "key").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(named.join(ids, "root").select("key", "component_id"), "key").select("doc_id", F.col("key").alias("fp"), "component_id")


def _confirmed(rows: list[tuple], radius: int, similarity: float, cross: bool) -> list[tuple[int, int]]:
    """Links among texts ``(hash, fp, shingles, side, sub)`` of one candidate group: close fingerprints first, then Jaccard.

    Texts of one ``sub`` are linked already.
    """
    words = np.array([r[1] for r in rows])
    distance = _distance(words, words)
    x, y = np.nonzero(np.triu(distance <= radius, 1))
    side, sub = (np.array([r[k] for r in rows]) for k in (3, 4))
    open_ = sub[x] != sub[y]
    if cross:
        open_ &= side[x] != side[y]
    x, y = x[open_], y[open_]
    order = np.argsort(distance[x, y], kind="stable")
    first: dict[int, int] = {}
    root, found = [first.setdefault(r[4], i) for i, r in enumerate(rows)], []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
        if (p := top(i)) == (q := top(j)):
            continue
        a, b = rows[i][2], rows[j][2]
        small, large = sorted((len(a), len(b)))
        if small < similarity * large:
            continue
        shared = len(np.intersect1d(a, b, assume_unique=True))
        if shared >= similarity * (small + large - shared):
            root[max(p, q)] = min(p, q)
            found.append((rows[i][0], rows[j][0]))
    return found


def near_duplicates(
    documents: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 80, words: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, text_hash, n_rows, root)`` per distinct id and text; texts of one ``root`` are near duplicates.

    Texts that are similar enough share one of their first shingles in a common order (``heads``); of these, fingerprints
    of 256 bits, of the distinct shingles, within ``radius`` propose groups: at similarity 0.8 the expected
    distance is 39, at most 48 (four of five shingles), while unrelated texts differ by 128. Within a proposed group, pairs at that distance are confirmed by the exact similarity
    of their shingle sets. Groups of more than ``GROUP`` texts are confirmed tile by tile. Blank and null texts are
    duplicates of each other.
    """
    texts = _named(documents, doc_id, text)
    marked = stored(with_set_marks(texts, width, words, similarity), "fingerprints")
    distinct = stored(marked.groupBy(F.col("text_hash").alias("key")).agg(F.first("fp").alias("fp"), F.first("heads").alias("heads")), "distinct")
    proposed = stored(connected_components(head_links(distinct, radius, words)), "proposed")
    edges = confirmed_links(texts, proposed, width, similarity, radius, words)
    roots = connected_components(edges)
    rows = marked.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_rows"))
    return rows.join(roots, F.col("text_hash") == F.col("node"), "left").select("doc_id", "text_hash", "n_rows", F.coalesce("root", "text_hash").alias("root"))


GROUP, LARGEST_GROUP = 256, 1024  # texts confirmed together, or on each side of two tiles; more for large groups


def confirmed_links(texts: DataFrame, proposed: DataFrame, width: int, similarity: float, radius: int, words: int) -> DataFrame:
    """Edges between text hashes of proposed groups whose shingle sets are similar enough.

    A group of at most ``GROUP`` texts is confirmed in one piece. Of a larger one every text is compared within its tile
    first, carried once; then one representative of each sub-group found so, all with all. Only where that leaves a group
    in several parts, all pairs of its tiles meet, for the links between members of different parts: so no link is lost,
    and a group of near copies costs what it has members, not members times tiles.
    """
    sizes = proposed.groupBy("root").agg(F.count("*").alias("n"))
    members = proposed.join(sizes, "root").select(F.col("node").alias("text_hash"), "root", _tiles(F.col("n")), F.col("node").alias("sub"))
    members = stored(members, "members")
    inside = _exact_links(texts, members, width, similarity, radius, words, meet=False)
    large = members.where("tiles > 1")
    if large.isEmpty():
        return inside.select("a", "b")
    parts = _parted(large, inside.where("large"))
    first = parts.groupBy("root", "sub").agg(F.min("text_hash").alias("text_hash"))
    counts = first.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    representatives = stored(first.join(counts, "root").select("text_hash", "root", _tiles(F.col("n")), "sub"), "representatives")
    if representatives.isEmpty():
        return inside.select("a", "b")
    between = _exact_links(texts, representatives, width, similarity, radius, words, meet=True)
    parts = stored(_parted(large, inside.where("large").unionByName(between)), "parts")
    # parts of one text each have all been compared as representatives
    shape = parts.groupBy("root", "sub").agg(F.count("*").alias("k")).groupBy("root").agg(F.count("*").alias("n"), F.max("k").alias("most"))
    open_groups = parts.join(shape.where("n > 1 AND most > 1").select("root"), "root").select("text_hash", "root", "tiles", "sub")
    open_groups = stored(open_groups, "open")
    if open_groups.isEmpty():
        return inside.unionByName(between).select("a", "b")
    rest = _exact_links(texts, open_groups, width, similarity, radius, words, meet=True)
    return inside.unionByName(between).unionByName(rest).select("a", "b")


def _tiles(size: Column) -> Column:
    side = F.greatest(F.lit(GROUP), F.least(size / TILES, F.lit(LARGEST_GROUP)))
    return F.ceil(size / side).cast("int").alias("tiles")


def _parted(members: DataFrame, edges: DataFrame) -> DataFrame:
    """``members`` with the sub-group that ``edges`` put each text into, itself where they do not name it."""
    found = connected_components(edges).select(F.col("node").alias("text_hash"), F.col("root").alias("found"))
    named = members.drop("sub").join(found, "text_hash", "left")
    return named.select("text_hash", "root", "tiles", F.coalesce("found", "text_hash").alias("sub"))


def _marked(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` with ``likely``: false for most rows whose ``text_hash`` no member has, true for all others.

    Members are marked in a map of 2^24 bits by parts of their hash; its 2^18 words at most are broadcast. It keeps texts
    out of joins that would shuffle them in vain. The more members there are, the more others pass; the join settles it.
    """
    word, bit = F.shiftrightunsigned("text_hash", 46), F.expr("shiftleft(1L, CAST(text_hash & 63 AS INT))")
    marks = members.select(word.alias("_word"), bit.alias("bit")).groupBy("_word").agg(F.bit_or("bit").alias("mask"))
    seen = rows.join(F.broadcast(marks), word == F.col("_word"), "left")
    return seen.select(*rows.columns, (F.coalesce(F.col("mask"), F.lit(0)).bitwiseAND(bit) != 0).alias("likely"))


def _exact_links(
    texts: DataFrame, members: DataFrame, width: int, similarity: float, radius: int, words: int, meet: bool
) -> DataFrame:
    """Edges ``(a, b, large)`` within the groups of ``members``; ``meet`` compares all tiles of a group, else each with itself.

    ``members`` is a stored table, as it is read three times.
    """
    buckets = max(1, members.count() // GROUP)
    once = _marked(texts.select(F.xxhash64("text").alias("text_hash"), "text"), members).where("likely").join(members, "text_hash")
    firsts = [F.first(c).alias(c) for c in ("text", "root", "tiles", "sub")]
    once = once.groupBy("text_hash").agg(*firsts)
    columns = "text_hash bigint, root bigint, tiles int, sub bigint, fp array<bigint>, shingles array<bigint>"

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.unique(shingle_hashes(x.as_py(), width)) for x in batch.column(4)]
            arrays = [pa.array([set_fingerprint(h, words) for h in hashes], pa.list_(pa.int64())), pa.array([h.view(np.int64) for h in hashes], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *arrays], ["text_hash", "root", "tiles", "sub", "fp", "shingles"])

    full = once.select("text_hash", "root", "tiles", "sub", "text").mapInArrow(shingled, columns)
    tile = F.pmod(F.xxhash64("text_hash", F.lit(3)), F.col("tiles")).cast("int")
    # small groups share a bucket; a large one has a task for each of its tiles, or for each pair of them
    others = F.sequence(F.lit(0), F.col("tiles") - 1) if meet else F.array("tile")
    meets = F.transform(others, lambda o: F.struct(F.least(o, F.col("tile")).alias("low"), F.greatest(o, F.col("tile")).alias("high")))
    home = F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("root"), F.lit(buckets))).otherwise(F.col("root"))
    dealt = full.withColumn("tile", tile).withColumn("m", F.explode(meets)).withColumn("home", home)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, bool]] = []
        for _, group in frame.groupby("root"):
            cross, large = group["tile"].nunique() > 1, bool(group["tiles"].iloc[0] > 1)
            columns = (group[c] for c in ("text_hash", "fp", "shingles", "tile", "sub"))
            rows = [(h, np.asarray(f, "<i8").view(np.uint64), np.asarray(s, "<i8"), t, u) for h, f, s, t, u in zip(*columns, strict=True)]
            found += [(a, b, large) for a, b in _stars(_blank_links(rows) + _confirmed(rows, radius, similarity, cross))]
        return pd.DataFrame(found, columns=["a", "b", "large"]).astype({"a": "int64", "b": "int64", "large": "bool"})

    keyed = dealt.select("home", "tiles", F.col("m.low").alias("low"), F.col("m.high").alias("high"), "root", "tile", "text_hash", "sub", "fp", "shingles")
    grouped = keyed.groupBy("home", F.col("tiles") > 1, "low", "high")
    return stored(grouped.applyInPandas(run, "a bigint, b bigint, large boolean"), "confirmed")


def _blank_links(rows: list[tuple]) -> list[tuple[int, int]]:
    blank = [r[0] for r in rows if not len(r[2])]
    return [(blank[0], other) for other in blank[1:]]


def _stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts that ``links`` connect, as edges from each text to the smallest of its part."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return [(x, p) for x in list(root) if (p := top(x)) != x]


def without_near_duplicates(documents: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 80, words: int = 4) -> DataFrame:
    """``documents`` with one row of each group of near duplicates: the smallest ``doc_id``, null ids last.

    Of rows that repeat an id and a text one stays. All columns pass through unchanged.
    """
    groups = stored(near_duplicates(documents, width, similarity, radius, words), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n_rows")
    winners = groups.groupBy("root").agg(F.min(first).alias("w")).select(
        F.col("w.doc_id").alias("_id"), F.col("w.text_hash").alias("_hash"), F.col("w.n_rows").alias("_rows")
    )
    # documents that are alone stay where they are; only those of groups and repeated ones are joined with the winners
    crowds = groups.groupBy("root").agg(F.count("*").alias("n"), F.max("n_rows").alias("most")).where("n > 1 OR most > 1")
    keyed = packed(documents, F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("text_hash"))
    keyed = _marked(keyed, groups.join(crowds.select("root"), "root").select("text_hash"))
    alone = keyed.where("NOT likely")
    keyed = keyed.where("likely")
    kept = keyed.join(winners, keyed["id"].eqNullSafe(winners["_id"]) & (keyed["text_hash"] == winners["_hash"]))
    single, repeated = kept.where("_rows = 1"), kept.where("_rows > 1").dropDuplicates(["_id", "_hash"])
    return unpacked(alone.select("row").unionByName(single.select("row")).unionByName(repeated.select("row")))


@query("op1_simhash")
def op1_simhash(spark, folder):
    groups = simhash_groups(table(spark, folder, "documents"), width=3, radius=2)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", hexed.alias("fingerprint"), "component_id")
