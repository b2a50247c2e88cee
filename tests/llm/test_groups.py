"""SimHash groups, near duplicates, vectors and components against plain code."""

import math
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tallyflow.llm import components, pivots, simhash
from tallyflow.llm.common import stored
from tallyflow.llm.components import connected_components
from tests.llm.cases import CLASHING, HARD, edited, empty, hard, prose


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return {n: top(n) for n in nodes}


def test_components(spark):
    pick = random.Random(3)
    pairs = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == union([p for p in pairs if p[0] != p[1]], nodes)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def labels_stored(monkeypatch, *modules):
    """Counts, by label, the tables that ``modules`` store from now on."""
    seen = Counter()
    for module in modules:
        monkeypatch.setattr(module, "stored", lambda rows, label: (seen.update([label]), stored(rows, label))[1])
    return seen


def test_components_of_stars_take_no_step(spark, monkeypatch):
    seen = labels_stored(monkeypatch, components)
    stars = [(10 * i + k, 10 * i) for i in range(20) for k in range(1, 4)]
    found = connected_components(spark.createDataFrame(stars, "a bigint, b bigint"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {*stars, *((b, b) for _, b in stars)}
    assert seen == {"edges": 1}
    connected_components(spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "a bigint, b bigint")).collect()
    assert seen == {"edges": 2, "stars": 1}


def test_stored_tables_leave_no_shuffle_files(spark):
    folders = [f.getPath() for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {p for f in folders for p in Path(f).rglob("shuffle_*")}
    before = shuffled()
    counts = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.monotonic() + 20  # the files go in the background
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert {r["k"]: r["count"] for r in counts.collect()} == {k: 142 + (k < 6) for k in range(7)}


def test_links_of_a_tile_are_stars_around_the_smallest(spark):
    rows = [(50 - i, [1 << i if i else 0]) for i in range(12)] + [(200 + i, [-1 ^ (1 << i)]) for i in range(6)]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "key bigint, fp array<bigint>"), 80, 1).collect()
    assert {(r["a"], r["b"]) for r in links} <= {(k, 39) for k, _ in rows if k != 39}
    assert connected_components(spark.createDataFrame(links, "a bigint, b bigint")).select("root").distinct().count() == 1


def test_a_group_joined_in_its_tiles_reads_the_texts_once_more(spark, monkeypatch):
    """Where the representatives settle a large group, the texts are not read for pairs that can't be open."""
    monkeypatch.setattr(simhash, "GROUP", 8)
    base = prose(6, 200)
    frame = spark.createDataFrame([(i, edited(base, 70 + i)) for i in range(60)], "doc_id bigint, text string")
    seen = labels_stored(monkeypatch, simhash)
    assert simhash.near_duplicates(frame).select("root").distinct().count() == 1
    assert seen["confirmed"] == 2


def slow_fingerprint(text, width):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_against_all_pairs(spark):
    rows = [(i, t) for i, t, *_ in HARD if i is not None and i != 9]
    rows += [(100 + i, edited(prose(1), 110 - i)) for i in range(8)] + [(200 + i, prose(200 + i)) for i in range(30)]
    found = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    marks = {i: slow_fingerprint(t, 3) for i, t in rows}
    ids = sorted(marks)
    near = [(a, b) for a in ids for b in ids if a < b and (marks[a] ^ marks[b]).bit_count() <= 2]
    expected = union(near, ids)
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in found} == {i: (marks[i], expected[i]) for i in ids}


def test_simhash_hard_cases(spark):
    found = simhash.simhash_groups(hard(spark, clashing=True)).collect()
    assert len(found) == len(HARD)
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[i]["fp"] for i in (4, 5, 6)} == {0} and {by_id[i]["component_id"] for i in (4, 5, 6)} == {4}
    assert by_id[None]["component_id"] is None
    assert simhash.simhash_groups(empty(spark)).count() == 0


def test_tiles_skip_nothing():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 700, dtype=np.uint64)[:, None]
    near = base ^ (np.uint64(1) << rng.integers(0, 63, (700, 1)).astype(np.uint64))
    u, v = simhash.link_within(base, near, 1, same=False)
    assert len(u) == 700
    u, v = simhash.link_within(np.concatenate([base, near]), np.concatenate([base, near]), 1, same=True)
    assert len(u) == 700


def shingle_similarity(a, b):
    x, y = (({" ".join(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t.split() else set()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_near_duplicates(spark):
    rows = [(i, prose(300 + i)) for i in range(40)]
    rows += [(100 + i, edited(prose(300 + i), 50)) for i in range(20)]  # similarity above 0.8
    rows += [(200 + i, edited(prose(300 + i), 8)) for i in range(20)]  # below
    kept = {r["doc_id"] for r in simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    text = dict(rows)
    close = [(a, b) for a in text for b in text if a < b and shingle_similarity(text[a], text[b]) >= 0.8]
    assert len(close) >= 20
    assert kept == set(union(close, text).values())


def test_near_duplicates_at_exactly_the_similarity(spark):
    rows, pairs = [], []

    def pair(a, b):
        assert shingle_similarity(a, b) >= 0.8
        pairs.append((len(rows), len(rows) + 1))
        rows.extend([(len(rows), a), (len(rows) + 1, b)])

    for i in range(300):  # four of five shingles
        words = prose(9000 + i, 9).split()
        pair(" ".join(words[:8]), " ".join(words))
    for i in range(60):  # 16 of 20 and 80 of 100
        words = prose(9500 + i, 24 if i % 2 else 104).split()
        pair(" ".join(words[: 20 if i % 2 else 84]), " ".join(words))
    for i in range(40):  # a passage said again and again adds no shingle but those between its copies
        text, passage = prose(9700 + i, 120), prose(9800 + i, 14)
        pair(text, " ".join([text, *[passage] * (2 + i % 5)]))
    assert shingle_similarity(rows[0][1], rows[1][1]) == 0.8
    found = {r["doc_id"]: r["root"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [p for p in pairs if found[p[0]] != found[p[1]]] == []


def test_unrelated_texts_are_not_compared(spark, monkeypatch):
    """Fingerprints are compared within lists of texts that share a first shingle, not all with all."""
    pairs = spark.sparkContext.accumulator(0)
    all_pairs, by_row = simhash._distance, getattr(simhash, "_row_distance", None)

    def counted(left, right):
        pairs.add(len(left) * len(right))
        return all_pairs(left, right)

    def counted_rows(left, right):
        pairs.add(len(left))
        return by_row(left, right)

    monkeypatch.setattr(simhash, "_distance", counted)
    monkeypatch.setattr(simhash, "_row_distance", counted_rows, raising=False)
    rows = [(i, prose(20_000 + i, 60)) for i in range(400)] + [(1000 + i, edited(prose(20_000 + i, 60), 55)) for i in range(10)]
    found = {r["doc_id"]: r["root"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(set(found.values())) == 400 and all(found[i] == found[1000 + i] for i in range(10))
    assert pairs.value <= 2 * len(rows)  # 84,000 pairs at least when all were compared


def test_similar_sets_share_a_head():
    rng = np.random.default_rng(5)
    frequent = np.sort(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    often = rng.integers(2, 9, 500)
    for similarity in (0.5, 0.8, 0.9, 1.0):
        for _ in range(300):
            both, one = int(rng.integers(1, 60)), rng.integers(0, 1 << 63, 60, dtype=np.uint64)
            shared = np.concatenate([rng.choice(frequent, both // 2, replace=False), rng.integers(0, 1 << 63, both - both // 2, dtype=np.uint64)])
            apart = math.floor(len(np.unique(shared)) / similarity + 1e-9) - len(np.unique(shared))
            cut = int(rng.integers(0, apart + 1))
            a, b = np.unique(np.concatenate([shared, one[:cut]])), np.unique(np.concatenate([shared, one[cut:apart]]))
            for known, n in ((frequent, often), (frequent[:0], often[:0])):
                first = [simhash.heads(x, similarity, known, n) for x in (a, b)]
                assert np.intersect1d(*first).size
    assert simhash.heads(a[:0], 0.8, frequent, often).tolist() == [0]
    assert len(simhash.heads(one, 0.8, frequent, often)) == 13  # 60 - 48 + 1


def test_long_lists_link_as_all_pairs(monkeypatch):
    rng = np.random.default_rng(6)
    marks = rng.integers(0, 1 << 63, (400, 4), dtype=np.uint64)
    for i in range(400):
        if i % 4:  # a large group, small ones and lone marks
            marks[i] = marks[0 if i < 250 else 4 * (i // 8)] ^ (rng.random((4, 64)) < 0.12).dot(np.uint64(1) << np.arange(64, dtype=np.uint64)).astype(np.uint64)
    x, y = np.nonzero(np.triu(simhash._distance(marks, marks) <= 80, 1))
    expected = union(list(zip(x.tolist(), y.tolist())), range(400))
    assert 20 < len(set(expected.values())) < 200
    for pivots_ in (0, 1, 8):
        monkeypatch.setattr(simhash, "PIVOTS", pivots_)
        u, v = simhash.link_list(marks, 80)
        assert union(list(zip(u.tolist(), v.tolist())), range(400)) == expected


def test_runs_are_not_cut():
    column = [1, 1, 2, 2, 2, 2, 2, 3, 5, 5]
    for size in (1, 2, 3, 4, 10):
        pieces = [pa.array(column[i : i + size]) for i in range(0, 10, size)]
        batches = [pa.RecordBatch.from_arrays([p, p], ["k", "v"]) for p in [pieces[0][:0], *pieces]]
        runs = [(k.tolist(), v.tolist()) for k, v in simhash._runs(iter(batches))]
        assert [x for k, _ in runs for x in k] == [x for _, v in runs for x in v] == column
        assert all(a[-1] != b[0] for (a, _), (b, _) in zip(runs, runs[1:]))
    assert list(simhash._runs(iter([]))) == []


def test_the_order_of_shingles_changes_no_result(spark, monkeypatch):
    """Whichever shingles are known to be frequent, long lists or short: the same groups as by all pairs."""
    common = prose(77, 60)
    rows = [(i, prose(600 + i, 100) + " " + common) for i in range(12)] + [(100 + i, edited(prose(600 + i, 100), 50) + " " + common) for i in range(12)]
    rows += [(200 + i, edited(prose(6, 200), 60 + i)) for i in range(40)] + [(300 + i, " " * i) for i in range(3)]
    text = dict(rows)
    expected = union([(a, b) for a in text for b in text if a < b and shingle_similarity(text[a], text[b]) >= 0.8], text)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for sample, frequent, short in ((1, 1 << 18, 64), (1, 20, 4), (64, 1 << 18, 4)):
        for name, value in (("SAMPLE", sample), ("FREQUENT", frequent), ("SHORT_LIST", short)):
            monkeypatch.setattr(simhash, name, value)
        found = {r["doc_id"]: r["root"] for r in simhash.near_duplicates(frame).collect()}
        assert {i: min(k for k in found if found[k] == r) for i, r in found.items()} == expected


def test_wide_fingerprints():
    marks = np.array([[0, 0, 0, 0], [(1 << 64) - 1] * 4, [(1 << 64) - 1, 0, 0, 0], [0, 0, 0, 255]], np.uint64)
    assert simhash._distance(marks, marks)[0].tolist() == [0, 256, 64, 8]
    u, v = simhash.link_within(marks, marks, 80, same=True)
    assert sorted(zip(u.tolist(), v.tolist())) == [(2, 0), (3, 0)]
    pair = [simhash.set_fingerprint(np.array(h, np.uint64), 4) for h in ([3 << 40, 5 << 50], [7 << 45, 9 << 55])]
    assert pair[0][0] == 3 << 40 and pair[1][0] == 7 << 45  # two shingles: ties go with the first


def test_near_duplicates_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 4)
    base = prose(5, 300)
    rows = [(i, edited(base, 60 + i)) for i in range(30)] + [(100 + i, prose(700 + i)) for i in range(5)]
    assert {r["doc_id"] for r in simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {0, *range(100, 105)}


def test_chains_across_tiles_are_followed(spark, monkeypatch):
    """Texts that are near their neighbours only: the links lie between members that represent nothing."""
    monkeypatch.setattr(simhash, "GROUP", 4)
    rows = []
    for family in range(3):
        words = prose(40 + family, 700).split()
        rows += [(100 * family + i, " ".join(words[8 * i : 8 * i + 100])) for i in range(26)]
        rows += [(100 * family + 50 + i, edited(rows[-1 - i][1], 70 + i)) for i in range(12)]
    text = dict(rows)
    close = [(a, b) for a in text for b in text if a < b and shingle_similarity(text[a], text[b]) >= 0.8]
    expected = union(close, text)
    assert len(set(expected.values())) == 3
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"] for r in kept.collect()} == set(expected.values())


def test_a_large_group_is_carried_once(spark, monkeypatch):
    """Most rows that reach a comparing task do not grow with the number of tiles of a group of near copies."""
    sizes = []
    keep = simhash._confirmed
    monkeypatch.setattr(simhash, "GROUP", 8)
    base = prose(6, 200)
    rows = [(i, edited(base, 70 + i)) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    sums = spark.sparkContext.accumulator(0)

    def counted(rows, *more):
        sums.add(len(rows))
        return keep(rows, *more)

    monkeypatch.setattr(simhash, "_confirmed", counted)
    groups = simhash.near_duplicates(frame)
    assert groups.select("root").distinct().count() == 1
    sizes.append(sums.value)
    distinct = frame.select("text").distinct().count()
    assert distinct <= sizes[0] <= 3 * distinct  # 15 tiles: 15 times as many when all tiles met



def test_near_duplicates_hard_cases(spark):
    kept = simhash.without_near_duplicates(hard(spark, clashing=True))
    assert kept.columns == hard(spark, clashing=True).columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 4, 7, 8, 9, 10, 12, 13]
    assert sum(r["doc_id"] is None for r in rows) == 1 and all(r[c] == "own" for r in rows for c in CLASHING)
    assert simhash.without_near_duplicates(empty(spark)).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(250, 16))
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i] + rng.normal(scale=0.03, size=16)).tolist(), int(i % 3)) for i in range(120)]
    rows += [(2000 + i, base[7].tolist(), 1) for i in range(50)] + [(3000, (3 * base[8]).tolist(), 2), (3001, base[8].tolist(), 0)]
    rows += [(4000, None, 1), (4001, [0.0] * 16, 1), (4002, [float("nan")] * 16, 1), (4003, [None] * 16, 1), (4004, base[0].tolist(), None), (4005, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "'own' AS node", "0 AS tile", "1 AS copies")
    found = {r["vec_id"]: r for r in pivots.vector_groups(frame).collect()}
    good = [r for r in rows if r[0] < 4000]
    unit = np.array([r[1] for r in good])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    x, y = np.nonzero(np.triu((unit @ unit.T >= 0.98) & (label[:, None] == label[None]), 1))
    names = [r[0] for r in good]
    roots = union([(names[a], names[b]) for a, b in zip(x, y)], [r[0] for r in rows])
    links = {r[0]: 0 for r in rows}
    for a, b in zip(x, y):
        links[names[a]] += 1
        links[names[b]] += 1
    assert len(found) == len(rows)
    exact = sum(r["n_links"] for r in found.values()) / sum(links.values())
    assert 0.9 <= exact <= 1 and all(found[i]["n_links"] <= links[i] for i in links)
    assert sum(found[i]["component_id"] == roots[i] for i in roots) >= 0.98 * len(roots)
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in range(4000, 4006))


def test_vector_lists_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(pivots, "TILE", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=24)
    rows = [(i, (base + rng.normal(scale=0.02, size=24)).tolist(), 1) for i in range(90)]
    found = pivots.vector_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), cosine=0.9).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(89, 0)}


def test_vectors_empty(spark):
    assert pivots.vector_groups(spark.createDataFrame([], "vec_id bigint, embedding array<double>, label int")).count() == 0
