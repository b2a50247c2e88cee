"""Corpus-wide audits: source divergence, spelling variants and benchmark passages, held against plain code."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyflow.llm import decontaminate, spelling, stripes
from tallyflow.llm.common import stored
from tests.llm.cases import HARD, SCHEMA, empty, hard

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# divergence of sources

def plain_divergences(rows, least=3, most=200):
    rows = [((t or "").translate(CAPITALS), la or "", s or "") for _, t, la, s in rows]
    found = []
    for lang in {la for _, la, _ in rows}:
        mine = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t), s) for t, la, s in rows if la == lang]
        documents = Counter(w for words, _ in mine for w in set(words))
        kept = [w for w, n in documents.items() if n >= least]
        counts = {s: Counter() for _, s in mine}
        for words, s in mine:
            counts[s].update(w for w in words if documents[w] >= least)
        share = lambda c, w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))
        apart = lambda p, q: (p - q) ** 2 // q
        whole = sum(counts.values(), Counter())
        for s, c in counts.items():
            pairs = [(sum(apart(share(c, w), share(o, w)) for w in kept), t) for t, o in counts.items() if t != s]
            terms = [(apart(share(c, w), share(whole, w)), w) for w in c if c[w] and share(c, w) > share(whole, w)]
            for part, values, top in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:top]
                found += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(found)


def mixed_documents(n=400, sources=7):
    pick = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["É", "日本", "Straße", "ıI"]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{pick.randrange(sources)}"
        some = words[pick.randrange(60) :]
        text = " ".join(some[min(len(some) - 1, int(pick.expovariate(0.1)))] for _ in range(pick.randrange(40)))
        rows.append((i, text, pick.choice(["en", "de", None]), source))
    return rows + HARD


def divergences(found):
    return sorted(tuple(r[c] for c in stripes.RESULTS) for r in found.collect())


def test_divergences_agree_with_plain_code(spark):
    rows = mixed_documents()
    documents = frame(spark, rows).selectExpr("*", "'own' AS term", "'own' AS entries", "1 AS n").repartition(6)
    assert divergences(stripes.source_divergences(documents)) == plain_divergences(rows)
    assert divergences(stripes.source_divergences(documents, least=1, most=5)) == plain_divergences(rows, 1, 5)


def test_sums_of_pairs_by_join_are_those_of_tasks(spark):
    documents = frame(spark, mixed_documents())
    kept = stored(stripes.merged_stripes(documents), "stripes")
    groups = stored(stripes.source_sizes(documents, kept), "groups")
    rows = lambda most: sorted(map(tuple, stripes.pair_divergences(kept, groups, most).collect()))
    assert rows(256) == rows(0) != []


def test_spilled_stripes_add_up(spark):
    rows = mixed_documents(90)
    batch = stripes._texts(frame(spark, rows)).toArrow().combine_chunks().to_batches()
    sums = lambda spill: sum(
        (Counter({(r["lang"], r["term"], s): n for r in b.to_pylist() for s, n in zip(r["sources"], r["counts"])}) for b in stripes.fold(batch, spill)), Counter()
    )
    assert sums(50) == sums(10**6)


def test_shares_are_exact(spark):
    cases = [(0, 1), (10**12, 3 * 10**12 + 7), (9 * 10**13 - 1, 9 * 10**13), (5, 7), (10**9, 10**9 + 3)]
    expected = [1 + 10**9 * (n + 1) // below for n, below in cases]
    found = spark.createDataFrame([(*c, i) for i, c in enumerate(cases)], "n bigint, below bigint, i int")
    assert [r[0] for r in found.select(stripes.share(F.col("n"), F.col("below")), "i").sort("i").collect()] == expected
    n, below = np.array(cases).T
    assert stripes._shares(n, below).tolist() == expected


def test_divergences_of_hard_tables(spark):
    assert divergences(stripes.source_divergences(hard(spark, clashing=True))) == plain_divergences(HARD)
    assert stripes.source_divergences(empty(spark)).count() == 0
    blank = [(1, None, None, None), (2, "", None, "a"), (3, " ", None, "b")]
    assert divergences(stripes.source_divergences(frame(spark, blank))) == plain_divergences(blank)


# spelling variants

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(rows, every=199):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts[spelling.damaged("" if doc_id is None else str(doc_id), run.translate(CAPITALS), every)] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    found = []
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        found.append((w, forms[w], root, words[w], len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(found, key=repr)


def misspelt(n=300):
    pick = random.Random(8)
    base = ["kitchen", "mothers", "garden", "Àlamèdaß", "abcdefg", "abcdeff", "abcdef", "aaaaaaa", "aaaaaa", "bananana"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(40):
            w = base[min(int(pick.expovariate(0.5)), len(base) - 1)]
            at, turn = pick.randrange(len(w)), pick.random()
            letter = pick.choice("abeÿ")
            if turn < 0.1:
                w = w[:at] + letter + w[at + (turn < 0.05) :]
            elif turn < 0.14:
                w = w[:at] + w[at + 1 :]
            words.append(w)
        rows.append((i, " ".join(words), "en", "s"))
    return rows + [(n, "chainaaa " * 150 + "chainaab " * 30 + "chainabb " * 6, "en", "s")]


def groups_of(found):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()), key=repr)


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_spelling_groups_agree_with_plain_code(spark, symbols):
    rows = misspelt()
    expected = plain_groups(rows)
    assert len({r[2] for r in expected if r[1]}) > 3 and any(r[1] and r[2] != r[1] for r in expected)
    assert groups_of(spelling.spelling_groups(frame(spark, rows), symbols=symbols)) == expected


@settings(max_examples=60, deadline=None)
@given(st.text("abcdeÿ", min_size=1, max_size=12), st.integers(1, 9))
def test_neighbourhood_is_complete(word, symbols):
    """The hashes are exactly those of the reduced word and of all its one-edit neighbours."""
    code = spelling._Hash(symbols)
    hashed = lambda b: int(code.prefixes(np.frombuffer(b, np.uint8).reshape(1, -1))[0, -1])
    form = spelling.reduced(word, symbols)
    near = {form}
    for i in range(len(form) + 1):
        near |= {form[:i] + bytes([s]) + form[i:] for s in range(symbols)}
        if i < len(form):
            near |= {form[:i] + form[i + 1 :]} | {form[:i] + bytes([s]) + form[i + 1 :] for s in range(symbols)}
    matrix = np.frombuffer(form, np.uint8).reshape(1, -1)
    prefixes = code.prefixes(matrix)
    halves = [code.edits(matrix, prefixes, a, b) for a, b in ((0, len(form) // 2), (len(form) // 2, len(form) + 1)) if b > a]
    assert set(np.concatenate(halves, axis=1)[0].tolist()) == {hashed(b) for b in near}


def test_spelling_of_hard_tables(spark):
    assert groups_of(spelling.spelling_groups(hard(spark, clashing=True))) == plain_groups(HARD)
    assert spelling.spelling_groups(empty(spark)).count() == 0
    long = [(i, "x" * 30_000 + " " + "x" * 30_001 + " kitchen", None, None) for i in range(6)]
    assert groups_of(spelling.spelling_groups(frame(spark, long))) == plain_groups(long)


# benchmark passages

def plain_hits(rows, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(CAPITALS))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    found = []
    for doc_id, text, *_ in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= owners
        found.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def leaking(n=250):
    pick = random.Random(11)
    words = "a b c d e the of É 12 zebra quiet lamp ß Ω one two".split()
    items = [(i, " ".join(pick.choice(words) for _ in range(pick.choice([1, 2, 3, 8, 9, 10, 11, 30])))) for i in range(30)]
    items = [(i, t) for i, t in items if t not in words[:7]] + [(None, "Lamp, lamp LAMP"), (40, None), (41, ""), (7, items[7][1]), (42, "a " * 25), (43, items[9][1])]
    rows = []
    for i in range(n):
        text = " ".join(pick.choice(words[:12]) for _ in range(pick.randrange(60)))
        if i % 3 == 0:
            part = (items[pick.randrange(len(items))][1] or "").split()
            text += "\n" + " ".join(part[pick.randrange(3) :]) + (" " + text if i % 2 else "")
        rows.append((i, text.upper() if i % 5 == 0 else text, "en", "s"))
    return rows + [(900, "a " * 3_000, "en", "s")] + HARD, items


def hits_of(found):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block_words", [500_000, 400])
def test_benchmark_hits_agree_with_plain_code(spark, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "CANDIDATES", 64)
    rows, items = leaking()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = plain_hits(rows, items)
    assert 0 < sum(r[5] for r in expected) < len(rows)
    found = decontaminate.contamination(frame(spark, rows).repartition(3), benchmark, block_words=block_words)
    assert hits_of(found) == expected
    for r in found.where("n_hit > 0").collect():
        assert r["n_hit"] == sum(x["end"] - x["begin"] for x in r["hit_ranges"]) and len(r["items"]) == r["n_items"]


def test_windows_meet_documents_at_their_rarest_shingle():
    block = decontaminate.numbered_windows([("x", b"the of the of the zebra of the of the")])
    number, keys = block["number"], decontaminate.shingle_keys(block)
    zebra = [k for k in keys.tolist() if number[b"zebra"] in (k & (1 << 20) - 1, k >> 20 & (1 << 20) - 1, k >> 40 & (1 << 20) - 1)]
    counts = np.array([1 if k in zebra else 50 for k in keys.tolist()])
    token, window, place = decontaminate.rarest_shingles(block, keys, counts)
    assert token.tolist()[0] in zebra and window.tolist() == [0] and place.tolist()[0] in (3, 4, 5)


def test_contamination_of_hard_tables(spark):
    items = [(1, "river runs past"), (2, HARD[0][1]), (3, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    clashing = hard(spark, clashing=True).selectExpr("*", "'own' AS n_hit", "'own' AS begins", "'own' AS item")
    found = decontaminate.contamination(clashing, benchmark)
    assert hits_of(found) == plain_hits(HARD, items)
    assert {r["begins"] for r in found.collect()} == {"own"}
    assert decontaminate.contamination(empty(spark), benchmark).count() == 0
    none = decontaminate.contamination(hard(spark), benchmark.where("item_id = 3"))
    assert hits_of(none) == plain_hits(HARD, [])
