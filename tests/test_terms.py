"""Learned Han terms against plain code."""

import random
import re
from collections import Counter, defaultdict
from itertools import product

import pytest

from tallyflow.operators.terms import gram_statistics, learned_terms, segmented
from tallyflow.plans.search import learned_term_counts

WORDS = ["山水", "天气预报", "火车", "站", "图书馆", "馆", "水", "火", "天", "𠀀𠀁"]


def statistics_by_hand(runs, longest):
    count, before, behind = Counter(), defaultdict(set), defaultdict(set)
    for run, n in runs.items():
        padded = f" {run} "
        for at, k in product(range(1, len(run) + 1), range(1, longest + 1)):
            if at + k < len(padded):
                gram = padded[at : at + k]
                count[gram] += n
                before[gram].add(padded[at - 1])
                behind[gram].add(padded[at + k])
    return {g: (count[g], len(before[g]), len(behind[g])) for g in count}


def terms_by_hand(stats, least, branches, cohesion):
    total = sum(n for g, (n, *_) in stats.items() if len(g) == 1)
    whole = lambda g, n: all(n * total >= cohesion * stats[g[:k]][0] * stats[g[k:]][0] for k in range(1, len(g)))
    return {g: n for g, (n, a, b) in stats.items() if len(g) > 1 and n >= least and min(a, b) >= branches and whole(g, n)}


def cut_by_hand(run, terms, longest):
    """All ways to cut, and the best of them."""
    if not run:
        return []
    ways = []

    def go(at, pieces):
        if at == len(run):
            ways.append(pieces)
        for k in range(1, min(longest, len(run) - at) + 1):
            if k == 1 or run[at : at + k] in terms:
                go(at + k, [*pieces, run[at : at + k]])

    go(0, [])
    return min(ways, key=lambda w: (len(w), -sum(terms.get(p, 0) for p in w if len(p) > 1), [-len(p) for p in w]))


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(WORDS, k=rng.randrange(1, 6))) for _ in range(n)]


@pytest.mark.parametrize("longest, cohesion", [(4, 2), (3, 10), (2, 1)])
def test_against_every_way_to_cut(spark, longest, cohesion):
    rows = [*texts(longest, 250), *["山水火车站"] * 120, "abc天气预报12图书馆", "", None, "火 车", "ß天"]
    pieces = Counter(p for t in rows for p in re.findall(r"[一-鿿𠀀-𠿿]+|[^\W一-鿿𠀀-𠿿]+", t or ""))
    runs = {r: n for r, n in pieces.items() if re.match("[一-鿿𠀀-𠿿]", r)}
    stats = statistics_by_hand(runs, longest)
    frame = spark.createDataFrame(list(runs.items()), "word string, runs bigint")
    found = gram_statistics(frame, longest=longest).collect()
    assert {r["gram"]: (r["count"], r["before"], r["behind"]) for r in found} == stats
    terms = terms_by_hand(stats, 5, 2, cohesion)
    assert terms
    want = Counter()
    for run, n in pieces.items():
        for term in cut_by_hand(run, terms, longest) if run in runs else [run]:
            want[term] += n
    records = spark.createDataFrame([(t,) for t in rows], "query_words string")
    got = learned_term_counts(records, longest=longest, cohesion=cohesion).collect()
    assert {r["word"]: r["count"] for r in got} == want


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "query_words string")
    assert learned_term_counts(none).count() == 0
    single = spark.createDataFrame([("山",), ("only letters",), (None,)], "query_words string")
    assert {tuple(r) for r in learned_term_counts(single).collect()} == {("山", 1), ("only", 1), ("letters", 1)}


def test_a_very_long_run_is_cut_in_one_pass(spark):
    run = "".join(texts(9, 20_000))
    frame = spark.createDataFrame([(run, 1)], "word string, runs bigint")
    terms = learned_terms(gram_statistics(frame), cohesion=2)
    (found,) = segmented(frame, terms).collect()
    assert "".join(found["terms"]) == run and len(found["terms"]) < len(run) / 1.5
