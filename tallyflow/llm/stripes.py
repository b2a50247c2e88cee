"""Divergence of sources within a language, from term stripes folded in the mappers."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import query, stored, table

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SPILL = 400_000  # entries of stripes a task holds before it hands them on
#: Up to so many sources in a language and groups in all, a task adds up divergences of all pairs of sources at once.
MOST_SOURCES, MOST_GROUPS = 256, 20_000
CELLS = 1 << 18  # term counts of sources that are divided in one step
SCALE = 1_000_000_000

#: Bytes of a term as they are, A-Z in lower case, all others as spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STRIPE = "lang string, term binary, sources array<string>, counts array<bigint>"
_ARROW = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
STEP = 256  # documents turned into Python values at once


def _spilled(stripes: dict[str, dict[bytes, dict]]):
    """Record batches of the stripes; the entry without a source is the number of documents."""
    for lang, of_terms in stripes.items():
        terms = list(of_terms)
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            rows = [of_terms[t] for t in part]
            columns = [[lang] * len(part), part, [list(r) for r in rows], [list(r.values()) for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def fold(batches, spill: int = SPILL):
    """Whole documents folded into stripes: term to document count and count per source."""
    stripes: dict[str, dict[bytes, dict]] = {}
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, lang, source in zip(texts, part.column("lang").to_pylist(), part.column("source").to_pylist()):
                of_terms = stripes.setdefault(lang, {})
                for term, n in Counter(text.translate(TERM_BYTES).split()).items():
                    stripe = of_terms.get(term)
                    if stripe is None:
                        of_terms[term] = {None: 1, source: n}
                        held += 2
                    else:
                        stripe[None] += 1
                        if source in stripe:
                            stripe[source] += n
                        else:
                            stripe[source] = n
                            held += 1
                if held >= spill:
                    yield from _spilled(stripes)
                    stripes, held = {}, 0
    yield from _spilled(stripes)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def merged_stripes(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, term, entries)`` of the terms in at least ``least`` documents; an entry is ``(source, n)``.

    Stripes of one key meet in one task, at most one from each spill, and are added up source by source there: the one
    shuffle is by language and term.
    """
    parts = _texts(documents).mapInArrow(fold, STRIPE).repartition("lang", "term")
    entry = parts.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    sums = entry.groupBy("lang", "term", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    found = sums.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("documents"),
        F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n"))).alias("entries"),
    )
    return found.where(F.col("documents") >= least).select("lang", "term", "entries")


def source_sizes(documents: DataFrame, stripes: DataFrame) -> DataFrame:
    """``(lang, source, below, terms)`` of every group; ``below`` is the divisor N + V of its shares, ``terms`` is V."""
    groups = _texts(documents).select("lang", "source").distinct()
    sizes = _entries(stripes).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    terms = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    known = groups.join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
    terms = F.coalesce("terms", F.lit(0))
    return known.select("lang", "source", (F.coalesce("n", F.lit(0)) + terms).alias("below"), terms.alias("terms"))


def _entries(stripes: DataFrame) -> DataFrame:
    return stripes.select("lang", "term", F.explode("entries").alias("e")).select("lang", "term", "e.source", "e.n")


def share(n: Column, below: Column) -> Column:
    """1 + floor(10^9 (n + 1) / below), divided in two steps so that counts up to 9 * 10^13 stay exact."""
    first = (n + 1) * 100_000
    return F.call_function("div", first, below) * 10_000 + F.call_function("div", (first % below) * 10_000, below) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    first = (counts + 1) * 100_000
    return first // below * 10_000 + first % below * 10_000 // below + 1


def _adds_pairs(sizes: dict[str, dict[str, int]]):
    """Function for tasks: sums of the divergence over their stripes, one row per pair of sources and language."""

    def run(batches):
        place = {lang: {s: i for i, s in enumerate(of)} for lang, of in sizes.items()}
        below = {lang: np.array(list(of.values()), np.int64) for lang, of in sizes.items()}
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            entries = batch.column("entries")
            for lang in set(langs.tolist()):
                rows = np.flatnonzero(langs == lang)
                k = len(below[lang])
                held = sums.setdefault(lang, np.zeros((k, k), np.int64))
                step = max(1, CELLS // k)
                for at in range(0, len(rows), step):
                    part = entries.take(pa.array(rows[at : at + step]))
                    flat = part.flatten()
                    counts = np.zeros((len(part), k), np.int64)
                    owner = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                    where = np.fromiter(map(place[lang].__getitem__, flat.field("source").to_pylist()), np.int64, len(flat))
                    counts[owner, where] = flat.field("n").to_numpy()
                    p = _shares(counts, below[lang])
                    for i in range(k):
                        gap = p[:, i : i + 1] - p
                        held[i] += (gap * gap // p).sum(axis=0)
        for lang, held in sums.items():
            names = list(place[lang])
            a, b = np.nonzero(~np.eye(len(names), dtype=bool))
            columns = [[lang] * len(a), [names[i] for i in a], [names[i] for i in b], held[a, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUMS)], schema=_SUMS)

    return run


def _pairs_by_join(stripes: DataFrame, groups: DataFrame) -> DataFrame:
    """The same sums from joins, for any number of sources.

    Terms that one source of a pair lacks need only the histogram of the other's counts; terms that both have meet in a
    join on the term.
    """
    zero = F.lit(0).cast("bigint")
    sized = groups.select("lang", "source", "below", "terms", F.when(F.col("terms") > 0, share(zero, F.col("below"))).alias("p0"))
    entries = _entries(stripes).join(sized, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("below")))
    a = lambda rows: rows.select("lang", *[F.col(c).alias(f"{c}_a") for c in rows.columns if c != "lang"])
    b = lambda rows: rows.select("lang", *[F.col(c).alias(f"{c}_b") for c in rows.columns if c != "lang"])
    sums, apart = ("lang", "source", "item"), "source_a <> source_b"
    names = [F.col("source_a").alias("source"), F.col("source_b").alias("item")]
    d = lambda x, y: divergence(F.col(x), F.col(y))

    histogram = entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"), F.first("p0").alias("p0"))
    beside = a(histogram).join(b(sized), "lang").where(apart)
    one = beside.select("lang", *names, (F.col("k_a") * (d("p_a", "p0_b") - d("p0_a", "p0_b"))).alias("value"))
    other = beside.select(
        "lang", F.col("source_b").alias("source"), F.col("source_a").alias("item"), (F.col("k_a") * (d("p0_b", "p_a") - d("p0_b", "p0_a"))).alias("value")
    )
    none = a(sized).join(b(sized), "lang").where(apart).where("terms_a > 0").select("lang", *names, (F.col("terms_a") * d("p0_a", "p0_b")).alias("value"))
    left = entries.select("lang", "term", *[F.col(c).alias(f"{c}_a") for c in ("source", "p", "p0")])
    right = entries.select("lang", "term", *[F.col(c).alias(f"{c}_b") for c in ("source", "p", "p0")])
    met = left.join(right, ["lang", "term"]).where(apart)
    both = met.select("lang", *names, (d("p_a", "p_b") - d("p_a", "p0_b") - d("p0_a", "p_b") + d("p0_a", "p0_b")).alias("value"))
    return one.unionByName(other).unionByName(none).unionByName(both).groupBy(*sums).agg(F.sum("value").alias("value"))


def pair_divergences(stripes: DataFrame, groups: DataFrame, most_sources: int = MOST_SOURCES) -> DataFrame:
    """``(lang, source, item, value)``: for every two sources of a language the divergence over all kept terms."""
    by_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("k"))
    size = by_lang.agg(F.max("k").alias("most"), F.sum("k").alias("all")).first()
    if (size["most"] or 0) <= most_sources and (size["all"] or 0) <= MOST_GROUPS:
        sizes: dict[str, dict[str, int]] = {}
        for r in groups.where("terms > 0").sort("lang", "source").collect():
            sizes.setdefault(r["lang"], {})[r["source"]] = r["below"]
        parts = stripes.select("lang", "entries").mapInArrow(_adds_pairs(sizes), "lang string, source string, item string, value bigint")
        sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    else:
        sums = _pairs_by_join(stripes, groups)
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    return pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))


def top_terms(stripes: DataFrame, groups: DataFrame, most: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, item, value, rank)``: terms a source has more often than its language, most telling first."""
    langs = groups.groupBy("lang").agg((F.sum(F.col("below") - F.col("terms")) + F.first("terms")).alias("all_below"))
    total = F.aggregate("entries", F.lit(0).cast("bigint"), lambda s, e: s + e["n"])
    entries = stripes.select("lang", "term", total.alias("total"), F.explode("entries").alias("e")).select("lang", "term", "total", "e.source", "e.n")
    known = entries.join(groups, ["lang", "source"]).join(langs, "lang")
    valued = known.select("lang", "source", "term", share(F.col("n"), F.col("below")).alias("p"), share(F.col("total"), F.col("all_below")).alias("q"))
    valued = valued.where("p > q").select("lang", "source", "term", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.decode("term", "UTF-8").alias("item"), "value", "rank")


def source_divergences(documents: DataFrame, least: int = LEAST_DOCUMENTS, most: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` compares sources, part ``term`` lists their terms.

    Null text, language and source count as empty; a document without a term still makes its group occur. Repeated rows
    are documents of their own. Ties are ordered by the item's UTF-8. A language without kept terms has pairs of value 0;
    without documents there are no rows. Only ``text``, ``lang`` and ``source`` are read, so other columns can't clash.
    Whole texts are counted; a task holds ``SPILL`` entries and one document's terms at most.
    """
    stripes = stored(merged_stripes(documents, least), "stripes")
    groups = stored(source_sizes(documents, stripes), "groups")
    pairs = pair_divergences(stripes, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(top_terms(stripes, groups, most).withColumn("part", F.lit("term"))).select(*RESULTS)


RESULTS = ("lang", "source", "part", "item", "value", "rank")
_P = "(1 + (1000000000::HUGEINT * ({} + 1)) // ({}))"
_F = "((({0}) - ({1})) * (({0}) - ({1})) // ({1}))"
ORACLE = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
places AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
terms AS (SELECT lang, term FROM places GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM places SEMI JOIN terms USING (lang, term) GROUP BY lang, source, term),
vocabulary AS (SELECT lang, count(*) AS v FROM terms GROUP BY lang),
groups AS (
    SELECT g.lang, g.source, coalesce(c.n, 0) AS n, coalesce(v.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM texts) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) c ON g.lang = c.lang AND g.source = c.source
    LEFT JOIN vocabulary v ON g.lang = v.lang),
cells AS (
    SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, {_P.format("coalesce(c.n, 0)", "g.n + g.v")} AS p
    FROM groups g JOIN terms t ON g.lang = t.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
whole AS (
    SELECT lang, term, {_P.format("n", "sum(n) OVER (PARTITION BY lang) + v")} AS q
    FROM (SELECT c.lang, c.term, sum(c.n)::HUGEINT AS n, any_value(v.v) AS v
          FROM counts c JOIN vocabulary v ON c.lang = v.lang GROUP BY c.lang, c.term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum({_F.format("x.p", "y.p")}) AS value
        FROM cells x JOIN cells y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
        GROUP BY x.lang, x.source, y.source) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
telling AS (
    SELECT c.lang, c.source, c.term AS item, {_F.format("c.p", "w.q")}::BIGINT AS value
    FROM cells c JOIN whole w ON c.lang = w.lang AND c.term = w.term WHERE c.n > 0 AND c.p > w.q),
both_parts AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM telling)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


@query("op11_divergence", ORACLE)
def op11_divergence(spark, folder):
    return source_divergences(table(spark, folder, "documents"))
