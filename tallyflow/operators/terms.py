"""Terms of unspaced Han text, learned from the counts of the text itself."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import HAN_RUN
from ..workspace import new_folder

LONGEST = 4
LEAST_COUNT, LEAST_BRANCHES, COHESION = 5, 2, 10
# every overlapping stretch of a run between two spaces: the character before, up to LONGEST characters, the one behind
_STRETCH = "(?=(.{{3,{}}}))."


def _stretches(run: Column, longest: int) -> Column:
    padded = F.concat(F.lit(" "), run, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(_STRETCH.format(longest + 2)), F.lit(1))


def gram_statistics(runs: DataFrame, run: str = "word", count: str = "runs", longest: int = LONGEST) -> DataFrame:
    """``gram``, ``count``, ``before`` and ``behind`` of all stretches of up to ``longest`` characters of counted runs.

    The last two are the numbers of distinct neighbours, the end of the run being one. The sets behind them hold an
    alphabet at most, and are built in the tasks before anything is shuffled.
    """
    cut = runs.select(F.explode(_stretches(F.col(run), longest)).alias("s"), F.col(count).alias("n"))
    sized = cut.select("s", "n", F.explode(F.sequence(F.lit(1), F.length("s") - 2)).alias("k"))
    grams = sized.select(
        F.substring("s", F.lit(2), F.col("k")).alias("gram"), "n", F.left("s", F.lit(1)).alias("l"), F.substring("s", F.col("k") + 2, F.lit(1)).alias("r")
    )
    return grams.groupBy("gram").agg(
        F.sum("n").alias("count"), F.size(F.collect_set("l")).cast("bigint").alias("before"), F.size(F.collect_set("r")).cast("bigint").alias("behind")
    )


def learned_terms(
    statistics: DataFrame, least_count: int = LEAST_COUNT, least_branches: int = LEAST_BRANCHES, cohesion: int = COHESION
) -> DataFrame:
    """``gram`` and ``count`` of the stretches that are terms.

    A term is frequent, has several neighbours on both sides, and holds together: however it is cut in two, it occurs
    ``cohesion`` times as often as its parts would meet by chance. ``statistics`` is read several times; pass a table.
    """
    total = statistics.where(F.length("gram") == 1).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    offered = statistics.where(
        (F.length("gram") > 1) & (F.col("count") >= least_count) & (F.col("before") >= least_branches) & (F.col("behind") >= least_branches)
    )
    cuts = offered.select("gram", F.col("count").alias("n"), F.explode(F.sequence(F.lit(1), F.length("gram") - 1)).alias("k"))
    cuts = cuts.select("gram", "n", F.left("gram", F.col("k")).alias("a"), F.expr("substring(gram, k + 1)").alias("b"))
    a = statistics.select(F.col("gram").alias("a"), F.col("count").alias("n_a"))
    b = statistics.select(F.col("gram").alias("b"), F.col("count").alias("n_b"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    holds = wide("n") * F.lit(total).cast("decimal(19,0)") >= wide("n_a") * wide("n_b") * F.lit(cohesion)
    judged = cuts.join(a, "a").join(b, "b").groupBy("gram").agg(F.first("n").alias("count"), F.bool_and(holds).alias("holds"))
    return judged.where("holds").select("gram", "count")


def _best_cut():
    """The segmentation as a function sent by value: workers need no copy of this package."""

    def cut(runs: pd.Series, matches: pd.Series) -> pd.Series:
        found = []
        for run, spans in zip(runs, matches):
            starts: dict[int, list[tuple[int, int]]] = {}
            for span in () if spans is None else spans:
                starts.setdefault(span["at"], []).append((span["k"], span["count"]))
            pieces, score, step = [0] * (len(run) + 1), [0] * (len(run) + 1), [1] * (len(run) + 1)
            for at in range(len(run) - 1, -1, -1):
                ways = [(-1 - pieces[at + k], n + score[at + k], k) for k, n in [(1, 0), *starts.get(at, ())]]
                fewest, score[at], step[at] = max(ways)
                pieces[at] = -fewest
            at, terms = 0, []
            while at < len(run):
                terms.append(run[at : at + step[at]])
                at += step[at]
            found.append(terms)
        return pd.Series(found, dtype=object)

    return F.pandas_udf(cut, "array<string>")


def segmented(runs: DataFrame, terms: DataFrame, run: str = "word", longest: int = LONGEST) -> DataFrame:
    """``runs`` (distinct ones) with ``terms``, the best way to cut each into learned terms and single characters.

    Best is the fewest pieces, then the largest sum of counts, then the longest first piece. Matches come from a join,
    so the terms need not fit into a task; it carries hashes in place of runs.
    """
    keyed = runs.withColumn("run_key", F.md5(F.col(run).cast("binary")))
    at = keyed.select("run_key", F.posexplode(_stretches(F.col(run), longest)).alias("at", "s"))
    sized = at.where(F.length("s") > 3).select("run_key", "at", "s", F.explode(F.sequence(F.lit(2), F.length("s") - 2)).alias("k"))
    grams = sized.select("run_key", "at", "k", F.substring("s", F.lit(2), F.col("k")).alias("gram"))
    matches = grams.join(terms, "gram").groupBy("run_key").agg(F.collect_list(F.struct("at", "k", "count")).alias("matches"))
    joined = keyed.join(matches, "run_key", "left")
    return joined.withColumn("terms", _best_cut()(F.col(run), F.col("matches"))).drop("run_key", "matches")


def han_terms(runs: DataFrame, run: str = "word", longest: int = LONGEST, **limits) -> DataFrame:
    """Distinct Han runs with a count ``runs``, cut by the terms that these runs teach."""
    spark = runs.sparkSession
    path = new_folder(spark, "grams")
    gram_statistics(runs, run, longest=longest).write.parquet(path)
    return segmented(runs, learned_terms(spark.read.parquet(path), **limits), run, longest)


def is_han(run: Column) -> Column:
    return run.rlike(HAN_RUN)
