"""Quality rules applied to lines first, then to the document they leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, BLANKS, packed, query, table, unpacked

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
WORDS_PER_PHRASE = 15  # a line fails if a boilerplate phrase comes in every so many of its words
LEAST_LEFT = 50  # percent of a document's word characters that must survive the line rules
#: Fixed phrases of licences, notices and page furniture, matched in lower case.
BOILERPLATE = (
    "all rights reserved|copyright|licensed under|is licensed|under the mit license|terms of use|terms of service|"
    "privacy policy|cookie policy|accept cookies|javascript is disabled|enable javascript|subscribe to|sign up for|click here|"
    "log in to|share this|read more"
)
#: Marks that sentences hardly use and marks that separate links.
ODD_MARKS = r"[#*$%&<>!=_~^{}\[\]\\]"
LINK_MARKS = r"[|»›•·]"


def _count(text: Column, pattern: str) -> Column:
    """Number of characters that match a one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{BLANK}]+"), "")


def line_fails(line: Column) -> Column:
    """True for a line of odd marks, of links, of capitals or of boilerplate.

    Each is a share of the line, so a long line may mention a phrase.
    """
    words = F.size(_words(line))
    odd = (_count(line, ODD_MARKS) >= 3) & (_count(line, ODD_MARKS) * 2 >= words)
    links = (_count(line, LINK_MARKS) >= 2) & (_count(line, LINK_MARKS) * 4 >= words)
    capitals = (_count(line, r"\p{Lu}") >= 20) & (_count(line, r"\p{Lu}") * 10 >= _count(line, r"\p{L}") * 7)
    phrases = F.size(F.regexp_extract_all(F.lower(line), F.lit(BOILERPLATE), F.lit(0)))
    return odd | links | capitals | (F.lower(line).rlike(BOILERPLATE) & (phrases * WORDS_PER_PHRASE >= words))


def _repeated_words(rows: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: words inside a window of eight that is found twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts with a repeated window are sorted by it; the words covered are
    then the steps between the places of such windows, eight at most each.
    """
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    windows = F.transform(F.sequence(F.lit(1), F.size("hashes") - WINDOW + 1), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))
    keyed = hashed.withColumn("windows", F.when(F.size("hashes") >= WINDOW, windows))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = keyed.drop("hashes").withColumn("placed", F.when(twice, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    shared = lambda e, k: (F.try_element_at("placed", k + 2)["h"] == e["h"]) | ((k > 0) & (F.try_element_at("placed", F.greatest(k, F.lit(1)))["h"] == e["h"]))
    found = placed.drop("windows").withColumn("found", F.array_sort(F.transform(F.filter("placed", shared), lambda e: e["i"])))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "found", start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(WINDOW))).alias("n")), lambda a: a["n"]
    )
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("placed", "found")


def clean_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with measures, ``clean_text`` (the lines that pass) and the verdict ``kept``.

    A line fails that has no word, equals an earlier one or breaks a rule of ``line_fails``. A document is rejected if
    ``base_failed`` or if fewer than half of its word characters are left. A null text counts as empty: no words, base
    failed, empty clean text. Rows do not depend on each other, so there is no shuffle; other columns pass through,
    except that columns named like a result are replaced. Long texts are treated whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = packed(documents, "text").withColumn("words", _words(text)).withColumn("lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]")))
    rows = _repeated_words(rows).withColumn("unique_lines", F.array_distinct("lines"))
    rows = rows.withColumn("clean_text", F.array_join(F.filter("unique_lines", lambda x: ~line_fails(x)), "\n"))
    solid = lambda x: F.length(F.translate(x, BLANKS, ""))
    rows = rows.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        solid(text).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size("unique_lines")).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        "clean_text",
        solid(F.col("clean_text")).cast("bigint").alias("clean_chars"),
    )
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~F.col("base_failed") & (100 * F.col("clean_chars") >= LEAST_LEFT * F.col("word_chars"))
    return unpacked(rows.withColumn("base_failed", failed).withColumn("kept", kept), RESULTS, *RESULTS)


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "clean_chars", "base_failed", "kept")
_COUNT = "(length({0}) - length(regexp_replace({0}, '{1}', '', 'g')))"
_WORDS = f"regexp_extract_all({{0}}, '[^{BLANK}]+')"
ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, {_WORDS.format("text")} AS words FROM texts),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM words WHERE len(words) >= 8)),
shared AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM shared, range(8) AS steps(k) GROUP BY doc_id),
split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
lines AS (SELECT doc_id, line, count(*) AS n FROM split WHERE regexp_matches(line, '[^{BLANK}]') GROUP BY doc_id, line),
judged AS (
    SELECT doc_id, n, length(regexp_replace(line, '[{BLANK}]', '', 'g')) AS chars,
           ({_COUNT.format("line", ODD_MARKS)} >= 3 AND {_COUNT.format("line", ODD_MARKS)} * 2 >= len({_WORDS.format("line")}))
           OR ({_COUNT.format("line", LINK_MARKS)} >= 2 AND {_COUNT.format("line", LINK_MARKS)} * 4 >= len({_WORDS.format("line")}))
           OR ({_COUNT.format("line", chr(92) + "p{Lu}")} >= 20
               AND {_COUNT.format("line", chr(92) + "p{Lu}")} * 10 >= {_COUNT.format("line", chr(92) + "p{L}")} * 7)
           OR len(regexp_extract_all(lower(line), '{BOILERPLATE}')) * {WORDS_PER_PHRASE} >= len({_WORDS.format("line")}) AS fails
    FROM lines),
left_over AS (SELECT doc_id, sum(n - 1) AS dup, coalesce(sum(chars) FILTER (NOT fails), 0) AS chars FROM judged GROUP BY doc_id),
counts AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[{BLANK}]', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(l.chars, 0) AS chars
    FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN left_over l ON w.doc_id = l.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words AND 100 * chars >= {LEAST_LEFT} * word_chars) AS kept
FROM counts"""


@query("op4_line_rules", ORACLE)
def op4_line_rules(spark, folder):
    cleaned = clean_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
