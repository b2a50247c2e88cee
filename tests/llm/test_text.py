"""Operators on single texts: language, lines, toxicity, pages and pieces."""

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

from tallyflow.llm import language, line_rules, pieces, tag_paths, toxicity
from tests.llm.cases import CLASHING, HARD, empty, hard, prose


# language

def spelled(seed, letters, words=60):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(letters) for _ in range(pick.randrange(2, 9))) for _ in range(words))


def test_language_learns_and_reads_whole_texts(spark):
    kinds = {"aa": "aeiourstln", "bb": "zxqwkjyvpm", "cc": "éèàçùôîâêë"}
    rows = [(i, spelled(i, kinds[k]), k, "s") for i, k in enumerate([*kinds] * 60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    net = language.train(frame.where("doc_id < 120"))
    found = {r["doc_id"]: r for r in language.identify(frame.drop("lang"), net).collect()}
    right = sum(found[i]["lang_pred"] == k for i, _, k, _ in rows if i >= 120)
    assert right >= 0.95 * 60 and all(0 <= r["lang_score"] <= 1 for r in found.values())
    late = spelled(1, kinds["aa"], 20) + spelled(2, kinds["bb"], 400)
    assert language.predict(net, [late])[0][0] == "bb"


def test_windows_cover_the_text():
    text = "ab é" * 400
    rows = language.windows_of(text)
    assert bytes(rows.ravel()[rows.ravel() < 256].astype(np.uint8)) == text.encode()
    assert language.windows_of("").shape == (1, language.WINDOW)


def test_language_hard_cases(spark):
    frame = hard(spark, clashing=True)
    found = language.identify(frame, language.train(hard(spark))).collect()
    assert len(found) == len(HARD) and all(r["words"] == "own" and r["lang_pred"] != "own" for r in found)
    none = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert none == {4, 5, 6} and all(r["lang_score"] == 0 for r in found if r["doc_id"] in none)
    assert language.train(empty(spark)) is None
    assert {r["lang_pred"] for r in language.identify(hard(spark), None).collect()} == {"und"}
    assert language.identify(empty(spark), None).count() == 0


# lines

def slow_measures(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in line_rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_measures_and_verdicts(spark):
    menu = " | ".join("home news sport".split() * 8)
    rows = [(i, t) for i, t, *_ in HARD if i != 9] + [
        (50, prose(50) + "\n" + menu),
        (51, "\n".join(" | ".join(prose(i, 8).split()) for i in range(9)) + "\nOne line of words only."),
        (52, " ".join(["same words again and again in this line"] * 9)),
        (53, "\n".join(w.upper() + "!! " + prose(i, 6).upper() for i, w in enumerate(["shout"] * 20))),
        (54, prose(54) + "\nAll rights reserved.\n" + prose(55)),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in line_rules.clean_lines(frame).collect()}
    for i, text in rows:
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == slow_measures(text), i
    assert [found[i]["kept"] for i in (1, 50, 51, 52, 53, 54)] == [True, True, False, False, False, True]
    assert found[52]["base_failed"] and not found[51]["base_failed"]
    assert "|" not in found[50]["clean_text"] and "reserved" not in found[54]["clean_text"]


def test_line_rules_hard_cases(spark):
    found = line_rules.clean_lines(hard(spark, clashing=True)).collect()
    assert len(found) == len(HARD) and all(r["words"] == r["lines"] == "own" for r in found)
    assert {r["doc_id"] for r in found if r["n_words"] == 0} == {4, 5, 6}
    assert line_rules.clean_lines(empty(spark)).count() == 0


# toxicity

def slow_segments(values):
    """Maximal segments by their recursive definition: the best one first, then left and right of it."""
    found = []

    def split(low, high):
        best = max(((sum(values[i : j + 1]), i - j, -i, i, j) for i in range(low, high) for j in range(i, high)), default=None)
        if best is None or best[0] <= 1e-9:
            return
        found.append((best[3], best[4], best[0]))
        split(low, best[3])
        split(best[4] + 1, high)

    split(0, len(values))
    return sorted(found)


def test_segments_against_definition():
    pick = random.Random(8)
    for _ in range(200):
        n = pick.randrange(1, 26)
        places = sorted(pick.sample(range(n), pick.randrange(0, n + 1)))
        scores = [pick.uniform(0.1, 3) for _ in places]
        values = [-0.7] * n
        for p, s in zip(places, scores):
            values[p] = s
        got = toxicity.segments(places, scores, -0.7)
        want = slow_segments(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_toxicity_held_out(spark):
    pick = random.Random(2)
    bad = ["blarg", "snorf", "grubnik"]
    rows, labels = [], []
    for i in range(400):
        words, toxic = prose(i, 80).split(), i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int").where("doc_id < 300"))
    found = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, model).collect()}
    assert [i for i in range(300, 400) if found[i]["tox_score"] >= 0.5] == [i for i in range(300, 400) if i % 8 == 0]
    first = found[0]["tox_passages"][0]
    words = toxicity.tokens_of(rows[0][1])
    assert words[first["first"]] in bad and words[first["last"]] in bad


def test_toxicity_learns_from_each_text_with_its_own_label(spark):
    shared = "all of our terms apply here"
    rows = [(i, f"{prose(i, 60)} {shared} {prose(900 + i, 60)}", i % 2) for i in range(60)]  # a passage in common, no copies
    rows += [(100, prose(1, 90), 0), (101, prose(1, 90), 1), (101, prose(1, 90), 1), (102, prose(1, 90) + " more", 0)]  # copies
    rows += [(200 + i, text, i % 2) for i, text in enumerate(["one run only", "one run only of five", "", " "])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    found = [(r["doc_id"], r["text"], r["toxic"]) for r in toxicity._learned_once(frame).collect()]
    assert sorted(found) == sorted(r for r in set(rows) if r[0] not in (100, 102, 202))


def test_toxicity_hard_cases(spark):
    labels = spark.createDataFrame([(13, 1), (1, 0), (1, 0), (None, 1), (9, None)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(hard(spark, clashing=True), toxicity.train(hard(spark), labels)).collect()
    assert len(found) == len(HARD) and all(0 <= r["tox_score"] <= 1 and r["words"] == "own" for r in found)
    none = toxicity.train(empty(spark), labels.where("false"))
    assert {r["tox_score"] < 0.5 for r in toxicity.score_toxicity(hard(spark), none).collect()} == {True}
    assert toxicity.score_toxicity(empty(spark), none).count() == 0


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home, sweet</a></li></ul></nav><div class="ad">Buy this, now.</div>
<article><h1>A &amp; B</h1><p><b>First   paragraph,
with words; caf&eacute;.<br><p>Second one, longer than the first. It ends.</p><!-- x --><form><p>Name, please.</p></form></article>
<aside><p>Related, and more related. Yes.</p></aside><section class="comments"><p>Nice, very nice. I agree.</p></section>
<div id="cookie-notice"><p>We use cookies, ok.</p></div><footer>&copy; someone, somewhere.</footer></body></html>"""


def test_main_text():
    assert tag_paths.main_text(PAGE) == "A & B\nFirst paragraph, with words; café.\nSecond one, longer than the first. It ends."
    plain = PAGE.replace("<article>", '<div><div class="post">').replace("</article>", "</div></div>")
    assert "Second one" in tag_paths.main_text(plain) and "cookies" not in tag_paths.main_text(plain)
    cut = PAGE[: PAGE.index("longer")]
    assert tag_paths.main_text(cut).endswith("Second one,")
    assert tag_paths.main_text(None) == tag_paths.main_text("") == tag_paths.main_text("<script>a, b.") == ""
    assert tag_paths.main_text("loose words, no tags. &lt;b&gt;") == "loose words, no tags. <b>"
    assert tag_paths.main_text("<p" * 3000 + "<div>" * 3000 + "deep, text.").endswith("deep, text.")


ARTICLE = "A & B\nFirst paragraph, with words; café.\nSecond one, longer than the first. It ends."


def test_main_text_of_pages_with_telling_names():
    for shape in ("<body class='page no-sidebar'>", "<body class='with-sidebar'>", "<body id=search>", "<body class='nav-open modal'>"):
        assert tag_paths.main_text(PAGE.replace("<body>", shape)) == ARTICLE
    assert tag_paths.main_text(PAGE.replace("<article>", "<main class='has-comments'><article class='post has-share comments'>")) == ARTICLE
    assert tag_paths.main_text(PAGE.replace("<html>", "<html class='no-js cookies'>")) == ARTICLE
    text = "<h1>A</h1>" + "".join(f"<p>{prose(i, 30)}</p>" for i in range(6))
    plain = "A\n" + "\n".join(prose(i, 30) for i in range(6))
    rest = "<nav><a href='/'>Home</a></nav><footer>Someone, somewhere.</footer>"
    for wrap in ("<form action='/x'>{}{}</form>", "<div class='widget'>{}{}</div>", "<form><div class='content-with-sidebar'>{}</div></form>{}"):
        assert tag_paths.main_text("<body>" + wrap.format(text, rest) + "</body>") == plain
    talk = "<div class='post-comments'>" + "".join(f"<p>{prose(50 + i, 40)}</p>" for i in range(30)) + "</div>"
    assert tag_paths.main_text(f"<body><div>{text}</div>{talk}{rest}") == plain
    for name in ("cookie-notice", "site-footer", "sidebar sidebar-left", "x related-posts-list ad"):
        assert tag_paths.main_text(f"<body><div>{text}</div><div class='{name}'><p>Some words, here.</p></div>") == plain


def test_main_text_reads_attributes_as_browsers_do():
    three = "<p>First paragraph, with words; here.</p><p>Second one, longer. It ends.</p><p>Third, too.</p>"
    plain = "First paragraph, with words; here.\nSecond one, longer. It ends.\nThird, too."
    for tag in ("<div class=it's>", '<div class="a"">', "<div title='x > y'>", '<div data-x=a="b>', '<div ">', "<div id = x' y>", '<div title="my class=nav">'):
        assert tag_paths.main_text(f"<body><nav>Home</nav>{tag}{three}</div><footer>End.</footer></body>") == plain
    for tag in ("<div class=nav>", "<div hidden class = 'nav'>", '<div title="x > y" ID="nav">'):
        assert tag_paths.main_text(f"<body><div>{three}</div>{tag}<p>Home, there.</p></div></body>") == plain
    assert tag_paths.main_text("<div " + "x" * 200_000 + ">" + three) == plain


def test_executors_need_no_copy_of_the_package(tmp_path):
    """A driver that alone can import the package, with workers started in another folder."""
    script = tmp_path / "driver.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(Path(tag_paths.__file__).parents[2])!r})
import numpy as np
from pyspark.sql import SparkSession
from tallyflow.llm import language, pieces, toxicity

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
docs = spark.createDataFrame([(1, "bad words")], "doc_id long, text string")
model = toxicity.Model({{"bad": 2.0}}, 1.0, 1.0, 0.0, 1.0)
net = language.fit(np.stack([language.windows_of(t)[0] for t in ("words", "Worte")]), ["en", "de"])
assert toxicity.score_toxicity(docs, model).count() == language.identify(docs, net).count() == 1
assert [r.text for r in pieces.decode(pieces.encode(docs)).collect()] == ["bad words"]
assert [r.lang_pred in ("en", "de") for r in language.identify(docs, net).collect()] == [True]
assert toxicity.score_toxicity(docs, model).collect()
""")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]


def test_main_text_of_deep_pages():
    """Time and memory grow with the page, not with its depth times its blocks."""
    deep = tag_paths.Page("<div>x, y." * 50_000 + "</x></p>" * 50_000)
    assert len(deep.blocks) == 50_000 and len(deep.tags) == 50_001
    assert deep.within({49_999}) == [False] * 49_999 + [True] * 2
    assert deep.held((b.element, 1) for b in deep.blocks)[:3] == [50_000, 50_000, 49_999]
    assert tag_paths.main_text("<div>x, y." * 50_000).endswith("y.\nx, y.")
    assert tag_paths.main_text("<b>" * 50_000 + "<a>" * 50_000 + "deep, text.") == "deep, text."


def test_main_text_where_all_is_furniture():
    assert tag_paths.main_text("<div class='comments'><p>Words, only here.</p></div><nav><p>Home, there.</p></nav>") == "Words, only here."
    assert tag_paths.main_text("<aside><p>Words, only here.</p></aside>") == "Words, only here."


def test_main_text_frame(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'own' AS text", "'own' AS path")
    found = tag_paths.extract_main_text(frame).collect()
    assert [r["path"] for r in found] == ["own"] * 4 and found[0]["text"] == found[1]["text"] != "own" and found[2]["text"] == ""
    assert tag_paths.extract_main_text(frame.where("false")).count() == 0


# pieces

@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


def test_pieces_equal_the_library(model):
    library, encoder, pick = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Encoder(model), random.Random(1)
    letters = "ab theing\n\t  日本語é́ﬁ🙂0123.,'\"()<>ＡЖд"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(2000)]
    texts += ["".join(pick.choice(list(model.scores)) for _ in range(8)).replace("▁", " ") for _ in range(1000)]
    decoder = pieces.Decoder(model)
    for text in texts:
        ids = encoder.encode(text)
        assert ids == library.encode(text)
        assert decoder.decode(ids) == text
    for _ in range(500):  # ids that no text gives: bytes out of order, control pieces
        ids = [pick.choice([pick.randrange(3, 259), pick.randrange(259, 32000), 1]) for _ in range(12)]
        assert decoder.decode(ids) == library.decode(ids)


def test_best_scores_against_all_segmentations():
    scores = {"a": -1.0, "b": -1.5, "c": -2.0, "ab": -1.9, "bc": -2.2, "abc": -4.0, "ca": -1.2}
    small = pieces.Pieces(pieces.UNIGRAM, {p: (i, s) for i, (p, s) in enumerate(scores.items())}, [], 99, list(scores), False)

    def best(text):
        if not text:
            return 0.0
        return max((scores[text[:n]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in scores), default=float("-inf"))

    pick, encoder = random.Random(5), pieces.Encoder(small)
    for _ in range(200):
        text = "".join(pick.choice("abc") for _ in range(pick.randrange(1, 10)))
        ids = encoder.encode(text)
        assert pieces.decode_ids(ids, small) == text
        assert sum(scores[small.texts[i]] for i in ids) == pytest.approx(best(text))
    assert encoder.encode("axa") == [0, 99, 0]


def test_pieces_hard_cases(spark, model):
    encoded = pieces.encode(hard(spark, clashing=True), pieces=model)
    found = pieces.decode(encoded, pieces=model).collect()
    assert sorted(r["text"] for r in found) == sorted((t or "").replace("▁", " ") for _, t, *_ in HARD)
    assert all(r[c] == "own" for r in found for c in CLASHING if c != "ids")
    assert pieces.encode(empty(spark), pieces=model).count() == 0
    assert pieces.decode_ids([None, -1, 10**6, 0], model) == "" and pieces.decode_ids(None, model) == ""
