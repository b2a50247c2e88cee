"""Main text of web pages by tag-path ratios.

Every text node of a page has a path of tags from the root. For each path the text length and the punctuation per node
are taken; both ratios are given to the nodes in page order, smoothed with a small Gaussian, fused to one score and held
against a threshold from the page itself. Paths above it are content. The element that holds most of their text is the
article; its other blocks belong to it unless their tag or name says they are furniture.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table

#: Attributes up to the end of a tag. A quote opens a value right after an equals sign only; elsewhere it is a plain character.
_VALUES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?)*+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_VALUES})(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>]++)))?+""")
_NAMES = frozenset("class id role".split())
_RAW = frozenset("script style noscript template textarea title iframe svg select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that run within a line of text; they neither end a block nor lengthen a path.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_FURNITURE = frozenset("nav footer aside button menu dialog select option head".split())
#: Tags that are furniture unless they hold most of the page, as one form around everything does.
_WRAPPERS = frozenset("form fieldset".split())
#: Elements that hold the page or its article; no name makes them furniture.
_BODIES = frozenset("html body main article".split())
#: A class, id or role is furniture if it is one of these words, alone or joined to words that only say which or where.
#: A name with any other part says something else: "no-sidebar", "with-sidebar" and "has-comments" describe the page.
_WORD = (
    r"(?:ads?|advert\w*|adverti[sz]ement|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|side-?bar|footer|site-?header|"
    r"page-?header|masthead|cookies?|consent|gdpr|notices?|notification|alert|pop-?up|modal|overlay|comments?|disqus|repl(?:y|ies)|"
    r"share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|pagination|pager|toolbar|widget)"
)
_BESIDE = (
    r"(?:site|page|post|entry|article|blog|main|global|primary|secondary|top|bottom|left|right|upper|lower|inner|outer|sticky|fixed|"
    r"box|bar|block|lists?|links?|items?|buttons?|icons?|containers?|content|wrap|wrapper|section|area|panel|form|policy|text|body|"
    r"title|header|inline|mobile|desktop|js|[0-9]+)"
)
_NOISE = re.compile(rf"(?:^|\s)(?:{_BESIDE}[_-]+)*{_WORD}(?:[_-]+(?:{_WORD}|{_BESIDE}))*(?:$|\s)", re.I)
#: Furniture that can hold more text than the article.
_TALK = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|repl(?:y|ies))(?:$|[\s_-])", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: Elements that an implied end does not reach beyond.
_HOLDERS = frozenset("ul ol dl table article section div main body".split())
#: An element that closes an open one of the same family when it starts.
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
_MARKS = re.compile(r"[.,;:!?…。，！？、；：¡¿]")
KERNEL = np.exp(-np.arange(-2, 3) ** 2 / 2.0) / np.exp(-np.arange(-2, 3) ** 2 / 2.0).sum()
THRESHOLD = 0.5  # of the scores' standard deviation
MOST = 0.8  # share of the selected text that the article's element must hold


_NAMED, _TAGGED = 1, 2


class Block(NamedTuple):
    text: str
    element: int  # the innermost open element
    noise: bool
    named: bool  # noise by name only, or by a form around it
    linked: int  # characters inside links


class Page:
    """Text blocks in page order, with white space settled and references decoded, and the elements they lie in.

    Elements are numbered as they open, after their parents; 0 stands for the page. Each has its parent's number and that of
    its path of block-level tags, so memory and time grow with the page however deep its tags are.
    """

    def __init__(self, page: str) -> None:
        self.blocks: list[Block] = []
        self.tags, self.parents, self.paths, self.kinds = [""], [0], [0], [0]
        self.doubtful: set[int] = set()  # elements that are furniture unless they hold most of the text
        self.talk: set[int] = set()  # elements that are furniture even then
        self._numbers: dict[tuple[int, str], int] = {}
        self._stack, self._open = [0], Counter()
        self._parts: list[str] = []
        self._links = self._linked = 0
        self._read(page)
        if self.doubtful:
            self._settle()

    def held(self, sizes: Iterable[tuple[int, int]]) -> list[int]:
        """Per element the sum of the sizes given to it and to the elements within."""
        sums = [0] * len(self.tags)
        for element, size in sizes:
            sums[element] += size
        for element in range(len(sums) - 1, 0, -1):
            sums[self.parents[element]] += sums[element]
        return sums

    def within(self, elements: set[int]) -> list[bool]:
        """Per element whether it is one of ``elements`` or lies in one."""
        found = [0 in elements]
        for element in range(1, len(self.tags)):
            found.append(found[self.parents[element]] or element in elements)
        return found

    def _read(self, page: str) -> None:
        at = 0
        while at < len(page):
            match = _TOKEN.search(page, at)
            if not match:
                self._say(page[at:])
                break
            self._say(page[at : match.start()])
            at = match.end()
            tag = (match[2] or "").lower()
            if not tag or (not match[4] and at >= len(page)):
                continue  # comments, declarations, and a tag that the end of the page cuts off
            if tag in _RAW and not match[1]:
                if not match[3].rstrip().endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                if tag not in _INLINE:
                    self._flush()
            elif tag == "br":
                self._parts.append(" ")
            elif tag in _INLINE:
                if tag == "a":
                    self._links = max(0, self._links + (-1 if match[1] else 1))
            elif match[1]:
                self._flush()
                if tag != "p":
                    self._links = 0
                while self._open[tag]:
                    if self._close() == tag:
                        break
            else:
                self._flush()
                if tag not in _VOID:
                    self._start(tag, match[3])
        self._flush()

    def _say(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            self._parts.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            element = self._stack[-1]
            kind = self.kinds[element]
            self.blocks.append(Block(text, element, kind > 0, kind == _NAMED, self._linked))
        self._parts.clear()
        self._linked = 0

    def _close(self) -> str:
        tag = self.tags[self._stack.pop()]
        self._open[tag] -= 1
        return tag

    def _start(self, tag: str, attributes: str) -> None:
        closes = _SAME.get(tag, ()) + (("p",) if tag in _ENDS_P else ())
        for i in range(len(self._stack) - 1, 0, -1):
            if not any(self._open[t] for t in closes):
                break
            if self.tags[self._stack[i]] in closes:
                while len(self._stack) > i:
                    self._close()
            if self.tags[self._stack[-1]] in _HOLDERS:
                break
        names = " ".join(b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes) if a.lower() in _NAMES)
        banner = tag == "header" and not self._open["article"] and not self._open["main"]
        number, parent = len(self.tags), self._stack[-1]
        named = tag not in _BODIES and bool(names and _NOISE.search(names))
        if tag in _FURNITURE or banner:
            kind = _TAGGED
        else:
            kind = _NAMED if named or tag in _WRAPPERS else 0
            if kind:
                (self.talk if named and _TALK.search(names) else self.doubtful).add(number)
        self.tags.append(tag)
        self.parents.append(parent)
        self.paths.append(self._numbers.setdefault((self.paths[parent], tag), len(self._numbers) + 1))
        self.kinds.append(max(kind, self.kinds[parent]))
        self._stack.append(number)
        self._open[tag] += 1

    def _settle(self) -> None:
        """Clear the blocks whose only furniture are elements that hold most of the text outside links."""
        holds = self.held((b.element, max(0, len(b.text) - b.linked)) for b in self.blocks)
        total = holds[0]
        small = self.within(self.talk | {e for e in self.doubtful if holds[e] < MOST * total or not total})
        self.blocks = [b._replace(noise=False, named=False) if b.named and not small[b.element] else b for b in self.blocks]


def _scores(blocks: list[Block], paths: list[int]) -> dict[int, float]:
    """Fused and smoothed ratio of each path."""
    length, marks, count = Counter(), Counter(), Counter()
    for b in blocks:
        path = paths[b.element]
        length[path] += 0 if b.noise else max(0, len(b.text) - 2 * b.linked)
        marks[path] += len(_MARKS.findall(b.text))
        count[path] += 1
    own = [paths[b.element] for b in blocks]
    text = np.array([length[p] / count[p] for p in own])
    mark = np.array([marks[p] / count[p] for p in own])
    fused = np.sqrt(np.convolve(text, KERNEL, "same")[: len(blocks)] if len(blocks) >= len(KERNEL) else text) * np.log2(2 + mark)
    fused = np.where([b.noise for b in blocks], 0.0, fused)
    by_path = defaultdict(list)
    for p, x in zip(own, fused, strict=True):
        by_path[p].append(float(x))
    return {p: math.fsum(x) / len(x) for p, x in by_path.items()}


def main_text(page: str | None) -> str:
    """Main text of one page, its blocks in page order joined by line feeds; empty if there is none.

    Where all blocks are furniture, those that are by name only count as text, and where there are none of these, all.
    """
    read = Page(page or "")
    blocks, tags, paths = read.blocks, read.tags, read.paths
    if all(b.noise for b in blocks):
        named = any(b.named for b in blocks)
        blocks = [b._replace(noise=False) if b.named or not named else b for b in blocks]
    clean = [b for b in blocks if not b.noise]
    if not clean:
        return ""
    score = _scores(blocks, paths)
    limit = THRESHOLD * float(np.std([score[paths[b.element]] for b in blocks]))
    chosen = [b for b in clean if score[paths[b.element]] >= limit and score[paths[b.element]] > 0] or clean
    holds = read.held((b.element, len(b.text)) for b in chosen)
    # elements that hold most of the text lie within each other, so the last one is the innermost
    around = [e for e in range(1, len(tags)) if holds[e] >= MOST * holds[0]]
    bodies = [e for e in around if tags[e] in ("article", "main")]
    article = (bodies or around or [0])[-1]
    # a paragraph that alone holds most text stands for its parent
    if tags[article] in {"p", "li", "td", "pre", "blockquote", *_HEADINGS}:
        article = read.parents[article] or article
    inside = read.within({article})
    chosen_paths = {paths[b.element] for b in chosen}
    whole = tags[article] in ("article", "main")
    return "\n".join(
        b.text for b in clean if inside[b.element] and (whole or paths[b.element] in chosen_paths or tags[b.element] in _HEADINGS)
    )


def extract_main_text(pages: DataFrame, source: str = "html", target: str = "text") -> DataFrame:
    """``pages`` with ``target`` in place of ``source``, its other columns unchanged.

    A null or empty page, and one without text of its own, gives an empty text. Pages are read whole and independently
    of each other: nothing is shuffled, repeated rows give repeated results. A column named like ``target`` is replaced.
    """
    kept = [c for c in pages.columns if c not in (source, target)]
    schema = pages.select(*kept, F.lit("").alias(target)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], schema.names)

    return pages.select(*kept, source).mapInArrow(run, schema)


@query("op7_main_text")
def op7_main_text(spark, folder):
    found = extract_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
