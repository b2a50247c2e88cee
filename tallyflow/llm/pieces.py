"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton holds all pieces. One pass over a stretch of text follows its output links, which at each place name every
piece that ends there, and relaxes the best way to reach that place. In a unigram model the best way has the highest
sum of scores. A BPE model's scores are merge ranks, whose sums mean nothing; there the way is the one whose last two
pieces stay apart when merged alone, which is unique and makes the same pieces as the merges would. Stretches end
before a word mark, which no piece has inside; their pieces are remembered, as words repeat.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIGRAM, BPE = "unigram", "bpe"
REMEMBERED = 500_000  # stretches a worker remembers before it starts anew
LONGEST_REMEMBERED = 48
ROWS = 256  # rows of a batch that are turned into Python values at a time
UNKNOWN_PENALTY = 10.0


class Pieces(NamedTuple):
    """What the driver reads from a model file: small whatever the input, and sent to the executors."""

    kind: str
    scores: dict[str, tuple[int, float]]  # ordinary pieces: id, score
    byte_ids: list[int]  # of the 256 byte pieces; empty without byte fallback
    unknown: int
    texts: list[str | int | None]  # by id: the piece, a byte's value, or nothing
    prefix: bool


def read_model(path: str = MODEL, kind: str = BPE) -> Pieces:
    """Pieces and scores of a model without text normalisation, as read by the library; the segmenting is done here."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, texts, at = {}, [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            at[int(piece[3:-1], 16)] = i
            texts.append(int(piece[3:-1], 16))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(None)
        else:
            scores[piece] = (i, model.get_score(i))
            texts.append(piece)
    bytes_ = [at[b] for b in range(256)] if len(at) == 256 else []
    return Pieces(kind, scores, bytes_, model.unk_id(), texts, model.decode(model.encode(" x")) == " x" and model.encode("x", out_type=str)[0].startswith(MARK))


class Encoder:
    """Segments texts; made once per worker task."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for piece, (number, score) in pieces.scores.items():
            self.automaton.add_word(piece, (len(piece), number, score, piece))
        self.automaton.make_automaton()
        split = all(MARK not in p.lstrip(MARK) for p in pieces.scores)
        self.stretches: Callable[[str], list[str]] = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if split else lambda t: [t]
        self.known: dict[str, list[int]] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.chars = {c for p in pieces.scores for c in p}
        self.closed = all(c in pieces.scores for c in self.chars)  # then no piece holds a character that is none
        self.lowest = min((s for _, s in pieces.scores.values()), default=0.0) - UNKNOWN_PENALTY

    def _merged(self, text: str) -> list[str]:
        """BPE by its definition, for the few characters of two pieces: join the best adjacent pair until none is left."""
        parts, get = list(text), self.pieces.scores.get
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[1] > best):
                    best, at = found[1], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stay_apart(self, left: str, right: str) -> bool:
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) > 4 * REMEMBERED:
                self.apart.clear()
            found = self.apart[left, right] = self._merged(left + right) == ([left, right] if left else [right])
        return found

    def _unknown(self, char: str) -> list[int]:
        return [self.pieces.byte_ids[b] for b in char.encode()] if self.pieces.byte_ids else [self.pieces.unknown]

    def _ends(self, text: str) -> list[list[tuple[int, int, float, str]]]:
        """For every place, the pieces that end there, longest first; a character that is no piece stands for itself."""
        ends: list[list[tuple[int, int, float, str]]] = [[] for _ in text]
        for last, value in self.automaton.iter(text):
            ends[last].append(value)
        scores = self.pieces.scores
        for i, char in enumerate(text):
            if char not in scores:
                ends[i].append((1, -1, self.lowest, char))
            ends[i].sort(key=lambda v: -v[0])
        return ends

    def _segment_known(self, text: str) -> list[int]:
        """BPE pieces of a text of known characters, without gathering the links first."""
        last: list[str | None] = [None] * (len(text) + 1)
        last[0] = ""
        number_at, apart = [0] * (len(text) + 1), self.apart
        for before_end, (size, number, _, piece) in self.automaton.iter(text):
            end = before_end + 1
            if last[end] is None and (left := last[end - size]) is not None:
                fits = apart.get((left, piece))
                if self._stay_apart(left, piece) if fits is None else fits:
                    last[end], number_at[end] = piece, number
        ids, end = [], len(text)
        while end:
            ids.append(number_at[end])
            end -= len(last[end])
        ids.reverse()
        return ids

    def _segment(self, text: str) -> list[int]:
        if self.pieces.kind == BPE and self.closed:
            if self.chars.issuperset(text):
                return self._segment_known(text)
            runs = groupby(text, self.chars.__contains__)
            return [i for known, run in runs for i in (self._segment_known("".join(run)) if known else (j for c in run for j in self._unknown(c)))]
        best_from = [0] * (len(text) + 1)
        best_id = [0] * (len(text) + 1)
        if self.pieces.kind == BPE:
            last: list[str | None] = [""] + [None] * len(text)
            for end, found in enumerate(self._ends(text), 1):
                for size, number, _, piece in found:
                    left = last[end - size]
                    if left is not None and self._stay_apart(left, piece):
                        last[end], best_from[end], best_id[end] = piece, end - size, number
                        break
        else:
            best = [0.0] + [float("-inf")] * len(text)
            for end, found in enumerate(self._ends(text), 1):
                for size, number, score, _ in found:
                    total = best[end - size] + score
                    if total > best[end]:
                        best[end], best_from[end], best_id[end] = total, end - size, number
        ids: list[int] = []
        end = len(text)
        while end:
            ids.extend(reversed(self._unknown(text[end - 1])) if best_id[end] < 0 else (best_id[end],))
            end = best_from[end]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, ids = self.known, []
        marked = (MARK if self.pieces.prefix else "") + text.replace(" ", MARK)
        for stretch in self.stretches(marked):
            found = known.get(stretch)
            if found is None:
                found = self._segment(stretch)
                if len(stretch) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[stretch] = found
            ids.extend(found)
        return ids


class Decoder:
    """Text of ids: byte pieces as UTF-8, bad bytes as replacement characters, the added first space dropped.

    A byte piece above the ASCII range stands as the lone surrogate that escapes it until the pieces are joined; one
    pass over the bytes then settles all of them. Unknown ids and ids of control pieces have no text and end a run of bytes.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.prefix = pieces.prefix
        self.byte_ids = frozenset(pieces.byte_ids)
        self.text: dict[int | None, str] = {}
        for i, piece in enumerate(pieces.texts):
            if isinstance(piece, int):
                self.text[i] = chr(piece if piece < 128 else 0xDC00 + piece)
            elif piece is not None:
                self.text[i] = piece.replace(MARK, " ")

    def _joined(self, ids: Iterable[int | None]) -> str:
        text = "".join(map(self.text.get, ids))
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape")
            text = re.sub("[\udc80-\udcff]", "\ufffd", text)  # one for each byte that is part of no character
        return text

    def decode(self, ids: list[int | None] | None) -> str:
        try:
            text = self._joined(ids or ())
        except TypeError:  # an id without a piece
            text = "".join(self._joined(run) for known, run in groupby(ids, self.text.__contains__) if known)
        if self.prefix and text.startswith(" ") and next(i for i in ids if i in self.text) not in self.byte_ids:
            return text[1:]
        return text


def decode_ids(ids: list[int | None] | None, pieces: Pieces) -> str:
    return Decoder(pieces).decode(ids)


def _values(column: pa.Array) -> Iterator:
    """Python values of a column, one at a time; lists of numbers are cut from one array of all of them."""
    if not pa.types.is_list(column.type) or column.values.null_count:
        yield from (x.as_py() for x in column)
        return
    ends, numbers = column.offsets.to_numpy(), column.values.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield numbers[a:b].tolist()


def _mapped(rows: DataFrame, source: str, target: str, kind: str, make: Callable[[Pieces], Callable], pieces: Pieces) -> DataFrame:
    others = [c for c in rows.columns if c not in (source, target)]
    schema = rows.select(*others, F.lit(None).cast(kind).alias(target)).schema
    arrow = pa.list_(pa.int32()) if kind != "string" else pa.string()
    shared = rows.sparkSession.sparkContext.broadcast(tuple(pieces))  # plain values: executors have no copy of the class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make(Pieces(*shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):  # ids are lists of Python numbers for as few rows as possible
                part = batch.slice(start, ROWS)
                found = pa.array([apply(x) for x in _values(part.column(part.num_columns - 1))], arrow)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], schema.names)

    return rows.select(*others, source).mapInArrow(run, schema)


def encode(documents: DataFrame, text: str = "text", ids: str = "ids", pieces: Pieces | None = None) -> DataFrame:
    """``documents`` with the ids of ``text`` in its place; other columns stay, one named like ``ids`` is replaced.

    A null or empty text has no ids. Characters without a piece become byte pieces. Texts are encoded whole.
    """
    return _mapped(documents, text, ids, "array<int>", lambda p: Encoder(p).encode, pieces or read_model())


def decode(encoded: DataFrame, ids: str = "ids", text: str = "text", pieces: Pieces | None = None) -> DataFrame:
    """``encoded`` with the text of ``ids`` in its place. Null ids give an empty text, as do ids of control pieces.

    Decoding an encoded text gives it back, but for U+2581, the mark itself, which comes back as a space.
    """
    return _mapped(encoded, ids, text, "string", lambda p: Decoder(p).decode, pieces or read_model())


@query("op10_sentencepiece")
def op10_sentencepiece(spark, folder):
    pieces = read_model()
    texts = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = encode(texts.withColumn("original", F.xxhash64("text")), pieces=pieces)
    decoded = decode(encoded.withColumn("kept", F.col("ids")), ids="ids", pieces=pieces)
    return decoded.select(
        "doc_id", F.size("kept").cast("bigint").alias("n_tokens"), F.col("kept").alias("ids"), (F.xxhash64("text") == F.col("original")).alias("round_trip")
    )
