"""Encoding into the pieces of a SentencePiece vocabulary, and back, by a single-pass Viterbi search.

An Aho-Corasick automaton over the pieces reads a text once; at each position its output links give every
piece that ends there, and each relaxes the best score of that position. Characters no piece covers become
byte pieces. A space never stands inside a piece behind another character, so the best path is found word
by word, and each distinct word of a slice of text is searched once.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feedlab.llm.common import bounded_batches, plain, slices

SPACE = "\u2581"

#: Below the worst piece by this much for a character without a piece.
UNKNOWN_PENALTY = 10.0

#: Words after which a worker starts a new generation of those it remembers between slices of text; words of the
#: generation before that come again move over, all others are forgotten with it.
GENERATION = 150_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores (None for control, unknown and byte pieces), and the ids of the 256 bytes."""

    pieces: tuple[str, ...]
    scores: tuple[float | None, ...]
    bytes_: tuple[int, ...]
    unknown: int


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; its size does not depend on the corpus.

    The scores of a unigram model are log-probabilities and are used as they are. A merge-based model
    stores ranks (0, -1, -2, ...), which do not add up over a path; they become the log-probabilities of
    Zipf's law, -log(rank + 2) - log(log(pieces)).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = tuple(model.id_to_piece(i) for i in range(n))
    plain_ids = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                             or model.is_unused(i))]
    scores: list[float | None] = [None] * n
    for i in plain_ids:
        scores[i] = model.get_score(i)
    if all(float(scores[i]).is_integer() for i in plain_ids):
        for i in plain_ids:
            scores[i] = -math.log(2 - scores[i]) - math.log(math.log(n + 2))
    of_byte = {names[i]: i for i in range(n) if model.is_byte(i)}
    return Vocabulary(names, tuple(scores), tuple(of_byte.get(f"<0x{b:02X}>", model.unk_id()) for b in range(256)),
                      model.unk_id())


class Encoder:
    """The automaton of a vocabulary and the pieces of the words seen lately."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        scored = [(p.replace(SPACE, " "), s, i) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores))
                  if s is not None and p]
        for piece, score, i in scored:
            self.automaton.add_word(piece, (len(piece), score, (len(piece), i)))
        self.floor = min((s for _, s, _ in scored), default=0.0) - UNKNOWN_PENALTY
        if scored:
            self.automaton.make_automaton()
        self.letters = {p for p, _, _ in scored if len(p) == 1}

    def best(self, text: str) -> list[int]:
        """Ids of the best path through ``text``, which starts with its space.

        The automaton reports matches by their end, the longest first; each relaxes the score of its end.
        A character that is a piece by itself never needs its bytes, which score less.
        """
        n = len(text)
        score, step = [0.0] + [-math.inf] * n, [(1, -1)] * (n + 1)
        if self.letters.issuperset(text):
            for last, (size, value, which) in self.automaton.iter(text):
                found = score[last + 1 - size] + value
                if found > score[last + 1]:
                    score[last + 1], step[last + 1] = found, which
        else:
            ends: list[list] = [[] for _ in range(n + 1)]
            for last, match in self.automaton.iter(text) if len(self.automaton) else ():
                ends[last + 1].append(match)
            for end in range(1, n + 1):
                score[end] = score[end - 1] + self.floor
                for size, value, which in ends[end]:
                    found = score[end - size] + value
                    if found > score[end]:
                        score[end], step[end] = found, which
        ids: list[int] = []
        at = n
        while at:
            size, piece = step[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.vocabulary.bytes_[b] for b in reversed(text[at - 1].encode())]
            at -= size
        return ids[::-1]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many belong to each text."""
        words = [split_words(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(words)), pa.string()).dictionary_encode()
        codes, names = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        if len(self.known) > GENERATION:
            self.known, self.before = {}, self.known
        for w in names:
            if w not in self.known:
                self.known[w] = self.before.get(w) or array("i", self.best(" " + w)).tobytes()
        lists = [self.known[w] for w in names]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.int32)
        first = np.cumsum(lengths) - lengths
        size = lengths[codes]
        end = np.cumsum(size)
        ids = flat[np.repeat(first[codes] - (end - size), size) + np.arange(int(size.sum()))]
        bounds = np.concatenate([[0], end])[np.cumsum([0, *map(len, words)])]
        return ids, np.diff(bounds)


def split_words(text: str) -> list[str]:
    """Words of a text, each without the one space before it; further spaces go with the word behind them."""
    parts = text.split(" ") if text else []
    if "" not in parts:
        return parts
    words, spaces = [], ""
    for part in parts[:-1]:
        if part:
            words.append(spaces + part)
            spaces = ""
        else:
            spaces += " "
    return [*words, spaces + parts[-1]]


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids of every whole text.

    As the format has it, a text gets one space in front and spaces become the space mark. Null and empty
    texts have no ids; repeated rows and null ids are rows like others; further columns are ignored; no
    rows, no rows. Each row is encoded by itself, nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, shared.value)

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary)  # of this task: nothing stays in the worker after it
    for batch in batches:
        for part in slices(batch):
            ids, sizes = encoder.encode(plain(part.column(1)).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))],
                names=["doc_id", "ids"])


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.raw = [p.replace(SPACE, " ").encode() if s is not None else b""
                    for p, s in zip(vocabulary.pieces, vocabulary.scores)]
        self.raw[vocabulary.unknown] = " \u2047 ".encode()
        for b, i in enumerate(vocabulary.bytes_):
            if i != vocabulary.unknown:
                self.raw[i] = bytes([b])

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the one space that encoding put in front."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _columns(keep_text: bool) -> str:
    return "doc_id long, n_tokens long, ids array<int>, text_sha256 string" + ", text string" * keep_text


def decode(encoded: DataFrame, vocabulary: Vocabulary, keep_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids and text_sha256 of the decoded text (and the text itself, if wanted)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(batches, shared.value, keep_text)

    return encoded.select("doc_id", "ids").mapInArrow(run, _columns(keep_text))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, keep_text: bool = False) -> DataFrame:
    """What ``decode`` gives of what ``encode`` gives, by one Python worker a task instead of two."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, shared.value), shared.value, keep_text)

    return _texts(docs).mapInArrow(run, _columns(keep_text))


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, keep_text: bool) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(vocabulary)
    for batch in batches:
        ids = batch.column(1)
        values, sizes = np.asarray(ids.flatten()), np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
        ends = np.cumsum(sizes, dtype=np.int64)
        texts = [decoder.decode(values[e - n:e].tolist()) for e, n in zip(ends.tolist(), sizes.tolist())]
        own = [batch.column(0), pc.cast(pc.list_value_length(ids), pa.int64()), ids,
               pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())]
        names = ["doc_id", "n_tokens", "ids", "text_sha256"]
        if keep_text:
            own, names = [*own, pa.array(texts, pa.string())], [*names, "text"]
        yield pa.RecordBatch.from_arrays(own, names=names)
