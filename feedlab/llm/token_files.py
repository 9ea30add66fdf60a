"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file is a series of zstandard frames, each with its own content checksum, then two skippable frames:
a directory (first document, documents, ids and flags of each frame) and, last, the seek table of the
public zstandard seekable format (compressed size, size, checksum of each frame). A reader opens the
end of the file, finds the frames that may hold the documents it wants, and decompresses only those.

The content of a frame, little-endian: number of documents n (uint32), bytes of an id (uint32, 2 or 4),
n document ids (int64), n flags (uint8, 0 for a null document id), n lengths (uint32), then the ids.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
import xxhash
import zlib
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedlab.llm.common import bounded_batches, partitions, plain, slices
from feedlab.storage import checkpointed, fresh_path

# Fixed values of the public formats.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Ids after which a frame is closed; a longer document has a frame of its own.
FRAME_IDS = 1 << 18

#: Words whose ids a worker remembers.
REMEMBERED = 300_000

#: Signs that stand behind words and are one part of the split with each other.
STOPS = ".,;:!?*#$%&"

#: Letters that no normal form joins with their neighbours and that each have one lower case: those below U+0130.
LETTERS = "".join(chr(c) for c in range(0x130) if chr(c).isalpha())

#: White space that texts are cut at.
SPACES = " \t\n\x0b\x0c\r"

MANIFEST = "part int, path string, first_doc long, last_doc long, docs long, ids long"


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def splits_at_space(made: dict) -> regex.Pattern | None:
    """The splitter's pattern, if the definition proves that ids of words between white space are those of the text.

    That holds if the text is normalised by steps that handle each word by itself, and cut into matches of a
    pattern each alternative of which is a literal without white space, or a class of characters, once or repeated,
    that holds none; what lies between matches is dropped, so white space only ever ends a piece; and no added
    token holds or swallows white space. None for every other definition.
    """
    normal, cut = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}
    steps = [x.get("type") for x in normal.get("normalizers", [])]
    pieces = cut.get("pretokenizers") or [{}]
    if steps != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in pieces] != ["Split", "ByteLevel"]:
        return None
    first, second = pieces
    replaced = normal["normalizers"][1]
    if not (replaced["pattern"] == {"Regex": r"\s+"} and replaced["content"] == " " and first.get("invert")
            and first.get("behavior") == "Removed" and not second.get("use_regex") and not second.get("add_prefix_space")):
        return None
    pattern = first["pattern"].get("Regex", " ")
    for choice in regex.split(r"\|(?![^\[]*\])", pattern):
        literal = regex.fullmatch(r"[^\\\[\](){}.*+?^$\s]+", choice)
        one = regex.fullmatch(r"(\[[^\[\]]+\])\+?", choice)
        if not literal and not (one and not any(regex.match(one[1], c) for c in SPACES)):
            return None
    for token in made.get("added_tokens", []):
        if token["lstrip"] or token["rstrip"] or any(c in SPACES for c in token["content"]):
            return None
    return regex.compile(pattern)


class WordEncoder:
    """Ids of whole texts by the tokenizers library.

    Where the definition proves that pieces end at white space (``splits_at_space``), each distinct word is
    encoded once and remembered. Words of plain letters go to the library's merges as they are, other words of a known
    kind are split by the definition's own pattern first, and the rest go through the whole library. By any other
    definition whole texts are encoded.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.split = splits_at_space(json.loads(definition))
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def part(self, text: str) -> list[int]:
        own = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(own)]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word(self, text: str) -> list[int]:
        if not text:
            return []
        # Below U+0130 no letter is composed or has a lower case that depends on its neighbours.
        if not (text.isascii() or max(text) < "\u0130") or "<|" in text or not text.isprintable():
            return self.whole(text)
        return [i for p in self.split.findall(text.lower()) for i in self.part(p)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many belong to each text.

        Plain words are looked up without their case and apart from the signs behind them.
        """
        if self.split is None:
            ids = [np.array(self.whole(t), np.uint32) for t in texts.to_pylist()]
            return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array([len(x) for x in ids], np.int64)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        names, codes = coded.dictionary, np.asarray(coded.indices, np.int64)
        tail = pc.utf8_ltrim(names, LETTERS)
        simple = pc.equal(pc.ascii_rtrim(tail, STOPS), "")  # letters, then signs, either of them possibly none
        head = pc.if_else(simple, pc.utf8_lower(pc.ascii_rtrim(names, STOPS)), names)
        parts = pa.concat_arrays([head, pc.if_else(simple, tail, "")]).dictionary_encode()
        # no word holds a line break
        every = pc.binary_join(pa.ListArray.from_arrays([0, len(parts.dictionary)], parts.dictionary), "\n")[0].as_py()
        ids = self.look_up(every.split("\n")) if len(parts.dictionary) else []
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        pair = np.asarray(parts.indices, np.int64).reshape(2, -1)[:, codes].T.ravel()  # head, tail, head, tail ...
        first = np.cumsum(lengths) - lengths
        size = lengths[pair]
        end = np.cumsum(size)
        found = flat[np.repeat(first[pair] - (end - size), size) + np.arange(int(size.sum()))]
        bounds = np.concatenate([[0], end])[2 * np.asarray(words.offsets, np.int64)]
        return found, np.diff(bounds)

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of each of some different words as bytes, kept for later; of what was not asked for lately only half
        is forgotten."""
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        found = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = before.get(w)
                if ids is None:
                    # letters below U+0130 in lower case are one piece as they stand
                    ids = array("I", self.part(w) if w.isalpha() and max(w) < "\u0130" else self.word(w)).tobytes()
                known[w] = ids
            found.append(ids)
        return found


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(definition: str) -> WordEncoder:
    """The encoder of this worker, kept for the tasks to come."""
    if definition not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition] = WordEncoder(definition)
    return _ENCODERS[definition]


class FrameWriter:
    """Writes one file, frame by frame; memory holds one frame and a few numbers for each frame."""

    def __init__(self, stream):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.directory, self.table = [], []
        self._open()

    def _open(self) -> None:
        self.docs: list[int] = []
        self.has: list[int] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if self.docs and self.size + len(ids) > FRAME_IDS:
            self.close_frame()
        self.docs.append(0 if doc is None else doc)
        self.has.append(doc is not None)
        self.ids.append(ids)
        self.size += len(ids)

    def close_frame(self) -> None:
        if not self.docs:
            return
        ids = np.concatenate(self.ids)
        width = 2 if ids.max(initial=0) < 1 << 16 else 4
        content = b"".join([
            struct.pack("<II", len(self.docs), width), np.array(self.docs, "<i8").tobytes(),
            np.array(self.has, np.uint8).tobytes(), np.array([len(x) for x in self.ids], "<u4").tobytes(),
            ids.astype(f"<u{width}").tobytes()])
        packed = self.packer.compress(content)
        self.stream.write(packed)
        known = [d for d, h in zip(self.docs, self.has) if h]
        self.directory.append(struct.pack("<qqIQ", min(known, default=0), max(known, default=-1), len(self.docs),
                                          self.size))
        self.table.append(struct.pack("<III", len(packed), len(content),
                                      xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self._open()

    def close(self) -> None:
        self.close_frame()
        directory = b"".join(self.directory)
        self.stream.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.stream.close()


def _frames(stream) -> list[tuple]:
    """(first doc, last doc, docs, ids, offset, packed size, size, checksum) of each frame, from the file's end."""
    end = stream.size()
    stream.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a file with a seek table")
    stream.seek(end - 9 - 12 * count)
    table = np.frombuffer(stream.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
    stream.seek(end - 9 - 12 * count - 8 - 28 * count)
    directory = list(struct.iter_unpack("<qqIQ", stream.read(28 * count)))
    offsets = np.cumsum(table[:, 0]) - table[:, 0]
    return [(*d, int(o), *map(int, t)) for d, o, t in zip(directory, offsets, table)]


def _documents(stream, frame: tuple) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and ids of a frame, its checksum verified."""
    stream.seek(frame[4])
    content = zstandard.ZstdDecompressor().decompress(stream.read(frame[5]), max_output_size=frame[6])
    if len(content) != frame[6] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != frame[7]:
        raise ValueError(f"frame at {frame[4]} is damaged")
    n, width = struct.unpack_from("<II", content)
    docs = np.frombuffer(content, "<i8", n, 8).tolist()
    has = np.frombuffer(content, np.uint8, n, 8 + 8 * n)
    lengths = np.frombuffer(content, "<u4", n, 8 + 9 * n).astype(np.int64)
    ids = np.frombuffer(content, f"<u{width}", -1, 8 + 13 * n).astype("<u4")
    return [d if h else None for d, h in zip(docs, has)], lengths, ids


def _open_file(path: str, write: bool = False):
    files, place = pafs.FileSystem.from_uri(path)
    if write:
        files.create_dir(place.rpartition("/")[0], recursive=True)
    return files.open_output_stream(place, compression=None) if write else files.open_input_file(place)


def _uri(path: str) -> str:
    return path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}"


def write(docs: DataFrame, definition: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode every whole text, close it with ``end_id``, and write files in ascending doc_id order.

    ``definition`` is the vocabulary as JSON text. Returns the manifest: one row a file. Rows are put in order by
    ranges, so each task writes one range as one file; a task that runs again writes a new file, and the
    stored manifest names only files of tasks that ended. A null text has only ``end_id``; null ids come
    first; rows that share an id are ordered by text; further columns are ignored; no rows, no files.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    folder = _uri(folder or fresh_path(spark, "tokens"))
    shared = spark.sparkContext.broadcast(definition)  # one vocabulary file, whatever the corpus

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, first, last, rows, total = None, None, None, None, 0, 0
        for batch in batches:
            for piece in slices(batch, size=4 << 20):
                if out is None:
                    path = f"{folder}/{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.ids.zst"
                    encoder, out = encoder_of(shared.value), FrameWriter(_open_file(path, write=True))
                ids, sizes = encoder.encode(plain(piece.column(1)))
                at = 0
                for doc, size in zip(piece.column(0).to_pylist(), sizes.tolist()):
                    out.add(doc, np.append(ids[at:at + size], np.uint32(end_id)))
                    at += size
                    first = doc if first is None else first
                    last = doc if doc is not None else last
                rows, total = rows + piece.num_rows, total + len(ids) + piece.num_rows
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "path": path, "first_doc": first, "last_doc": last,
                  "docs": rows, "ids": total}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("first_doc", pa.int64()),
                           ("last_doc", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())]))

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text"))
    return checkpointed(ordered.mapInArrow(write_part, MANIFEST))


def with_base(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids in all files before; one small row for each file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def summaries(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files frame by frame."""

    def read_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                with _open_file(path) as stream:
                    for frame in _frames(stream):
                        docs, lengths, ids = _documents(stream, frame)
                        ends = np.cumsum(lengths)
                        raw = memoryview(ids.tobytes())
                        yield pd.DataFrame({
                            "doc_id": pd.array(docs, "Int64"), "start": base + ends - lengths, "n_tokens": lengths,
                            "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends - lengths, ends)]})
                        base += int(lengths.sum())

    spread = with_base(manifest).repartitionByRange(partitions(manifest.sparkSession), "part")
    return spread.mapInPandas(read_part, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the documents in ``wanted`` (doc_id); only frames that may hold one are read.

    Files hold ranges of ids in ascending order, so the files of an id are found by halving the list of first and
    last ids: two numbers a file, and there are as many files as one stage had tasks. A document that was written
    more than once comes as often; null ids are not looked for.
    """
    files = sorted((r["first_doc"], r["last_doc"], r["part"]) for r in
                   manifest.filter("first_doc IS NOT NULL").select("first_doc", "last_doc", "part").collect())
    first, last, part = (np.array(x, np.int64) for x in (zip(*files) if files else ([], [], [])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = np.asarray(batch.column(0), np.int64)
            low, high = np.searchsorted(last, docs), np.searchsorted(first, docs, "right")
            size = np.maximum(high - low, 0)
            at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            yield pa.RecordBatch.from_pydict({"part": pa.array(part[at].astype(np.int32)),
                                              "doc_id": pa.array(np.repeat(docs, size))})

    def read_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, asked in zip(batch["path"], batch["asked"]):
                asked = np.sort(np.asarray(asked, np.int64))
                with _open_file(path) as stream:
                    for frame in _frames(stream):
                        near = asked[np.searchsorted(asked, frame[0]):np.searchsorted(asked, frame[1], "right")]
                        if not len(near):
                            continue
                        docs, lengths, ids = _documents(stream, frame)
                        ends, near = np.cumsum(lengths), set(near.tolist())
                        hits = [(d, ids[e - n:e].tolist()) for d, n, e in zip(docs, lengths, ends) if d in near]
                        yield pd.DataFrame(hits, columns=["doc_id", "ids"])

    asked = (wanted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
             .mapInArrow(place, "part int, doc_id long")
             .groupBy("part").agg(F.collect_list("doc_id").alias("asked"))  # ids of one file's documents
             .join(manifest.select("part", "path"), "part"))
    return asked.mapInPandas(read_part, "doc_id long, ids array<long>")


def definition_of(path: str) -> str:
    """The JSON text of a vocabulary file, read once on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def digests(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write the files of ``docs`` and return the summary of every document read back from them."""
    return summaries(write(docs, definition_of(vocabulary), end_id))
