"""Long repeats over a corpus by a suffix array at anchors, its common-prefix intervals and their left extensions.

Every string of ``length`` bytes has an anchor: the place in it whose ``GRAM`` bytes hash lowest (the first such).
Two equal strings have equal anchors, so the suffixes that start at anchors are enough to find every repeat, and
a repeat reaches at most ``length - GRAM`` bytes to either side of the anchor that stands for it.

Suffixes meet by the hash of their gram. Those alike over the whole reach on both sides are one class; a class that
occurs twice is covered as far as it reaches. Where classes of one gram differ, their suffixes are sorted, neighbours
give the common-prefix array, and a stack scan gives its interval tree. The left contexts of each interval are
sorted and scanned in the same way; an interval of them whose members go on to the right in more than one
way is a maximal repeat, with all its members.

Grams with more than ``CLASSES`` classes take no such scan, as it needs all of them at once. Their classes are
taken apart into the strings of ``length`` bytes around the gram, which are counted by hash over all tasks.

Grams, contexts and strings are compared by 64-bit hashes: two that differ pass for equal with a chance of 2^-64.
Contexts only meet within a gram, so of n different contexts of one gram about n^2 / 2^65 pairs are mixed up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feedlab.llm.bytesums import ByteSums, mixed
from feedlab.llm.common import bounded_batches, partitions, stored, utf8

LENGTH, GRAM = 200, 64

#: Rows of one gram after which its classes are folded.
HELD = 40_000

#: Classes of one gram that are held and scanned together; of more, the strings around the gram are counted.
CLASSES = 4_096

#: Starts of strings looked at together.
STEP = 1 << 17

_ROWS = "part long, g long, c long, _id long, _v long, pos int, before int, after int, dup boolean, cover boolean"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]


_HELD_NAMES = ["_id", "_v", "pos", "before", "after", "g", "dup", "cover", "many"]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """row, pos, before, after, g, c of the anchors of texts that stand one behind another in ``data``.

    ``before`` and ``after`` are how far the context reaches around the gram, up to length - gram bytes and never
    beyond the text; c is a hash of both contexts.
    """
    reach, width = length - gram, length - gram + 1
    starts, ends = offsets[:-1], offsets[1:]
    found: list[np.ndarray] = []
    columns: dict[str, list[np.ndarray]] = {k: [] for k in ("row", "pos", "before", "after", "g", "c")}
    base = int(offsets[0])
    for a in range(base, int(offsets[-1]) - length + 1, STEP):
        b = min(a + STEP, int(offsets[-1]) - length + 1)  # starts a .. b-1
        low, high = max(a - reach, base), min(b - 1 + length + reach, int(offsets[-1]))
        sums = ByteSums(data[low:high])
        n = b - a + width - 1  # grams that the strings look at
        gh = sums.every(gram)[a - low:a - low + n]
        key = (gh & ~np.uint64((1 << 20) - 1)) | np.arange(n, dtype=np.uint64)
        pad = np.full(-n % width + width, np.iinfo(np.uint64).max, np.uint64)
        blocks = np.concatenate([key, pad]).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:b - a], ahead[width - 1:width - 1 + b - a]) & np.uint64((1 << 20) - 1)
        row = np.searchsorted(starts, np.arange(a, b), "right") - 1 if len(starts) < 2 else _owner(starts, a, b)
        whole = np.arange(a, b) + length <= ends[row]
        mark = np.zeros(n, bool)
        mark[least[whole].astype(np.int64)] = True
        at = np.flatnonzero(mark) + a
        at = at[~np.isin(at, found[-1])] if found else at
        found = [at]
        if not len(at):
            continue
        row = np.searchsorted(starts, at, "right") - 1
        left, right = np.maximum(starts[row], at - reach), np.minimum(ends[row], at + gram + reach)
        c = sums.ranges(left - low, at - low) + mixed(sums.ranges(at + gram - low, right - low)
                                                      + ((at - left) * 1024 + (right - at - gram)).astype(np.uint64))
        for name, values in (("row", row), ("pos", at - starts[row]), ("before", at - left),
                             ("after", right - at - gram), ("g", gh[at - a]), ("c", c)):
            columns[name].append(values)
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in columns.items()}


def _owner(starts: np.ndarray, a: int, b: int) -> np.ndarray:
    """The text that each place a .. b-1 stands in (the last of those that start there)."""
    first = np.searchsorted(starts, a, "right") - 1
    cuts = starts[first + 1:np.searchsorted(starts, b, "left")]
    steps = np.zeros(b - a, np.int64)
    np.add.at(steps, cuts - a, 1)
    return first + np.cumsum(steps)


def _keyed(docs: DataFrame) -> DataFrame:
    """_id, _v, doc_id, text: two hashes of id and text, 128 bits in all, tell rows apart.

    Rows alike in both id and text share a key, which is right: whatever covers one covers the other. Null ids are
    told apart by their texts. Two different rows share a key with a chance of 2^-128.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = [F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")]
    rows = docs.select(*own)
    # a null is skipped by the hash, so it is named
    named = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text")]
    return rows.select(F.xxhash64(*named).alias("_id"), F.xxhash64(F.lit("again"), *named).alias("_v"), "doc_id", "text")


def _found(docs: DataFrame) -> DataFrame:
    """Anchors, copies within a batch summed up: covers of all of them, and one that stands for them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            x = anchors(data, offsets)
            if not len(x["row"]):
                continue
            doc = np.asarray(batch.column(0), np.int64)[x["row"]]
            version = np.asarray(batch.column(1), np.int64)[x["row"]]
            g, c = x["g"].view(np.int64), x["c"].view(np.int64)
            order = np.lexsort((c, g))
            g, c, doc, version = g[order], c[order], doc[order], version[order]
            pos, before, after = (x[k][order].astype(np.int32) for k in ("pos", "before", "after"))
            fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
            dup = np.diff(np.append(np.flatnonzero(fresh), len(g)))[np.cumsum(fresh) - 1] > 1
            del x, order
            for rows, cover, part in ((fresh, False, g), (dup, True, doc * 0x9E3779B1 ^ version)):
                held = [y[rows] for y in (part, g, c, doc, version, pos, before, after, dup)]
                yield pa.RecordBatch.from_arrays([pa.array(y) for y in (*held, np.full(int(rows.sum()), cover))], _NAMES)

    return docs.select("_id", "_v", "text").mapInArrow(run, _ROWS)


def _resolved(found: DataFrame) -> DataFrame:
    """_id, _v, pos, before, after, g, dup, cover, many: covers, and the classes of grams that have several.

    Reads rows in the order of (g, c). Of a class that comes again every row is a cover. One row of each class
    goes on as a question if its gram has another class and not all of them are covered already. ``many`` marks
    the questions of grams with more than ``CLASSES`` classes; these go on as they come, covered or not.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, many = None, None  # many: the open gram, if classes of it have gone on
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            open_rows = (batch["g"] == batch["g"].iloc[-1]) & ~batch["cover"]
            held, done = batch[open_rows], batch[~open_rows]
            yield _classes(done, many)
            if len(held) > HELD:
                held, covers = _folded(held)
                yield covers
                if len(held) > CLASSES:  # the last class may go on in the next batch
                    many = held["g"].iloc[0]
                    yield held.iloc[:-1].assign(many=True)[_HELD_NAMES]
                    held = held.iloc[-1:]
        if held is not None:
            yield _classes(held, many)

    names = "_id long, _v long, pos int, before int, after int, g long, dup boolean, cover boolean, many boolean"
    return (found.repartition(partitions(found.sparkSession), "part").sortWithinPartitions("cover", "g", "c")
            .mapInPandas(run, names))


def _folded(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """One row of each class of an open gram, and the covers of classes that came again."""
    c = rows["c"].to_numpy()
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(first, len(c)))
    dup = (size > 1) | np.logical_or.reduceat(rows["dup"].to_numpy(), first)
    covers = rows[np.repeat(size > 1, size)].assign(cover=True, many=False)
    return rows.iloc[first].assign(dup=dup), covers[_HELD_NAMES]


def _classes(rows: pd.DataFrame, many: int | None = None) -> pd.DataFrame:
    """Covers and questions of whole grams; of the gram ``many``, classes have gone on before."""
    names = _HELD_NAMES
    rows = rows.assign(many=False)
    covers, own = rows[rows["cover"]], rows[~rows["cover"]]
    if own.empty:
        return covers[names]
    g, c = own["g"].to_numpy(), own["c"].to_numpy()
    fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
    first = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    size = np.diff(np.append(first, len(g)))
    dup = (size > 1) | np.logical_or.reduceat(own["dup"].to_numpy(), first)
    new = own[(size > 1)[group]].assign(cover=True)
    asked = own.iloc[first].assign(dup=dup)
    grams = asked.groupby("g")["dup"].transform("size")
    settled = asked.groupby("g")["dup"].transform("all")
    begun = asked["g"] == many if many is not None else np.zeros(len(asked), bool)
    asked = asked.assign(many=(grams > CLASSES) | begun)
    return pd.concat([covers[names], new[names], asked[((grams > 1) & ~settled) | begun][names]])


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """g, many, _id, _v, pos, left (read backwards), right: the contexts of the classes asked about."""
    per_doc = asked.groupBy("_id", "_v").agg(F.collect_list(F.struct("g", "many", "pos", "before", "after")).alias("asked"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, version, text, wanted in zip(batch["_id"], batch["_v"], batch["text"], batch["asked"]):
                data = text.encode("utf-8")
                for x in wanted:
                    p, q = x["pos"], x["pos"] + GRAM
                    rows.append((x["g"], x["many"], doc, version, p, data[p - x["before"]:p][::-1],
                                 data[q:q + x["after"]]))
            yield pd.DataFrame(rows, columns=["g", "many", "_id", "_v", "pos", "left", "right"])

    return (docs.select("_id", "_v", "text").join(per_doc, ["_id", "_v"])
            .mapInPandas(run, "g long, many boolean, _id long, _v long, pos int, left binary, right binary"))


def common(a: bytes, b: bytes) -> int:
    """Length of the common beginning, by halving: slices compare as fast as memory does."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of two or more sorted strings, from the common prefixes of neighbours.

    The stack holds the open intervals, ever deeper; an interval is closed, and its parent known to hold
    it, when a neighbour shares less.
    """
    stack: list[tuple[int, int]] = []
    for at, depth in enumerate([*prefixes, -1]):
        first = at
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, at
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(left: list[bytes], right: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left, bytes to the right, all members) of every maximal repeat around a common gram.

    Members share both sides; no more can be added on either side without losing one. Only repeats that reach
    ``least`` bytes on both sides together.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    place = {who: at for at, who in enumerate(order)}
    follow = [common(right[x], right[y]) for x, y in zip(order, order[1:])]
    rank = {who: at for at, who in enumerate(sorted(range(len(left)), key=left.__getitem__))}
    for depth, first, last in intervals(follow):
        members = sorted(order[first:last + 1], key=rank.__getitem__)
        before = [common(left[x], left[y]) for x, y in zip(members, members[1:])]
        if max(before) + depth < least:
            continue
        for reach, low, high in intervals(before):
            if reach + depth < least:
                continue
            own = members[low:high + 1]
            span = [place[x] for x in own]
            if min(follow[min(span):max(span)]) == depth:  # they go on to the right in more than one way
                yield reach, depth, own


def _searched(contexts: DataFrame, least: int) -> DataFrame:
    """_id, _v, pos, before, after: how far maximal repeats reach around each class asked about.

    A task holds one gram's classes, ``CLASSES`` at most, and one batch.
    """

    def covers(rows: pd.DataFrame) -> pd.DataFrame:
        g = rows["g"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
        left, right = rows["left"].tolist(), rows["right"].tolist()
        before, after = [0] * len(g), [-1] * len(g)  # the furthest reach so far: what nests is not kept
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(g)]):
            if b - a < 2:
                continue
            for reach, depth, members in maximal_repeats(left[a:b], right[a:b], least):
                for m in members:
                    before[a + m], after[a + m] = max(before[a + m], reach), max(after[a + m], depth)
        found = rows[["_id", "_v", "pos"]].assign(before=before, after=after)
        return found[found["after"] >= 0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            open_rows = batch["g"] == batch["g"].iloc[-1]
            held, done = batch[open_rows], batch[~open_rows]
            yield covers(done.reset_index(drop=True))
        if held is not None:
            yield covers(held.reset_index(drop=True))
        pa.default_memory_pool().release_unused()

    return (contexts.repartition(partitions(contexts.sparkSession), "g").sortWithinPartitions("g", "right")
            .mapInPandas(run, "_id long, _v long, pos int, before int, after int"))


def _counted(contexts: DataFrame, reach: int) -> DataFrame:
    """The same for grams of any number of classes: strings with ``reach`` bytes around the gram that come again.

    Two classes share such a string if they share gram, place of the gram in it, and the bytes on both sides. The
    strings of one class that come again all hold its gram, so the first and the last of them give what is covered.
    """
    before, after = F.length("left"), F.length("right")
    around = F.transform(
        F.sequence(F.greatest(F.lit(0), reach - after), F.least(before, F.lit(reach))),
        lambda b: F.struct(b.alias("before"), F.xxhash64(b, F.substr("left", F.lit(1), b),
                                                         F.substr("right", F.lit(1), reach - b)).alias("w")))
    strings = (contexts.filter(before + after >= reach).select("g", "_id", "_v", "pos", F.explode(around).alias("s"))
               .select("g", "s.w", "_id", "_v", "pos", "s.before"))
    # stored, so that the join deals both sides itself and can split a string that very many classes share
    again = stored(strings.groupBy("g", "w").agg(F.count("*").alias("n")).filter("n > 1").select("g", "w"), "strings")
    return (strings.join(again, ["g", "w"], "left_semi").groupBy("_id", "_v", "pos")
            .agg(F.max("before").alias("before"), (reach - F.min("before")).alias("after")))


def covered(keyed: DataFrame) -> DataFrame:
    """_id, _v, spans (array of start, end): what repeats of ``LENGTH`` bytes or more cover in each document."""
    rows = stored(_resolved(_found(keyed)), "repeats")
    contexts = _contexts(keyed, rows.filter("NOT cover"))
    if rows.filter("many").isEmpty():
        asked = _searched(contexts, LENGTH - GRAM)
    else:
        contexts = stored(contexts, "contexts")
        asked = _searched(contexts.filter("NOT many"), LENGTH - GRAM).union(
            _counted(contexts.filter("many"), LENGTH - GRAM))
    places = [F.col("pos") - F.col("before"), F.col("pos") + GRAM + F.col("after")]
    spans = rows.filter("cover").select("_id", "_v", "pos", "before", "after").union(asked).select(
        "_id", "_v", F.struct(places[0].alias("start"), places[1].alias("end")).alias("span"))
    return spans.groupBy("_id", "_v").agg(F.collect_set("span").alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (rows of start, end) as maximal runs in order."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(fresh)
    return np.column_stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]])


def _spans_of(column: pa.ListArray) -> list[np.ndarray]:
    """Rows of start and end for each document; none for a null."""
    fields = column.flatten()
    both = np.column_stack([np.asarray(fields.field(0), np.int64), np.asarray(fields.field(1), np.int64)])
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    return np.split(both, np.cumsum(sizes)[:-1])


def remove_repeats(docs: DataFrame, keep: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept (the remaining bytes) of every row.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same or another
    document, on the text as it came. Null texts are empty; shorter texts stay whole; repeated rows are documents
    of their own, so they cover each other; null ids are ids like others; further columns are ignored; no rows,
    no rows.
    """
    bounded_batches(docs.sparkSession)
    keyed = _keyed(docs)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep
    kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()][:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for doc, text, spans in zip(batch.column(0), batch.column(1), _spans_of(batch.column(2))):
                data, runs, at, parts = text.as_py().encode("utf-8"), merged(spans), 0, []
                for start, end in runs.tolist():
                    parts.append(data[at:start])
                    at = end
                left = b"".join([*parts, data[at:]])
                rows.append((doc.as_py(), len(data), len(data) - len(left), len(runs),
                             hashlib.sha256(left).hexdigest(), left)[:len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*rows), kinds)], names)

    return (keyed.join(covered(keyed), ["_id", "_v"], "left").select("doc_id", "text", "spans")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + ", kept binary" * keep))
