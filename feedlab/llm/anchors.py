"""Vector codes from one codebook for each part, fitted over metric trees that are built from anchors.

Blocks of vectors are cut into parts, and each part of a block gets a tree of balls. The tree is built from the
middle: about sqrt(n) anchors are spread over the points, each new one at the point farthest from its owner,
taking over what lies nearer to it; anchors are then merged pair by pair up to the root, and each anchor's own
points are split further in the same way. A ball caches the sum and the number of its points. To assign points
to codebook entries, a ball inherits the entries that its parent could not rule out. Once one is left the ball is
owned as a whole, and its cached sum is all the update needs; otherwise its children are asked, and in the end
single points are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from feedlab.llm.common import bounded_batches, stored
from feedlab.llm.vectors import first_rows, matrix, squared, whole_numbers, with_total

#: Vectors of a block at most, and points of a ball that is not split.
BLOCK = 2048
LEAF = 96


@dataclass
class Tree:
    """Balls in arrays. A ball's points are ``points[first:last]``; ``left`` is -1 where it is not split."""

    points: np.ndarray
    order: np.ndarray  # the row of the block each point came from
    pivot: np.ndarray
    radius: np.ndarray
    total: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray

    #: How each array is stored.
    TYPES = {"points": np.int32, "order": np.int32, "pivot": np.float64, "radius": np.float64, "total": np.int64,
             "first": np.int32, "last": np.int32, "left": np.int32, "right": np.int32}
    WIDE = ("points", "pivot", "total")

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.TYPES.items()}

    @classmethod
    def unpacked(cls, held: dict[str, bytes], dims: int) -> Tree:
        arrays = {name: np.frombuffer(held[name], kind) for name, kind in cls.TYPES.items()}
        return cls(**{n: a.reshape(-1, dims) if n in cls.WIDE else a for n, a in arrays.items()})


def _length(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=-1))


def anchored(x: np.ndarray, count: int) -> np.ndarray:
    """The anchor that owns each point, of up to ``count`` anchors; fewer only if all points lie on anchors.

    A new anchor stands on the point farthest from its owner. An owner's point nearer than half the way between
    the two anchors cannot change hands, so only the others are measured.
    """
    owner = np.zeros(len(x), np.int64)
    centers = [x[0]]
    far = _length(x - x[0])
    while len(centers) < count:
        at = int(far.argmax())
        if far[at] == 0:
            break
        new = x[at]
        half = _length(np.asarray(centers) - new) / 2
        asked = np.flatnonzero(far >= half[owner])
        reach = _length(x[asked] - new)
        taken = reach < far[asked]
        owner[asked[taken]] = len(centers)
        far[asked[taken]] = reach[taken]
        centers.append(new)
    return owner


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of a block's points (one row at least)."""
    x = points.astype(np.float64)
    pivots: list[np.ndarray] = []
    radii: list[float] = []
    sizes: list[int] = []
    children: list[tuple[int, int]] = []
    members: dict[int, np.ndarray] = {}

    def ball(pivot: np.ndarray, radius: float, size: int, pair: tuple[int, int]) -> int:
        pivots.append(pivot)
        radii.append(radius)
        sizes.append(size)
        children.append(pair)
        return len(pivots) - 1

    def grow(rows: np.ndarray) -> int:
        own = x[rows]
        if len(rows) > leaf:
            owner = anchored(own, int(np.ceil(np.sqrt(len(rows)))))
            if owner.any():
                return merge([grow(rows[owner == k]) for k in range(owner.max() + 1) if (owner == k).any()])
        pivot = own.mean(axis=0)
        node = ball(pivot, float(_length(own - pivot).max()), len(rows), (-1, -1))
        members[node] = rows
        return node

    def merge(balls: list[int]) -> int:
        """The pair that makes the smallest ball becomes one, until one is left."""
        live = np.asarray(balls)
        center, reach = np.stack([pivots[b] for b in balls]), np.asarray([radii[b] for b in balls])
        size = np.asarray([sizes[b] for b in balls], float)

        def around(k: int) -> np.ndarray:
            """Radius of the ball around ball ``k`` and each other, about their common mean."""
            gap = _length(center - center[k])
            share = size[k] / (size + size[k])
            return np.maximum(gap * share + reach, gap * (1 - share) + reach[k])

        cost = np.stack([around(k) for k in range(len(live))])
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(balls) - 1):
            a, b = divmod(int(cost.argmin()), len(live))
            joint, most = size[a] + size[b], float(cost[a, b])
            middle = (center[a] * size[a] + center[b] * size[b]) / joint
            live[a] = ball(middle, most, int(joint), (int(live[a]), int(live[b])))
            center[a], reach[a], size[a] = middle, most, joint
            cost[b, :], cost[:, b] = np.inf, np.inf
            gone = np.isinf(cost[a])
            cost[a] = np.where(gone, np.inf, around(a))
            cost[:, a] = cost[a]
        return int(live[a]) if len(balls) > 1 else int(live[0])

    root = grow(np.arange(len(x)))
    # number the balls from the root down, and the points as they come in that order
    first, last, left, right, picked, order = [], [], [], [], [], []
    at = 0
    stack = [(root, -1, False)]
    while stack:
        node, parent, is_right = stack.pop()
        place = len(picked)
        picked.append(node)
        if parent >= 0:
            (right if is_right else left)[parent] = place
        first.append(at)
        last.append(at + sizes[node])
        left.append(-1)
        right.append(-1)
        a, b = children[node]
        if a < 0:
            order.append(members[node])
            at += sizes[node]
        else:
            stack += [(b, place, True), (a, place, False)]
    order = np.concatenate(order)
    inside = points[order]
    upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(inside, axis=0, dtype=np.int64)])
    first, last = np.asarray(first), np.asarray(last)
    pivot = np.stack([pivots[n] for n in picked])
    exact = [float(_length(inside[a:b] - p).max()) for a, b, p in zip(first, last, pivot, strict=True)]
    return Tree(inside, order, pivot, np.asarray(exact), upto[last] - upto[first], first, last,
                np.asarray(left), np.asarray(right))


class Codebook:
    """The entries of one part, and what all trees of a round share about them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.place = entries.astype(np.float64)
        self.apart = np.sqrt(squared(entries, entries))
        # of equal entries the one with the lowest index wins every tie
        self.distinct = np.sort(np.unique(entries, axis=0, return_index=True)[1])

    def owned(self, tree: Tree) -> Iterator[tuple[int, int, int | np.ndarray, int]]:
        """(first, last, entry, ball) for balls of one owner; (first, last, entry of each point, -1) otherwise.

        A ball rules out an entry that is farther than the nearest one from all its points: those within
        ``radius`` of the pivot all lie on the nearer side of the plane between the two. The bound is
        widened by more than rounding can amount to, so ties always reach the exact comparison.
        """
        stack = [(0, self.distinct)]
        while stack:
            node, asked = stack.pop()
            if len(asked) > 1:
                gap = self.place[asked] - tree.pivot[node]
                d = (gap * gap).sum(axis=1)
                best = int(d.argmin())
                reach = 2 * tree.radius[node] * self.apart[asked[best], asked]
                asked = asked[d - d[best] <= reach * (1 + 1e-9) + 1e-9 * (1 + d + d[best])]
            first, last = int(tree.first[node]), int(tree.last[node])
            if len(asked) > 1 and tree.radius[node] == 0:  # copies of one point
                asked = asked[squared(tree.points[first:first + 1], self.entries[asked]).argmin(axis=1)]
            if len(asked) == 1:
                yield first, last, int(asked[0]), node
            elif tree.left[node] < 0:
                yield first, last, asked[squared(tree.points[first:last], self.entries[asked]).argmin(axis=1)], -1
            else:
                stack += [(int(tree.right[node]), asked), (int(tree.left[node]), asked)]


def _tree_blocks(parts: int, dims: int, label: pa.DataType):
    """A function from batches of (vec_id, label, x) to blocks with a tree for each part."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                x = matrix(some.column(2), dims * parts)
                trees = [build(x[:, k * dims:(k + 1) * dims]).packed() for k in range(parts)]
                offsets = pa.array([0, some.num_rows], pa.int32())
                columns = {"vec_ids": pa.ListArray.from_arrays(offsets, pa.concat_arrays([some.column(0)])),
                           "labels": pa.ListArray.from_arrays(offsets, pa.concat_arrays([some.column(1)]).cast(label))}
                columns |= {name: pa.array([[t[name] for t in trees]], pa.list_(pa.binary())) for name in Tree.TYPES}
                yield pa.RecordBatch.from_pydict(columns)

    return blocks


def _trees(batch: pa.RecordBatch, row: int, dims: int) -> list[Tree]:
    held = {name: batch.column(name)[row].as_py() for name in Tree.TYPES}
    return [Tree.unpacked({n: held[n][k] for n in held}, dims) for k in range(len(held["points"]))]


def _sums(books: list[np.ndarray]):
    """A function from blocks to a task's sums and counts of every entry in use."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        total, count = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for k, tree in enumerate(_trees(batch, row, books[0].shape[1])):
                    for first, last, entry, node in codebooks[k].owned(tree):
                        if node < 0:
                            np.add.at(total[k], entry, tree.points[first:last])
                            np.add.at(count[k], entry, 1)
                        else:
                            total[k][entry] += tree.total[node]
                            count[k][entry] += last - first
        for k in range(len(books)):
            used = np.flatnonzero(count[k])
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(used), k, np.int32)), "entry": pa.array(used.astype(np.int32)),
                "rows": pa.array(count[k][used]), "sums": pa.array(list(total[k][used]), pa.list_(pa.int64()))})

    return sums


@dataclass(frozen=True)
class Fitted:
    """Codebooks, one array of entries for each part, and the blocks they were fitted on."""

    books: list[np.ndarray]
    blocks: DataFrame
    label: str

    def digest(self) -> str:
        """Of all components by part, entry and place, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


def fit(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Fitted | None:
    """Codebooks of every part after ``rounds`` rounds over all vectors; None if there are no vectors.

    Codebooks start with the vectors of the smallest vec_ids (a null id comes last, equal ids by content).
    The vectors' length is that of the first of these; vectors of another length, or one that cannot be cut
    into ``parts``, are left out. The driver holds the codebooks only, and the sums of their entries.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = whole_numbers(vectors).filter(F.size("x") % parts == 0)
    one = first_rows(rows, 1, F.col("vec_id").asc_nulls_last())
    if not one:
        return None
    length = len(one[0]["x"])
    rows = rows.filter(F.size("x") == length)
    start = np.array([r["x"] for r in first_rows(rows, entries, F.col("vec_id").asc_nulls_last())], np.int64)
    dims = length // parts
    books = [start[:, k * dims:(k + 1) * dims] for k in range(parts)]
    label = rows.schema["label"].dataType
    schema = f"vec_ids array<bigint>, labels array<{label.simpleString()}>, " + ", ".join(
        f"{name} array<binary>" for name in Tree.TYPES)
    blocks = stored(rows.mapInArrow(_tree_blocks(parts, dims, to_arrow_type(label)), schema), "anchors")
    for _ in range(rounds):
        found = blocks.mapInArrow(_sums(books), "part int, entry int, rows bigint, sums array<bigint>")
        sums = [F.sum(F.get("sums", F.lit(i))) for i in range(dims)]
        books = [b.copy() for b in books]
        # parts x entries rows at most
        for r in found.groupBy("part", "entry").agg(F.sum("rows").alias("rows"), F.array(*sums).alias("sums")).collect():
            books[r["part"]][r["entry"]] = np.array(r["sums"], np.int64) // r["rows"]
    return Fitted(books, blocks, label.simpleString())


def encode(fitted: Fitted) -> DataFrame:
    """vec_id, label, codes (entry of each part), error (squared distance to the entries), a row for each vector."""
    books = fitted.books

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                trees = _trees(batch, row, books[0].shape[1])
                found = np.zeros((len(trees[0].order), len(trees)), np.int32)
                error = np.zeros(len(found), np.int64)
                for k, tree in enumerate(trees):
                    owner = np.zeros(len(found), np.int32)
                    for first, last, entry, _ in codebooks[k].owned(tree):
                        owner[first:last] = entry
                    off = tree.points - books[k][owner]
                    found[tree.order, k] = owner
                    error[tree.order] += (off * off).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[row].values, batch.column("labels")[row].values,
                     pa.array(list(found), pa.list_(pa.int32())), pa.array(error)],
                    names=["vec_id", "label", "codes", "error"])

    return fitted.blocks.mapInArrow(codes, f"vec_id bigint, label {fitted.label}, codes array<int>, error bigint")


def decode(codes: DataFrame, fitted: Fitted) -> DataFrame:
    """``codes`` with ``x``, the vector of whole numbers that the entries make up; out-of-range codes are null."""
    tables = [F.array(*[F.array(*[F.lit(v) for v in entry]) for entry in book.tolist()]) for book in fitted.books]
    parts = [F.get(table, F.get("codes", F.lit(k))) for k, table in enumerate(tables)]
    return codes.withColumn("x", F.concat(*parts))


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every vector that is there and finite.

    ``code`` has two hex digits for each part (up to 256 entries). ``label_error`` is the error summed over equal
    labels, nulls together. Equal vectors get equal codes, repeated ids and null ids a row each; fewer vectors
    than entries make smaller codebooks; an empty table gives no rows; further columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits hold up to 256 entries")
    fitted = fit(vectors, parts, entries, rounds)
    if fitted is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    rows = stored(encode(fitted).select("vec_id", "label", F.concat_ws("", digits).alias("code"), "error"), "codes")
    return (with_total(rows, "label", "error", "label_error")
            .select("vec_id", "code", "error", "label_error", F.lit(fitted.digest()).alias("codebooks_sha256")))
