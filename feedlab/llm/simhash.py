"""SimHash fingerprints and near-duplicate groups through BK-trees.

A BK-tree keeps, below each node, one child for each integer Hamming distance to it. A search within radius
r that finds the query at distance d from a node follows only the edges d-r .. d+r. Fingerprints grow with the
corpus, so no tree of all of them is broadcast: fingerprints are dealt into shards that a link cannot leave.
Of four blocks of 16 bits, two bits of difference leave at least two blocks equal, so every link shares one of
the six pairs of equal blocks. Each shard holds the fingerprints alike in one such pair, and its trees are built
and searched there. A shard of more than ``TREE`` fingerprints is cut into trees of that size, each searched by
blocks of the whole shard in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.llm.common import LOWEST, bounded_batches, partitions, with_keys, without_keys
from feedlab.storage import checkpointed

#: Fingerprints in a tree at most, and queries that search it together.
TREE = 4096

#: Pairs of query and node that a search step looks at together.
STEP = 1 << 20


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a whole text: bit by bit, the majority over the XXH64 hashes of its word shingles."""
    own = (text or "").encode("utf-8", "replace").lower().split()
    if not own:
        return 0
    shingles = map(b" ".join, zip(*(own[k:] for k in range(words)))) if len(own) >= words else [b" ".join(own)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    total = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) >> 14)):
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, h1, h2, fp of every row: two hashes of the text, 128 bits in all, and its 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], names=["doc_id", "h1", "h2", "fp"])

    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_hashes(), text.alias("text")
                       ).mapInArrow(run, "doc_id long, h1 long, h2 long, fp long")


def _text_hashes() -> list[Column]:
    """h1, h2; a null text is not an empty one."""
    text = F.col("text").cast("string")
    return [F.xxhash64(text.isNull(), text).alias("h1"), F.xxhash64(F.lit("again"), text.isNull(), text).alias("h2")]


class BKTree:
    """A BK-tree over distinct 64-bit values, built and searched level by level over whole arrays."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        edges: list[np.ndarray] = []
        node, rest = np.zeros(max(n - 1, 0), np.int64), np.arange(1, n)
        while len(rest):  # every value still to place stands at a node; one per (node, distance) becomes its child
            key = node * 65 + np.bitwise_count(values[rest] ^ values[node])
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            edges.append(np.column_stack([key[first], rest[first]]))
            node = rest[first][group]
            stays = np.ones(len(rest), bool)
            stays[first] = False
            node, rest = node[stays], rest[stays]
        table = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
        table = table[np.argsort(table[:, 0], kind="stable")]
        self.keys, self.children = table[:, 0], table[:, 1]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) places of all pairs within the radius, in pieces of bounded size."""
        if not len(self.values):
            return
        stack = [(np.arange(len(queries)), np.zeros(len(queries), np.int64))]
        while stack:
            q, node = stack.pop()
            if len(q) > STEP:
                stack += [(q[STEP:], node[STEP:])]
                q, node = q[:STEP], node[:STEP]
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            count = high - low
            total = int(count.sum())
            if total:
                at = np.arange(total) + np.repeat(low - (np.cumsum(count) - count), count)
                stack.append((np.repeat(q, count), self.children[at]))


def forest(tree: BKTree, members: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what the search connects, at most one for each value: not all pairs within a group."""
    values, place = np.unique(np.concatenate([members, queries]), return_inverse=True)
    root = np.arange(len(values))
    links: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    own, asked = place[:len(members)], place[len(members):]
    for q, node in tree.search(queries, radius):
        a, b = asked[q], own[node]
        while True:  # joins the pairs of different roots; most pairs fall away at once
            for _ in range(64):
                up = root[root]
                if (up == root).all():
                    break
                root = up
            apart = root[a] != root[b]
            a, b = a[apart], b[apart]
            if not len(a):
                break
            _, first = np.unique(np.maximum(root[a], root[b]), return_index=True)
            for i in first.tolist():
                x, y = find(int(a[i])), find(int(b[i]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(values[a[i]]), int(values[b[i]])))
    return links


def links(values: DataFrame, radius: int = 2) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fp`` of ``values`` that connect what lies within ``radius``.

    ``radius`` is at most 2, which the four blocks are made for. Links are a spanning set: every pair within the
    radius is connected by them, but a group's pairs are not all listed.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the blocks hold for distances up to 2")
    pairs = [F.struct(F.lit(k).alias("pair"), F.xxhash64(F.lit(k), _block(i), _block(j)).alias("key"))
             for k, (i, j) in enumerate(combinations(range(4), 2))]
    dealt = values.select("fp", F.explode(F.array(*pairs)).alias("s")).select("fp", "s.key")
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / TREE).cast("int")
    member = dealt.join(shared, "key").withColumn("slot", F.pmod(F.xxhash64("fp", "key"), parts).cast("int"))
    # Slot i holds a tree; it is searched by the slots from i on, in a cell (tree, slot) of its own.
    cells = (member.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("key", F.least("slot", "other").alias("tree"), F.greatest("slot", "other").alias("ask"),
                     F.col("slot").alias("own"), "fp"))
    spread = partitions(values.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = batch.iloc[-1]
            open_cell = (batch["key"] == last["key"]) & (batch["tree"] == last["tree"]) & (batch["ask"] == last["ask"])
            held, done = batch[open_cell], batch[~open_cell]
            yield _search_cells(done, radius)
        if held is not None:
            yield _search_cells(held, radius)

    return (cells.repartition(spread, "key", "tree", "ask").sortWithinPartitions("key", "tree", "ask", "own", "fp")
            .mapInPandas(run, "a long, b long"))


def _block(k: int) -> F.Column:
    return F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))


def _search_cells(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links of whole cells; a cell is a tree and the block of fingerprints that search it."""
    if rows.empty:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    cell = rows[["key", "tree", "ask"]].to_numpy()
    cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
    fp, own, tree = rows["fp"].to_numpy().view(np.uint64), rows["own"].to_numpy(), rows["tree"].to_numpy()
    ask = rows["ask"].to_numpy()
    found: list[tuple[int, int]] = []
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(rows)]])
    two = ends - starts == 2  # most shards hold two fingerprints: compared directly
    a, b = fp[starts[two]], fp[starts[two] + 1]
    near = np.bitwise_count(a ^ b) <= radius
    found += zip(a[near].tolist(), b[near].tolist())
    for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
        members = fp[s:e][own[s:e] == tree[s]]
        queries = members if tree[s] == ask[s] else fp[s:e][own[s:e] == ask[s]]
        found += forest(BKTree(members), members, queries, radius)
    pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b) reaches.

    Every round hooks each tree of labels on the smallest label next to it and then halves the paths, so
    rounds grow with the logarithm of a component's diameter. Minima are combined before each shuffle and
    the joins are ones that Spark may split, so a node with very many links is no bottleneck.
    """
    edges = checkpointed(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct())
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    size = _sum(labels)
    for _ in range(rounds):
        # the root of each neighbour, offered to a node's own root
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("offer")), "b")
                .join(labels.select(F.col("node").alias("a"), "root"), "a"))
        offers = near.filter("offer < root").groupBy(F.col("root").alias("node")).agg(F.min("offer").alias("offer"))
        hooked = (labels.join(offers, "node", "left")
                  .select("node", F.least("root", F.coalesce("offer", "root")).alias("root")))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = checkpointed(hooked.join(up, "root").select("node", F.least("up", "root").alias("root")))
        before, size = size, _sum(labels)
        if size == before:  # roots only ever fall
            return labels
    raise RuntimeError("components did not settle")


def _sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("root").cast("decimal(20,0)"))).first()[0]


def groups(rows: DataFrame, radius: int) -> DataFrame:
    """fp, root of every distinct fingerprint: those of one component share a root."""
    distinct = rows.select("fp").distinct()
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Fingerprints within ``radius`` bits are linked; component_id is the smallest doc_id that links reach, and
    null only if all its ids are null. Null and empty texts have fingerprint zero, linked like any other;
    repeated rows are rows of the same component; further columns are ignored; no rows give no rows.
    Copies share a fingerprint and are one node, so a group of copies costs no more than one text.
    """
    rows = checkpointed(fingerprints(docs, words))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    grouped = checkpointed(groups(rows, radius).join(least, "fp"))
    component = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    known = grouped.join(component, "root").select("fp", "component_id")
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component with all its columns: the smallest doc_id (null last), of equal ids the text with the
    lowest hash, of rows alike in both any one.

    Fingerprints are made once; the rows to keep are found again by id and text hash, and rows alike in both are
    already in one task then, so texts are moved once.
    """
    rows = checkpointed(fingerprints(docs, words))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    least = rows.groupBy("fp").agg(F.min(own).alias("least"))
    first = groups(rows, radius).join(least, "fp").groupBy("root").agg(F.min("least").alias("least"))
    wanted = first.select(F.coalesce("least.doc_id", F.lit(LOWEST)).alias("_id"), F.col("least.none").alias("_none"),
                          F.col("least.h1").alias("_h1"), F.col("least.h2").alias("_h2"))
    h1, h2 = _text_hashes()
    doc_id = F.col("doc_id").cast("long")
    keyed = with_keys(docs, _id=F.coalesce(doc_id, F.lit(LOWEST)), _none=doc_id.isNull(), _h1=h1, _h2=h2)
    keys = ["_id", "_none", "_h1", "_h2"]
    kept = keyed.join(wanted, keys, "left_semi")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    return without_keys(kept.withColumn("_place", place).filter("_place = 1"), docs)
