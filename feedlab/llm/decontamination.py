"""Short test items inside long documents: MinHash containment search over partitions by size, verified exactly.

Items are put into partitions by size: with L the power of two from its number of shingles up, an item is looked
for in overlapping windows of 2 L shingles, one starting every L, so any passage as long as the item lies whole in
a window of like size and the item's containment there shows in the MinHash values. A window is a candidate
if one of its ``permutations`` minima is the item's. A minimum can only be the item's where the item's own
shingle stands, so windows are looked at around those shingles alone; the values of all others cannot agree.
Candidates are verified by the exact share of the item's shingles, as text, that the whole document holds.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedlab.llm.common import document_key, with_keys, without_keys

WORDS = 5

#: Minima of a signature. An item held to 80 % agrees with a window in each with a chance of 0.19 or more, so all
#: 96 miss it with a chance below 2e-9.
PERMUTATIONS = 96

#: Bytes of the items' side that are broadcast at most, as summed up; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20

#: Bytes of a row of ``signatures`` in memory.
PROBE_BYTES = 48

#: Besides the space.
_BLANK = "\t\n\r"


def _words(text: str) -> Column:
    clean = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    for blank in _BLANK:
        clean = F.replace(clean, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(clean, " ", -1), "")


def _shingles(words: str) -> Column:
    """Every five words in a row, as structs; all words, filled up with nulls, where there are fewer."""
    count = F.greatest(F.size(words) - (WORDS - 1), F.lit(1))
    return F.arrays_zip(*(F.slice(words, k + 1, count).alias(f"w{k}") for k in range(WORDS)))


def _parts(shingle: Column) -> list[Column]:
    return [shingle.getField(f"w{k}") for k in range(WORDS)]


def _hash(shingle: Column) -> Column:
    return F.xxhash64(*_parts(shingle))


def _text(shingle: Column) -> Column:
    return F.concat_ws(" ", *_parts(shingle))


def _value(shingle: Column, permutation: Column) -> Column:
    return F.xxhash64(shingle, permutation)


def _small(df: DataFrame, size: Column) -> DataFrame:
    """Broadcast only if the bytes of all rows (``size`` of each) are within the bound; Spark chooses the join otherwise."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def _items(benchmark: DataFrame) -> DataFrame:
    """item, item_id, n, texts, shingles: distinct rows of the benchmark that have any word."""
    return (benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct()
            .select(F.xxhash64("item_id", "text").alias("item"), "item_id", _words("text").alias("w"))
            .select("item", "item_id", F.array_distinct(F.transform(_shingles("w"), _text)).alias("texts"),
                    F.array_distinct(F.transform(_shingles("w"), _hash)).alias("shingles"))
            .withColumn("n", F.size("texts")).filter("n > 0"))


def signatures(items: DataFrame) -> DataFrame:
    """shingle, item, length, i, v: a row for each minimum of an item, by the shingle it is taken at."""
    length = F.pow(F.lit(2), F.ceil(F.log2(F.col("n")))).cast("int")
    single = (items.select("item", length.alias("length"), F.explode("shingles").alias("shingle"))
              .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(PERMUTATIONS - 1)))))
    least = single.groupBy("item", "length", "i").agg(
        F.min(F.struct(_value(F.col("shingle"), F.col("i")).alias("v"), "shingle")).alias("m"))
    return least.select(F.col("m.shingle").alias("shingle"), "item", "length", "i", F.col("m.v").alias("v"))


def candidates(docs: DataFrame, probes: DataFrame) -> DataFrame:
    """_id, _hash, doc_id, w, item: documents and the items that one of their windows agrees with in a minimum.

    Item is null in rows of documents that only share shingles with items. No filter stands on what the
    windows give, as the optimizer would move it, with all it is made of, below the join.
    """
    rows = docs.select(*document_key(), "doc_id", "text")
    every = rows.withColumn("w", _words("text")).select("_id", "_hash", F.posexplode(_shingles("w")).alias("at", "s"))
    every = every.select("_id", "_hash", "at", _hash(F.col("s")).alias("shingle"))
    # a set, so that repeated rows gather the hits of one; as many as the text's own places and minima there
    hits = (every.join(_small(probes, F.lit(PROBE_BYTES)), "shingle").groupBy("_id", "_hash")
            .agg(F.collect_set(F.struct("item", "length", "i", "v", "at")).alias("hits")))
    known = rows.join(hits, ["_id", "_hash"]).withColumn("w", _words("text")).withColumn("shingles", F.transform(_shingles("w"), _hash))

    def least(p: Column, window: Column) -> Column:
        own = F.slice("shingles", F.greatest(window, F.lit(0)) * p["length"] + 1, 2 * p["length"])
        return F.array_min(F.transform(own, lambda s: _value(s, p["i"])))

    def agrees(p: Column) -> Column:
        window = F.floor(p["at"] / p["length"]).cast("int")
        return (least(p, window) == p["v"]) | (least(p, window - 1) == p["v"])

    found = F.array_distinct(F.transform(F.filter("hits", agrees), lambda p: p["item"]))
    return known.select("_id", "_hash", "doc_id", "w", F.explode_outer(found).alias("item"))


def _verified(docs: DataFrame, benchmark: DataFrame, share: float) -> DataFrame:
    items = _items(benchmark)
    held = F.aggregate("texts", F.lit(64).cast("long"), lambda total, t: total + F.octet_length(t) + 16)
    near = (candidates(docs, signatures(items)).join(_small(items.select("item", "item_id", "n", "texts"), held), "item")
            .withColumn("own", F.transform(_shingles("w"), _text)))
    shared = F.size(F.array_intersect("own", "texts"))
    found = near.select("_id", "_hash", "doc_id", "item_id", F.col("n").cast("long").alias("n_shingles"),
                        F.explode_outer(F.array(shared.cast("long"))).alias("n_shared"))
    return found.filter(F.col("n_shared") >= share * F.col("n_shingles"))


def contained(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment of every item that a document holds to ``share`` or more.

    Shingles are five words of the lower-cased text; a text of fewer words is one shingle, so such an item is
    found only in a document of those words alone. Null and empty texts hold nothing and are held by nothing;
    a repeated document is found each time, a repeated item once; null ids are carried along; further columns
    are ignored; empty tables give no rows. A passage that very many documents hold costs some rows for each.
    """
    return _verified(docs, benchmark, share).select(
        "doc_id", "item_id", "n_shingles", "n_shared",
        F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item to ``share`` or more."""
    leaks = _verified(docs, benchmark, share).select("_id", "_hash").distinct()
    return without_keys(with_keys(docs).join(leaks, ["_id", "_hash"], "left_anti"), docs)
