"""Near-duplicates by circulant MinHash (operator 7).

One pass hashes every whole text: its word sequence, its set of five-word shingles and the
signature. A signature needs two permutations only: the first scatters the shingles over a circle
of 2^32 places, the second, shifted by one place for each coordinate, orders them. Bands of the
signature name candidate pairs; each is confirmed on the full sets.

Texts with equal word sequences are one class and enter the search once. Within a bucket no set
of all pairs is made: members are compared with the bucket's pivot, the member that shares most
buckets, and only buckets that then still hold several components go on. There, members whose
shingles are too often theirs alone to be similar to any other are left out (an exact bound), and
the rest is compared with more and more pivots across components, until every pair that may be
linked is compared or in one component. So no link between components is lost but those no band
brings together (4e-7 of the pairs at the threshold itself, fewer above).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import picked, rows_without, written
from strata.llm.components import connected
from strata.llm.words import lists, mix, sequence_hashes, shingles, word_slices

SHINGLE_WORDS = 5
BANDS = 20
BAND_ROWS = 4
# About so many pivots of a bucket in the first round across components, times as many in the next.
PIVOT_GROWTH = 8
_LONG_MAX = (1 << 63) - 1


def _fmix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash: one row of ``size`` coordinates for each (not empty) set.

    Coordinate k is the least of pi(sigma(x) - k) over the set.
    """
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    sigma = _fmix32((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32))
    out = np.empty((len(sets), size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_fmix32((sigma - np.uint32(k)) ^ np.uint32(0x3C6EF372)), starts)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket for each band; different bands have different buckets."""
    out = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0xD1342543DE82EF95) + signature[:, b * rows + r])
        out[:, b] = key
    return out


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch.column(1)):
            sets = shingles(words, SHINGLE_WORDS)
            one, two = sequence_hashes(words)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = [np.zeros(0, dtype=np.uint64)] * len(sets)
            if full:
                found = band_keys(signatures([sets[i] for i in full], BANDS * BAND_ROWS), BANDS, BAND_ROWS)
                for i, row in zip(full, found):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(words.lo, len(words)),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array(np.array([len(s) for s in sets], dtype=np.int64)),
                    lists(keys),
                ],
                names=["key", "one", "two", "n", "buckets"],
            )


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch.column(0)):
            one, two = (pa.array(x.view(np.int64)) for x in sequence_hashes(words))
            yield pa.RecordBatch.from_arrays([one, two, lists(shingles(words, SHINGLE_WORDS))], names=["one", "two", "shingles"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("k").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("k").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), both.alias("both"))
        .filter(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both")))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more are linked;
    ``component_id`` is the smallest key reachable over links, ``kept`` whether it is the row's own.
    A null or empty text, or one of white space alone, has no shingles and is linked with nothing.
    Rows that repeat a key are linked, whatever their texts, so all of them are kept or none. A row
    with a null key takes no part: its component is null and it is kept. Equal texts are always
    linked. Keys are whole numbers.

    What is searched are texts, not keys: a node is a text's 63-bit hash, ``k`` from here on.
    """
    hashed = picked(docs, {"key": key, "t": text}).mapInArrow(
        _hash_texts, "key long, one long, two long, n long, buckets array<long>"
    )
    node = F.xxhash64("one", "two").bitwiseAND(F.lit(_LONG_MAX)).alias("k")
    hashed = written(hashed.select("key", node, "n", "buckets"), "minhash")
    live = F.col("key").isNotNull() & (F.col("n") > 0)
    heads = hashed.filter(live).groupBy("k").agg(
        F.min("key").alias("rep"), F.first("n").alias("n"), F.first("buckets").alias("buckets")
    )
    heads = written(heads, "minhash-texts")
    same_key = _texts_of_one_key(hashed.filter(live))

    each = heads.select("k", "n", F.explode("buckets").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    inside = written(each.join(shared, "bucket"), "minhash-buckets")
    weight = inside.groupBy("k").agg(F.sum("size").alias("weight"))
    inside = written(inside.join(weight, "k"), "minhash-weights")

    wanted = heads.join(weight.select("k"), "k", "left_semi")
    texts = picked(docs, {"key": key, "t": text}).join(wanted.select(F.col("rep").alias("key")).distinct(), "key", "left_semi")
    sets = texts.select("t").mapInArrow(_shingle_sets, "one long, two long, shingles array<long>").select(node, "shingles")
    sets = written(sets.join(wanted.select("k"), "k", "left_semi").dropDuplicates(["k"]), "minhash-sets")

    # The pivot: the heaviest member, then the smallest key.
    first = F.max(F.struct(F.col("weight"), -F.col("k"), F.col("n"))).alias("p")
    pivots = inside.groupBy("bucket").agg(first)
    pivots = pivots.select("bucket", (-F.col("p.col2")).alias("b"), F.col("p.n").alias("nb"))
    links = _compared(inside, pivots, sets, percent).unionByName(same_key)
    links = written(links, "minhash-links")
    roots = written(connected(links), "minhash-roots")
    width, known = PIVOT_GROWTH, False
    while True:
        # Only buckets whose members are still in several components can hold a missing link.
        named = inside.join(roots.withColumnRenamed("node", "k"), "k", "left")
        named = named.withColumn("root", F.coalesce("root", "k"))
        mixed = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        left = written(named.join(mixed.select("bucket"), "bucket"), "minhash-mixed")
        if not known:
            left = written(_with_overlaps(left, pivots.select("bucket", "b"), sets), "minhash-overlaps")
            inside, known = left.drop("root"), True
        left = written(_open_members(left, percent), "minhash-open")
        most = left.agg(F.max("size")).first()[0]
        if most is None:
            break
        spread = F.greatest(F.floor(F.col("size") / width), F.lit(1))
        chosen = left.filter(F.pmod(F.xxhash64("k", "bucket"), spread) == 0)
        found = written(_confirmed(_possible(left, chosen, percent), sets, percent), "minhash-links")
        stars = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = written(connected(stars.unionByName(found)), "minhash-roots")
        if width >= most:
            break
        width *= PIVOT_GROWTH

    named = heads.select("k", "rep").join(roots.withColumnRenamed("node", "k"), "k", "left")
    named = written(named.select("k", "rep", F.coalesce("root", "k").alias("root")), "minhash-named")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("k", "component_id")
    found = hashed.filter(live).select("key", "n", "k").join(named, "k").select("key", "n", "component_id")
    alone = hashed.filter(~live | F.col("key").isNull()).select("key", "n", F.col("key").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _texts_of_one_key(hashed: DataFrame) -> DataFrame:
    """Links (a, b) between the texts of each key that stands at several."""
    several = hashed.groupBy("key").agg(F.min("k").alias("b"), F.max("k").alias("most")).filter("b < most")
    pairs = hashed.select("key", F.col("k").alias("a")).join(several.select("key", "b"), "key")
    return pairs.filter("a <> b").select("a", "b").distinct()


def _compared(inside: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of buckets and the bucket's one pivot."""
    near = 100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")
    pairs = inside.join(pivots, "bucket").filter((F.col("k") != F.col("b")) & near)
    return _confirmed(_ordered(pairs), sets, percent)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("k", "b").alias("a"), F.least("k", "b").alias("b")).distinct()


def _with_overlaps(left: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds to each member ``i``, the shingles it shares with its bucket's pivot, and ``e``, those
    beyond the pivot's that any other text of ``left`` has too.

    Two members share at most the smaller ``i`` and the smaller ``e``, which bounds their
    similarity; a shingle no other text has can't be shared.
    """
    mine = sets.join(left.select("k").distinct(), "k", "left_semi")
    each = mine.select("k", F.explode("shingles").alias("s"))
    alone = each.groupBy("s").agg(F.count("*").alias("times"), F.min("k").alias("k")).filter("times = 1")
    alone = alone.groupBy("k").agg(F.count("*").alias("u"))
    placed = left.join(pivots, "bucket").join(alone, "k", "left")
    pairs = placed.select("k", "b").distinct()
    shared = pairs.join(sets.select("k", F.col("shingles").alias("x")), "k").join(
        sets.select(F.col("k").alias("b"), F.col("shingles").alias("y")), "b"
    )
    shared = shared.select("k", "b", F.size(F.array_intersect("x", "y")).alias("i"))
    whole = placed.join(shared, ["k", "b"]).withColumn("e", F.col("n") - F.coalesce("u", F.lit(0)) - F.col("i"))
    # For the pivot itself i is its whole set, and nothing lies beyond.
    return whole.withColumn("e", F.greatest("e", F.lit(0))).drop("b", "u")


def _may_link(percent: int):
    """Whether sets of n and nb shingles with overlaps i, e and ib, eb can be similar enough."""
    both = F.least(F.least("i", "ib") + F.least("e", "eb"), F.col("n"), F.col("nb"))
    return 100 * both >= percent * (F.col("n") + F.col("nb") - both)


def _open_members(left: DataFrame, percent: int) -> DataFrame:
    """Members that may still have a link into another component in their bucket.

    They are held against the bucket's distinct (component, set size, overlaps) only.
    """
    kinds = left.select(
        "bucket",
        F.col("root").alias("root_b"),
        F.col("n").alias("nb"),
        F.col("i").alias("ib"),
        F.col("e").alias("eb"),
    ).distinct()
    other = (left["bucket"] == kinds["bucket"]) & (F.col("root") != F.col("root_b")) & _may_link(percent)
    return left.join(kinds, other, "left_semi")


def _possible(left: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Pairs of members and pivots of a bucket, in different components, that may be linked.

    A pair that shares several of the open buckets is looked at in the least of them only.
    """
    of_text = left.groupBy("k").agg(F.collect_set("bucket").alias("all"))  # BANDS at most
    left, chosen = left.join(of_text, "k"), chosen.join(of_text, "k")
    pivots = chosen.select(
        F.col("all").alias("all_b"),
        F.col("bucket").alias("bucket_b"),
        F.col("k").alias("b"),
        F.col("root").alias("root_b"),
        F.col("n").alias("nb"),
        F.col("i").alias("ib"),
        F.col("e").alias("eb"),
    )
    other = (F.col("bucket") == F.col("bucket_b")) & (F.col("root") != F.col("root_b")) & _may_link(percent)
    other = other & (F.array_min(F.array_intersect("all", "all_b")) == F.col("bucket"))
    return _ordered(left.join(pivots, other))


def keep_one(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component, and those linked with nothing."""
    return rows_without(docs, key, near_duplicates(docs, percent, key, text).filter(~F.col("kept")).select(key))
