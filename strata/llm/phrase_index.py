"""Benchmark decontamination over a positional inverted index (operator 6).

The index stores, for the terms the test items use, in which training document and at which word
they stand. A phrase is found by intersecting postings: the rarest term of each test window gives
alignments (item, document, document position less item position), the second rarest term's
postings have to give the same ones, and what is left is compared word by word with the document.
Only DataFrame functions run here, no Python.

Only the test vocabulary is broadcast, and only if its count is under BROADCAST_TERMS.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked, rows_without, written

WINDOW_WORDS = 13
# A vocabulary of up to so many counted terms is broadcast; a larger one is joined by shuffle.
BROADCAST_TERMS = 500_000
# What separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(word: Column) -> Column:
    """A-Z lower-cased, other letters as they are; plain ASCII takes the fast way."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower())
    )


def _split(texts: DataFrame, *more: str) -> DataFrame:
    """(k, t) to (k, w, skip): the words as they stand, perhaps with an empty first or last one."""
    parts = texts.select("k", *more, F.split(F.coalesce("t", F.lit("")), SEPARATORS).alias("w"))
    return parts.withColumn("skip", F.when(F.col("w")[0] == "", 1).otherwise(0))


def _n_words(split: DataFrame, *more: str) -> DataFrame:
    last = F.when((F.size("w") > 1) & (F.element_at("w", -1) == ""), 1).otherwise(0)
    return split.select("k", *more, (F.size("w") - F.col("skip") - last).cast("long").alias("n_words"))


def terms_at(texts: DataFrame) -> DataFrame:
    """(k, t) to one row (k, at, term) for each word, counted from 0."""
    rows = _split(texts).select("k", "skip", F.posexplode("w").alias("at", "word"))
    return rows.filter("word <> ''").select("k", (F.col("at") - F.col("skip")).alias("at"), lower_az(F.col("word")).alias("term"))


@dataclass
class PhraseIndex:
    """Postings (term, k, at) of the training texts for the terms of the test items (item, at, term)."""

    postings: DataFrame
    items: DataFrame


def build_index(docs: DataFrame, tests: DataFrame) -> PhraseIndex:
    """``docs`` and ``tests`` have the columns k and t. One pass over the training texts."""
    items = written(terms_at(tests.filter("k IS NOT NULL")).withColumnRenamed("k", "item"), "test-terms")
    vocabulary = items.select("term").distinct()
    postings = _of_terms(terms_at(docs.filter("k IS NOT NULL")), vocabulary).select("term", "k", "at")
    return PhraseIndex(written(postings, "postings"), items)


def _of_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of some (distinct) terms. A counted, small set of terms moves to the postings."""
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    return postings.join(terms, "term", "left_semi")


def _test_windows(items: DataFrame, size: int) -> DataFrame:
    """(item, start, n): windows of ``size`` consecutive words; shorter items are one window."""
    lengths = items.groupBy("item").agg(F.count("*").cast("int").alias("words"))
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("words") - size, F.lit(0)))).alias("start")
    return lengths.select("item", starts, F.least("words", F.lit(size)).alias("n"))


def rarest_terms(index: PhraseIndex, size: int, most: int = 2) -> DataFrame:
    """Per test window its ``most`` rarest words: (item, start, n, rank, at, term).

    Windows with a word that no training text has can't occur and are left out.
    """
    frequency = index.postings.groupBy("term").agg(F.count("*").alias("df"))
    counted = index.items.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    windows = _test_windows(index.items, size)
    inside = windows.join(counted, "item").filter("at >= start AND at < start + n")
    window = Window.partitionBy("item", "start")
    ranked = inside.withColumns(
        {
            "least": F.min("df").over(window),
            "rank": F.row_number().over(window.orderBy("df", "term", "at")),
        }
    )
    return ranked.filter((F.col("least") > 0) & (F.col("rank") <= most)).drop("least", "df")


def _alignments(index: PhraseIndex, size: int) -> DataFrame:
    """(item, k, shift) on which the two rarest terms of some window meet."""
    anchors = written(rarest_terms(index, size), "anchors")
    one = anchors.filter("rank = 1").select("item", "start", "n", "at", "term")
    two = anchors.filter("rank = 2").select("item", "start", F.col("at").alias("at2"), F.col("term").alias("term2"))
    pairs = one.join(two, ["item", "start"], "left").withColumn("apart", F.col("at2") - F.col("at"))
    # Windows that share both anchors ask for the same alignments.
    asked = pairs.select("item", "at", "term", "term2", "apart").distinct()
    terms = asked.select("term").unionByName(asked.filter("term2 IS NOT NULL").select(F.col("term2").alias("term")))
    postings = written(_of_terms(index.postings, terms.distinct()), "anchor-postings")
    first = postings.withColumnRenamed("at", "place").join(asked, "term")
    first = first.select("item", "k", "term2", (F.col("place") + F.col("apart")).alias("place2"), (F.col("place") - F.col("at")).alias("shift"))
    single = first.filter("term2 IS NULL")  # items of one word
    second = postings.select(F.col("term").alias("term2"), "k", F.col("at").alias("place2"))
    met = first.join(second, ["term2", "k", "place2"], "left_semi")
    return single.select("item", "k", "shift").unionByName(met.select("item", "k", "shift")).distinct()


def exact_matches(index: PhraseIndex, docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(k, item, at, n): where a window of an item stands in a document, each once.

    Documents with alignments are read once more, and their words compared along each alignment;
    runs of equal words as long as a window are matches.
    """
    lined = written(_alignments(index, size), "alignments")
    items = index.items.groupBy("item").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "term"))), lambda x: x["term"]).alias("words")
    )
    wanted = lined.select("k").distinct()
    texts = terms_at(docs.join(wanted, "k", "left_semi"))
    # The words of a document that an item's alignment covers.
    spans = lined.join(items.select("item", F.size("words").alias("m")), "item")
    asked = spans.select("item", "k", "shift", "m", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i"))
    asked = asked.join(index.items.select("item", F.col("at").alias("i"), "term"), ["item", "i"])
    asked = asked.select("item", "k", "shift", "m", "i", (F.col("i") + F.col("shift")).alias("at"), "term")
    equal = asked.join(texts, ["k", "at", "term"]).select("item", "k", "shift", "m", "i").distinct()
    run = Window.partitionBy("item", "k", "shift").orderBy("i")
    n = F.least("m", F.lit(size))
    # Word i is the last of n equal ones if the n-1 words before it are equal too.
    ahead = equal.withColumn("i0", F.lag("i", size - 1).over(run)).withColumn("place", F.row_number().over(run))
    whole = (F.col("m") >= size) & (F.col("i0") == F.col("i") - size + 1)
    short = (F.col("m") < size) & (F.col("place") == F.col("m"))
    found = ahead.filter(whole | short)
    return found.select("k", "item", (F.col("shift") + F.col("i") - n + 1).alias("at"), n.alias("n")).distinct()


def proximity_matches(index: PhraseIndex, slop: int, size: int = WINDOW_WORDS, terms: int = 3) -> DataFrame:
    """(k, item, start, at): windows whose rarest ``terms`` words stand near each other.

    Each of them has to stand in the document within ``slop`` words of where the window, laid
    over an occurrence ``at`` of its rarest word, would have it. ``slop`` 0 asks for exact places.
    """
    anchors = written(rarest_terms(index, size, terms), "near-anchors")
    postings = index.postings
    first = anchors.filter("rank = 1").select("item", "start", F.col("at").alias("at1"), "term")
    lined = postings.withColumnRenamed("at", "place").join(first, "term")
    lined = lined.select("k", "item", "start", (F.col("place") - F.col("at1")).alias("shift"))
    rest = anchors.filter("rank > 1").select("item", "start", "rank", "at", "term")
    need = rest.groupBy("item", "start").agg(F.count("*").alias("need"))
    asked = lined.join(rest, ["item", "start"]).select(
        "k", "item", "start", "shift", "rank", "term",
        F.explode(F.sequence(F.col("shift") + F.col("at") - slop, F.col("shift") + F.col("at") + slop)).alias("at"),
    )
    met = asked.join(postings, ["term", "k", "at"], "left_semi").groupBy("k", "item", "start", "shift")
    met = met.agg(F.countDistinct("rank").alias("met"))
    near = lined.join(need, ["item", "start"], "left").join(met, ["k", "item", "start", "shift"], "left")
    near = near.filter(F.coalesce("met", F.lit(0)) == F.coalesce("need", F.lit(0)))
    return near.select("k", "item", "start", F.col("shift").alias("at")).distinct()


def contamination(
    docs: DataFrame,
    tests: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW_WORDS,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    Words are runs of digits, ASCII letters (A-Z as a-z) and characters beyond ASCII. A document's
    word inside any occurrence of a test window is hit; a document is contaminated if one word in
    twenty or more is hit. Null and empty texts have no words; items without words have no window.
    The hash is of the ids of the items found, as text, sorted and joined by commas (of the empty
    text if none). Items with a null id are left out, rows of ``docs`` with a null key match
    nothing. Each row is judged by its own text, whatever other rows have its key.
    """
    # A document is known by a hash of its key and text.
    identity = F.when(F.col("key").isNotNull(), F.xxhash64("key", "t")).alias("k")
    docs = picked(docs, {"key": key, "t": text}).select("key", "t", identity)
    index = build_index(docs, picked(tests, {"k": item, "t": item_text}))
    found = written(exact_matches(index, docs, size), "matches")
    lengths = _n_words(_split(docs, "key"), "key")
    # Words covered: each match adds its length less the overlap with the ones before it.
    by_end = found.groupBy("k", "at").agg(F.max("n").alias("n"))
    before = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("at") + F.col("n")).over(before), F.lit(0))
    new = by_end.withColumn("new", F.greatest(F.col("at") + F.col("n") - F.greatest("at", reach), F.lit(0)))
    hits = new.groupBy("k").agg(F.sum("new").alias("n_hit"))
    ids = F.array_sort(F.collect_set(F.col("item").cast("string")))
    items = found.groupBy("k").agg(ids.alias("ids"))
    both = hits.join(items, "k")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return lengths.join(both, "k", "left").select(
        F.col("key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key has no contaminated text."""
    return rows_without(docs, key, contamination(docs, tests, key, text).filter("contaminated").select(key))
