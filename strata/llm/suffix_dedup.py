"""Repeated passages by sparse suffix arrays (operator 3).

Suffixes start at words. Only those at minimiser positions are retained: positions whose
ANCHOR_WORDS-word window has the least hash among WINDOW consecutive positions. Every passage of
``min_words`` holds one among its first WINDOW positions, whatever surrounds it, so two copies of
a passage retain the same suffix. The retained suffixes are sorted by their next words (as a hash,
so equal prefixes are neighbours) and neighbours compared; where they agree on what every copy of a
long passage shares, the match is extended left and right: each passage of exactly ``min_words``
that holds the position is sorted and compared in the same way, and those found twice are merged
into maximal spans.

Sorting deals rows out by (prefix, document, position), so a passage in a third of all documents
is spread over many tasks; runs that reach over a task's edge are settled by each task's first and last row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import picked, written
from strata.llm.words import long_windows, windows, word_slices

MIN_WORDS = 50
ANCHOR_WORDS = 5
WINDOW = 30


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (the first of equals) among each ``width`` consecutive ones."""
    best = np.arange(len(values))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        other = best[step:]
        here = best[: len(other)]
        best = np.where(values[other] < values[here], other, here)
        reach += step
    return best


def minimisers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start of WINDOW positions the minimiser's place, in one text.

    Returns the retained places and, for each, the first start it is the minimiser of.
    """
    anchors = windows(hashes, ANCHOR_WORDS)
    if len(anchors) < WINDOW:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    places, first = np.unique(_least_ahead(anchors, WINDOW), return_index=True)
    return places, first


def _owned_starts(hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Retained places that passages of ``min_words`` have, with the starts of those passages.

    Passage start s belongs to the minimiser of positions s .. s + WINDOW - 1. Places ascend with
    the starts, so each owns the starts first .. last.
    """
    places, first = minimisers(hashes)
    last = np.append(first[1:], len(hashes) - ANCHOR_WORDS + 1 - WINDOW + 1) - 1
    last = np.minimum(last, len(hashes) - min_words)
    good = (first <= last) & (len(hashes) >= min_words)
    return places[good], first[good], last[good]


def _retained(min_words: int):
    """Suffix rows of each text: place, owned starts, prefix hash."""
    prefix = min_words - WINDOW + 1  # words right of the place that each owned passage holds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_slices(batch.column(1)):
                ahead = long_windows(words.hashes, prefix)
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                for i in range(len(words)):
                    a, b = words.first[i], words.first[i + 1]
                    places, first, last = _owned_starts(words.hashes[a:b], min_words)
                    for column, values in zip(out, (np.full(len(places), i), ahead[a + places], places, first, last)):
                        column.append(values)
                rows, prefixes, *rest = (np.concatenate(c) for c in out)
                ids = batch.column(0).slice(words.lo, len(words)).take(pa.array(rows.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(prefixes.view(np.int64)), *(pa.array(c.astype(np.int32)) for c in rest)],
                    names=["k", "h", "at", "lo", "hi"],
                )

    return run


def _passages(min_words: int):
    """Passage rows of each text, for the starts that its repeated suffixes own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            for words in word_slices(batch.column(1)):
                whole = long_windows(words.hashes, min_words)
                rows, starts = [], []
                for i in range(len(words)):
                    for span in spans[words.lo + i].as_py():
                        at = np.arange(span["lo"], span["hi"] + 1)
                        starts.append(at)
                        rows.append(np.full(len(at), i))
                if not rows:
                    continue
                rows, starts = np.concatenate(rows), np.concatenate(starts)
                ids = batch.column(0).slice(words.lo, len(words)).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(whole[words.first[rows] + starts].view(np.int64)),
                        pa.array(starts.astype(np.int32)),
                    ],
                    names=["k", "h", "at"],
                )

    return run


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks the rows of one sorted task.

    ``run``: 0 alone, 1 the first of a run of equal hashes, 2 a later one. ``edge``: the task's
    first and last row, whose runs may go on in other tasks.
    """
    part = TaskContext.get().partitionId()
    held, before = None, None

    def marked(batch: pa.RecordBatch, before: int | None, after: int | None) -> pa.RecordBatch:
        h = batch.column(1).to_numpy()
        same = h[1:] == h[:-1]
        up = np.concatenate([[before is not None and h[0] == before], same])
        down = np.concatenate([same, [after is not None and h[-1] == after]])
        edge = np.zeros(len(h), dtype=bool)
        edge[0], edge[-1] = before is None, after is None or (len(h) == 1 and before is None)
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.where(up, 2, np.where(down, 1, 0)).astype(np.int32)),
                pa.array(edge),
                pa.array(np.full(len(h), part, np.int32)),
            ],
            names=[*batch.schema.names, "run", "edge", "part"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield marked(held, before, batch.column(1)[0].as_py())
            before = held.column(1)[held.num_rows - 1].as_py()
        held = batch
    if held is not None:
        yield marked(held, before, None)


def sorted_runs(rows: DataFrame) -> DataFrame:
    """Sorts rows (k, h, at, ...) by hash and compares neighbours over all tasks.

    Adds ``repeated``, whether another row has the hash, and ``first``, whether the row is the
    first of its hash by (k, at). ``rows`` should be a written table: dealing by range reads it
    twice.
    """
    dealt = rows.repartitionByRange("h", "k", "at").sortWithinPartitions("h", "k", "at")
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    runs = written(
        dealt.mapInArrow(_compare_neighbours, f"{kinds}, run int, edge boolean, part int"), "suffix-runs"
    )
    # Two rows of each task at most.
    ends = runs.filter("edge").select("h", "part", F.struct("k", "at").alias("place"))
    ends = ends.groupBy("h").agg(F.countDistinct("part").alias("tasks"), F.min("place").alias("least"))
    settled = runs.filter("edge").join(ends, "h").select(
        *runs.columns,
        ((F.col("tasks") > 1) | (F.col("run") > 0)).alias("repeated"),
        ((F.col("k") == F.col("least.k")) & (F.col("at") == F.col("least.at"))).alias("first"),
    )
    inner = runs.filter("not edge").select("*", (F.col("run") > 0).alias("repeated"), (F.col("run") < 2).alias("first"))
    return inner.unionByName(settled).drop("run", "edge", "part")


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Passages of ``min_words`` or more words that stand at more than one place of ``docs``.

    Two tables: ``spans`` has for each document the maximal spans of words whose passages of
    ``min_words`` words stand elsewhere too (``key``, ``start``, ``n_words``), ``later`` those
    covered by passages that stand earlier as well, by (key, place). Words are runs of bytes other
    than ASCII white space and are compared without regard to A-Z case.

    A null or empty text, and one of fewer words, has no spans. A row with a null key takes no
    part. Rows that repeat a key are one document, that of one of them (its own passages aren't
    repeated by that). ``min_words`` below WINDOW + ANCHOR_WORDS isn't served.
    """
    if min_words < WINDOW + ANCHOR_WORDS:
        raise ValueError(f"min_words has to be {WINDOW + ANCHOR_WORDS} at least")
    named = picked(docs, {"k": key, "t": text}).filter("k IS NOT NULL AND t IS NOT NULL")
    suffixes = named.mapInArrow(_retained(min_words), "k long, h long, at int, lo int, hi int")
    found = sorted_runs(written(suffixes, "suffixes")).filter("repeated")
    owned = found.groupBy("k").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # of one text
    chosen = named.join(owned, "k").dropDuplicates(["k"]).select("k", "t", "spans")
    passages = chosen.mapInArrow(_passages(min_words), "k long, h long, at int")
    twice = written(sorted_runs(written(passages, "passages")).filter("repeated").drop("h"), "repeats")
    return _merged(twice, min_words, key), _merged(twice.filter("not first"), min_words, key)


def _merged(passages: DataFrame, min_words: int, key: str) -> DataFrame:
    """Overlapping or adjoining passages of a document as maximal spans."""
    starts = passages.groupBy("k").agg(F.collect_set("at").alias("starts"))  # of one text
    return starts.mapInArrow(_spans(min_words), "k long, start int, n_words int").withColumnRenamed("k", key)


def _spans(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, sizes = [], [], []
            for k, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = np.sort(found.values.to_numpy())
                new = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1] + min_words]))
                last = np.concatenate([new[1:], [len(at)]]) - 1
                ids += [k] * len(new)
                starts.append(at[new])
                sizes.append(at[last] + min_words - at[new])
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(np.concatenate(starts).astype(np.int32)),
                        pa.array(np.concatenate(sizes).astype(np.int32)),
                    ],
                    names=["k", "start", "n_words"],
                )

    return run


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their spans (start and number of words, in pairs)."""
    out = texts.to_list()
    for i, found in enumerate(spans):
        if found is not None:
            out[i] = _without(out[i], np.asarray(found).reshape(-1, 2))
    return pd.Series(out, dtype=object)


def _without(text: str, spans: np.ndarray) -> str:
    """The text with the words of ``spans`` and the white space before them cut out."""
    words = next(word_slices(pa.array([text])))
    data, kept, place = text.encode(), [], 0
    for start, n in spans[np.argsort(spans[:, 0])]:
        if start + n > len(words.starts):  # spans of another row with this key
            return text
        kept.append(data[place : words.ends[start - 1] if start else 0])
        place = words.ends[start + n - 1]
    return b"".join([*kept, data[place:]]).decode()


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each passage that stands earlier too cut out of the text; all rows stay.

    Columns and their order stay; a text cut wholly is empty. Rows that repeat a key should have
    one text: a cut that doesn't fit a row's text isn't made.
    """
    _, later = repeated_passages(docs, min_words, key, text)
    pair = F.array("start", "n_words")
    spans = later.groupBy(F.col(key).alias("_k")).agg(F.flatten(F.collect_list(pair)).alias("_spans"))  # of one text
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    joined = docs.select(F.col(f"`{key}`").alias("_k"), whole).join(spans, "_k", "left")
    cut = joined.withColumn("_t", _cut(F.col(f"row.`{text}`"), F.col("_spans")))
    return cut.select(*(F.col("_t").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns))


def with_length(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``n_chars`` anew from the text (null for a null text), the columns in their order."""
    size = F.length(F.col(f"`{text}`")).cast("long").alias(n_chars)
    return docs.select(*(size if c == n_chars else F.col(f"`{c}`") for c in docs.columns))
