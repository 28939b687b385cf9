"""Language identification by rank-order profiles (operator 1).

A language's profile is the list of its PROFILE most frequent n-grams (1 to 3 characters, words
padded with blanks) over all its training texts, a document's the same over its whole text. The
distance is how far each of the document's n-grams is out of place in the language's list, an
n-gram that is missing there being PROFILE places out; the nearest language is predicted. Counting
is exact: three code points fit a 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked

PROFILE = 400
# The profiles go to every task: PROFILE rows of 12 bytes a language. More languages are refused.
MOST_LANGUAGES = 10_000
UNKNOWN = "und"

_BITS = np.int64(21)  # a code point
_BLANK = np.int64(32)
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
TRAIN_BATCH = 512


def n_grams(text: str) -> np.ndarray:
    """All n-grams of a text's words as numbers, in no order; a blank stands only at an end."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return np.zeros(0, np.int64)
    spaced = f" {words} "
    c = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate([c[c != _BLANK], two, three[c[1:-1] != _BLANK]])


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([np.ones(min(len(grams), 1), bool), grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties in the order of their code points."""
    return grams[np.lexsort((grams, -counts))[:size]]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TRAIN_BATCH):
            texts: dict[str, list[str]] = {}
            for lang, text in zip(*(batch.column(i).slice(at, TRAIN_BATCH).to_pylist() for i in (0, 1))):
                texts.setdefault(lang, []).append(text)
            for lang, found in texts.items():
                grams, counts = counted(np.concatenate([n_grams(t) for t in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The profile of each language over all of ``docs`` that have a text and a language.

    Counts are summed in the tasks, then by Spark; only profiles reach the driver.
    """
    known = picked(docs, {"lang": lang, "t": text}).filter("lang IS NOT NULL AND t IS NOT NULL")
    counts = known.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= PROFILE).drop("n")
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top.toLocalIterator():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
        if len(profiles) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {name: np.array([g for _, g in sorted(rows)], np.int64) for name, rows in sorted(profiles.items())}


class Distances:
    """Out-of-place distances of one document to all profiles."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = list(profiles)
        self.grams = np.unique(np.concatenate([*profiles.values(), np.zeros(1, np.int64)]))
        # rank of each known n-gram in each profile, PROFILE where it is missing; so for n-gram 0
        self.ranks = np.full((len(self.names), len(self.grams)), PROFILE, np.int64)
        self.absent = np.ones(self.ranks.shape, bool)
        for i, name in enumerate(self.names):
            at = np.searchsorted(self.grams, profiles[name])
            self.ranks[i, at] = np.arange(len(at))
            self.absent[i, at] = False

    def of(self, profile: np.ndarray) -> np.ndarray:
        """Mean distance to each language, from 0 (same list) to 1 (nothing in common)."""
        at = np.minimum(np.searchsorted(self.grams, profile), len(self.grams) - 1)
        at = np.where(self.grams[at] == profile, at, 0)
        out = np.abs(self.ranks[:, at] - np.arange(len(profile)))
        out = np.where(self.absent[:, at], PROFILE, out)
        return out.sum(axis=1) / (PROFILE * len(profile))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0
        distances = self.of(ranked(*counted(n_grams(text))))
        best = int(np.argmin(distances))  # of equals the first name
        return self.names[best], float(1.0 - distances[best])


def _predict(profiles: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = Distances(profiles)
        for batch in batches:
            found = [distances.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["k", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5) -> DataFrame:
    """Per row of ``docs``: ``key``, ``held_out``, ``lang_pred`` and ``score``.

    Rows whose crc32 of the key as text is 0 modulo ``folds`` are held out: nothing is learned from
    them. The prediction reads the text alone. Null texts and texts without a letter, and all
    texts if no language was learned, are "und" with score 0. ``score`` is 1 less the mean
    distance. Of equally near languages the first by name is taken. A null key is held out.
    """
    rows = picked(docs, {"k": key, "t": text, "lang": lang})
    held_out = F.coalesce(F.crc32(F.col("k").cast("string")) % folds == 0, F.lit(True))
    profiles = learn_profiles(rows.filter(~held_out), "t", "lang")
    kind = dict(rows.dtypes)["k"]
    found = rows.select("k", held_out.alias("held_out"), "t").mapInArrow(
        _predict(profiles), f"k {kind}, held_out boolean, lang_pred string, score double"
    )
    return found.withColumnRenamed("k", key)
