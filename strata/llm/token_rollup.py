"""Token counts kept up by deltas (operator 2).

A batch holds changes with the counts before and after: an insert has no before, a delete no
after, a revision both. Each change becomes signed amounts, summed up by source, language and
tokenizer version in the batch before anything is stored. A batch is a folder of its own, named by
its id and replaced as a whole, so committing it again, after a failure or a replay, changes
nothing. Totals are the sums over the batches.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import picked, written

GROUP = ("source", "lang", "tokenizer")
AMOUNTS = ("n_docs", "n_tokens")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

# Tokenizer versions that plain expressions can count: runs of characters other than ASCII white
# space, and runs of ASCII letters and digits or single other marks.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "marks-1": r"[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]"}


def token_count(text: Column, version: str) -> Column:
    """Tokens of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def signed(changes: DataFrame) -> DataFrame:
    """Changes (source, lang, tokenizer, and before_/after_ of each with tokens) as summed deltas.

    ``changes`` has ``before`` and ``after``, structs of source, lang, tokenizer and tokens, null
    where there was or is none; null tokens count 0. A revision may move between groups.
    """
    rows = []
    for side, sign in (("before", -1), ("after", 1)):
        groups = [F.col(f"{side}.{c}").alias(c) for c in GROUP]
        tokens = sign * F.coalesce(F.col(f"{side}.tokens"), F.lit(0))
        rows.append(
            changes.filter(F.col(side).isNotNull()).select(
                *groups, F.lit(sign).cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens")
            )
        )
    return summed(rows[0].unionByName(rows[1]))


def summed(deltas: DataFrame) -> DataFrame:
    """Amounts by group; null sources and languages are groups of their own."""
    return deltas.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in AMOUNTS))


class TokenRollup:
    """Totals in a folder that all executors share; one subfolder for each committed batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        empty = spark.createDataFrame([], SCHEMA)
        empty.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch=_none")

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Stores a batch's deltas. The same id replaces what an earlier try has left."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
            raise ValueError(f"batch id {batch_id!r}")
        signed(changes).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def totals(self) -> DataFrame:
        """Sums over all batches; groups that have nothing left are gone."""
        deltas = self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/batch=*")
        return summed(deltas).filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def compact(self, batch_id: str) -> DataFrame:
        """The totals as one batch's deltas, for a new folder to start from."""
        fresh = TokenRollup(self.spark, f"{self.folder}-{batch_id}")
        self.totals().write.mode("overwrite").parquet(f"{fresh.folder}/batch={batch_id}")
        return fresh.totals()


def _image(version: str, tokens: Column) -> Column:
    return F.struct(
        F.col("source").alias("source"), F.col("lang").alias("lang"), F.lit(version).alias("tokenizer"), tokens.alias("tokens")
    )


def corpus_changes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang"
) -> dict[str, DataFrame]:
    """The batches by which a corpus is loaded and cleaned, of all its rows.

    First every row is inserted; then rows whose text stands at a smaller key are deleted; then the
    counts of the others are revised, for the text without its repeated lines. Texts are compared
    by their SHA-256. Rows with a null key or text aren't deleted; a null text counts 0 tokens.
    """
    rows = picked(docs, {"k": key, "t": text, "source": source, "lang": lang})
    hashed = rows.withColumn("h", F.sha2("t", 256))
    first = hashed.filter("h IS NOT NULL AND k IS NOT NULL").groupBy("h").agg(F.min("k").alias("first"))
    lines = F.array_join(F.array_distinct(F.split("t", "\n")), "\n")
    counts = [c for v in VERSIONS for c in (token_count(F.col("t"), v).alias(f"a_{v}"), token_count(lines, v).alias(f"b_{v}"))]
    marked = hashed.select("k", "h", "source", "lang", *counts).join(first, "h", "left")
    copy = F.coalesce(F.col("k") > F.col("first"), F.lit(False))
    # Every batch reads the counts: they are taken once.
    one = written(marked.select("*", copy.alias("copy")).drop("k", "h", "first"), "token-counts")

    def batch(before: str | None, after: str | None, kept: DataFrame) -> DataFrame:
        sides = []
        for version in VERSIONS:
            image = {p: _image(version, F.col(f"{p}_{version}")) for p in "ab"}
            none = F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,tokens:bigint>")
            sides.append(F.struct((image[before] if before else none).alias("before"), (image[after] if after else none).alias("after")))
        return kept.select(F.explode(F.array(*sides)).alias("c")).select("c.before", "c.after")

    return {
        "1-insert": batch(None, "a", one),
        "2-delete": batch("a", None, one.filter("copy")),
        "3-revise": batch("a", "b", one.filter("not copy")),
    }
