"""The training-data pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import minhash, packing, phrase_index, quality_rules, suffix_dedup
from strata.llm.common import picked, table, tokenizer_file, written

# Learned rules, the order of packing and the tokenizer can't be expressed in SQL; tests/llm holds
# each stage against brute force.
ORACLE_SQL = None


# Rows of whole texts that go to a Python worker at a time. Spark's 10,000 are tens of megabytes of
# text, held by the executor's direct memory and by the worker at once, and kept by both.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id."""
    _small_batches(spark)
    return minhash.keep_one(docs, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages that stand in an earlier one too are cut out, n_chars follows."""
    _small_batches(spark)
    cut = suffix_dedup.without_repeats(docs)
    return suffix_dedup.with_length(cut) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark items."""
    return phrase_index.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's ids lies in the training sequences."""
    _small_batches(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("minhash near-duplicates", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each keeps is written and read back as the next one's."""
    docs = picked(table(spark, sf_dir, "documents"), {c: c for c in ("doc_id", "text", "lang", "source", "n_chars")})
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
