"""Reading the given tables, and tables written to the shared folder between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.folders import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: what follows reads files that every executor sees, so a lost executor costs
    a reread and not a recomputation.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def picked(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns an operator reads, under its own names.

    ``columns`` maps own names to the frame's, so extra columns, whatever they are called, never
    meet the operator's own.
    """
    return df.select(*(F.col(f"`{theirs}`").alias(own) for own, theirs in columns.items()))


def rows_without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key isn't in the one column of ``gone``, whatever else their columns are called."""
    name = "_gone"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.join(gone.toDF(name).distinct(), F.col(f"`{key}`") == F.col(name), "left_anti")


def tokenizer_file(name: str) -> str:
    """Where an installed public tokenizer's file is; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
