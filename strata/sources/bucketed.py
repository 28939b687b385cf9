"""Type-1 merges into a bucketed catalog table: the target isn't shuffled, only the batch is.

A row's key columns are kept once more as one text (JSON, which tells NULL from an empty text), and
the table is bucketed and sorted by it. The merge joins on that column alone, so Spark reads the
target bucket by bucket and deals the batch out to match. What it writes is dealt out in the same
way, so each task writes one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import column, existing_names, require_columns
from strata.operators.merge import ACTION, merge_scd1
from strata.sources.folders import CODEC, shared_folder

KEY_TEXT = "_key_text"
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 1) -> int:
    """How many buckets keep each one, which a task reads whole, to ``BUCKET_ROWS`` rows."""
    return max(least, -(-rows // BUCKET_ROWS))


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key columns as one text that is never NULL; equal exactly where they are, NULL matching NULL."""
    named = [column(name).alias(f"k{i}") for i, name in enumerate(existing_names(df, keys))]
    return F.to_json(F.struct(*named), {"ignoreNullFields": "false"})


class BucketedTable:
    """A table of the session's catalog, merged by key."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int):
        self.spark = spark
        self.name = name
        self.keys = list(keys)
        self.buckets = buckets

    def _write(self, df: DataFrame) -> None:
        """Write the next state beside the table, then let it take the table's name."""
        following = f"{self.name}__next"
        self.spark.sql(f"DROP TABLE IF EXISTS {following}")
        writer = df.write.format("parquet").options(**CODEC).bucketBy(self.buckets, KEY_TEXT).sortBy(KEY_TEXT)
        writer.option("path", shared_folder(self.spark, self.name)).saveAsTable(following)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {following} RENAME TO {self.name}")

    def create(self, df: DataFrame) -> None:
        """The first rows; their keys must be unique."""
        require_columns(df, self.keys, "bucketed table")
        keyed = df.withColumn(KEY_TEXT, key_text(df, self.keys))
        self._write(keyed.repartition(self.buckets, KEY_TEXT))

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(KEY_TEXT)

    def merged(self, source: DataFrame, **options) -> DataFrame:
        """The state after an upsert of ``source``, with actions; options as of ``merge_scd1``."""
        require_columns(source, self.keys, "merge source")
        keyed = source.withColumn(KEY_TEXT, key_text(source, self.keys))
        return merge_scd1(self.spark.table(self.name), keyed, [KEY_TEXT], null_safe=False, **options)

    def merge(self, source: DataFrame, **options) -> None:
        self._write(self.merged(source, **options).drop(ACTION))
