"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, existing_names

_RANK = "_rank"


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def total_order(df: DataFrame, first: Iterable[str], keys: Iterable[str]) -> list[Column]:
    """``first`` descending, then every other orderable column, so that no tie is left open.

    Which of two equal-sequence rows wins then depends on the rows alone, not on how they
    were partitioned or on a retried task.
    """
    leading = existing_names(df, first)
    skipped = set(leading) | set(existing_names(df, keys))
    rest = [f.name for f in df.schema.fields if f.name not in skipped and orderable(f.dataType)]
    return [column(c).desc_nulls_last() for c in [*leading, *rest]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], sequence: str | Sequence[str] | None = None
) -> DataFrame:
    """Keep the row with the highest sequence per key; without any key column, keep all.

    Filtering on rank 1 lets Spark limit each key's group *before* the shuffle, so a key
    holding a third of all rows still sends one row per input partition.
    """
    names = existing_names(df, keys)
    if not names:
        return df
    first = [sequence] if isinstance(sequence, str) else list(sequence or [])
    order = total_order(df, first, names)
    window = Window.partitionBy(*[column(k) for k in names]).orderBy(*(order or [F.lit(1)]))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows read, rows kept and rows dropped by :func:`latest_per_key`.

    Counts are combined before the shuffle, one partial row per key and partition.
    """
    names = existing_names(df, keys)
    per_key = df.groupBy(*[column(k) for k in names]).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    kept = F.count(F.lit(1)) if names else total
    return per_key.agg(
        total.alias("rows_read"),
        kept.alias("rows_kept"),
        (total - kept).alias("rows_duplicated"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their counts."""
    return (
        df.groupBy(*[column(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )
