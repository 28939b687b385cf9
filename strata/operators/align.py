"""Forcing a frame into the schema a target has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, find_name


def _fields(schema: T.StructType, exclude: Iterable[str]) -> list[T.StructField]:
    skipped = {name.lower() for name in exclude}
    return [f for f in schema.fields if f.name.lower() not in skipped]


def align(
    df: DataFrame,
    schema: T.StructType,
    exclude: Iterable[str] = (),
    on_cast_error: str = "raise",
) -> DataFrame:
    """Project ``df`` onto ``schema``: cast what is there, NULL what is not, drop the rest.

    ``exclude`` leaves target columns out that the target fills itself. A value that does not
    cast fails the query (``"raise"``) or becomes NULL (``"null"``); to reject such rows
    instead, filter on :func:`cast_failures` first.
    """
    if on_cast_error not in ("raise", "null"):
        raise ValueError(f"unknown on_cast_error {on_cast_error!r}")
    out = []
    for field in _fields(schema, exclude):
        name = find_name(df, field.name)
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == field.dataType:
            value = column(name)
        elif on_cast_error == "raise":
            value = column(name).cast(field.dataType)
        else:
            value = column(name).try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def cast_failures(df: DataFrame, schema: T.StructType, exclude: Iterable[str] = ()) -> Column:
    """True for rows holding a value that does not cast to its target type."""
    failed = F.lit(False)
    for field in _fields(schema, exclude):
        name = find_name(df, field.name)
        if name is not None and df.schema[name].dataType != field.dataType:
            value = column(name)
            failed = failed | (value.isNotNull() & value.try_cast(field.dataType).isNull())
    return failed
