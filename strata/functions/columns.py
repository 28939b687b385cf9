"""Looking columns up by name, in frames whose columns may be absent.

Names are resolved the way Spark resolves them by default: without regard to case.
Every NULL placeholder carries a type, so no void column ever reaches a sink.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """A column by its exact name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_name(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of ``name``, or None when it has no such column."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def existing_names(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The frame's spelling of those ``names`` it has, in the given order."""
    found = (find_name(df, n) for n in names)
    return [n for n in found if n is not None]


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def require_columns(df: DataFrame, names: Iterable[str], context: str) -> None:
    """Raise before any plan is built when ``df`` lacks one of ``names``."""
    missing = [n for n in names if find_name(df, n) is None]
    if missing:
        raise ValueError(f"{context}: no column {missing}; the frame has {df.columns}")


def payload_columns(df: DataFrame) -> list[str]:
    """Columns that belong to the record; a leading underscore marks working columns."""
    return [c for c in df.columns if not c.startswith("_")]


class Picker:
    """Chooses columns of a frame by presence, and remembers columns derived on the way.

    Derived columns are kept as expressions, so a chain of derivations still becomes one
    projection rather than one per column.
    """

    def __init__(self, df: DataFrame):
        self._known = {c.lower(): column(c) for c in df.columns}

    def has(self, name: str) -> bool:
        return name.lower() in self._known

    def remember(self, name: str, value: Column) -> None:
        self._known[name.lower()] = value

    def first(self, *names: str, default=None, dtype: str | T.DataType = "string") -> Column:
        """The first of ``names`` the frame has, else the default literal.

        The choice is by presence: a present column that is all NULL still wins.
        """
        for name in names:
            if self.has(name):
                return self._known[name.lower()]
        return F.lit(None).cast(dtype) if default is None else F.lit(default)

    def merged(self, *names: str, default=None, dtype: str | T.DataType = "string") -> Column:
        """The first non-NULL value among those of ``names`` the frame has."""
        present = [self._known[n.lower()] for n in names if self.has(n)]
        if default is not None or not present:
            present.append(F.lit(None).cast(dtype) if default is None else F.lit(default))
        return F.coalesce(*present)


def first_existing(
    df: DataFrame, names: Iterable[str], default=None, dtype: str | T.DataType = "string"
) -> Column:
    return Picker(df).first(*names, default=default, dtype=dtype)


def optional_column(df: DataFrame, name: str, dtype: str | T.DataType = "string") -> Column:
    return first_existing(df, [name], dtype=dtype)


def coalesce_existing(
    df: DataFrame, names: Iterable[str], default=None, dtype: str | T.DataType = "string"
) -> Column:
    return Picker(df).merged(*names, default=default, dtype=dtype)


@dataclass(frozen=True)
class Derived:
    """A column to add when the frame does not have it yet."""

    name: str
    build: Callable[[Picker], Column]


def derive_missing(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """Add each derived column whose name is absent; later ones may use earlier ones."""
    pick = Picker(df)
    added = []
    for item in derived:
        if pick.has(item.name):
            continue
        value = item.build(pick)
        pick.remember(item.name, value)
        added.append(value.alias(item.name))
    return df.select("*", *added) if added else df
