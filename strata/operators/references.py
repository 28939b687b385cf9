"""Rules that are decided by another table: a value has to occur there.

Such a rule becomes a row predicate before rows are classified, so it takes its place in the order
of the other rules and shares their one pass. What is looked up are a column's distinct values, which
are combined before they shuffle: a value that a third of all rows hold meets the reference once
for each task. Only values that aren't found come back to the rows. They are written and measured:
few of them are broadcast and the rows aren't shuffled; otherwise both sides meet in a shuffled join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import column, find_name, require_columns
from strata.operators.merge import fits_broadcast
from strata.operators.quality import Rule, orphan_flag

Find = Callable[[str], DataFrame]
Write = Callable[[DataFrame], DataFrame]


def missing_values(df: DataFrame, names: Sequence[str], reference: DataFrame, reference_names: Sequence[str]) -> DataFrame:
    """The distinct values of some columns, taken together, that ``reference`` doesn't hold.

    Reference values are read as the columns' types; those that don't fit one match nothing. A
    value with an unknown (NULL) part isn't looked up.
    """
    require_columns(df, names, "rows with references")
    require_columns(reference, reference_names, "reference")
    if len(names) != len(reference_names):
        raise ValueError(f"{len(names)} columns refer to {len(reference_names)}: {names}, {reference_names}")
    keys = [f"_v{i}" for i in range(len(names))]
    own = [find_name(df, n) for n in names]
    held = df.select(*(column(n).alias(k) for n, k in zip(own, keys))).dropna().distinct()
    kinds = [df.schema[n].dataType for n in own]
    there = reference.select(
        *(column(find_name(reference, n)).try_cast(kind).alias(k) for n, k, kind in zip(reference_names, keys, kinds))
    )
    return held.join(there, keys, "left_anti")


def resolve_references(df: DataFrame, rules: Sequence[Rule], find: Find, write: Write) -> tuple[DataFrame, list[Rule]]:
    """The rows with a flag for each rule that refers to a table, and the rules as predicates.

    ``find`` gives a reference table by name, ``write`` writes a frame once and reads it back. The
    rows are read once more, a rule's columns only, so they should be cheap to read, as a written
    table is. The predicate is unknown where a column is NULL, so what happens then is the
    classification's ``null_policy``.
    """
    out, resolved = df, []
    for index, rule in enumerate(rules):
        if not rule.refers:
            resolved.append(rule)
            continue
        names, theirs = ([n.strip() for n in text.split(",")] for text in (rule.column_name, rule.reference_column))
        missing = write(missing_values(df, names, find(rule.reference_object), theirs))
        flag = orphan_flag(index)
        own = [find_name(df, n) for n in names]
        values = missing.select(*(F.col(k).alias(f"{flag}_{i}") for i, k in enumerate(missing.columns)), F.lit(True).alias(flag))
        same = F.lit(True)
        for i, n in enumerate(own):
            same = same & (column(n) == F.col(f"{flag}_{i}"))
        joined = out.join(F.broadcast(values) if fits_broadcast(missing) else values, same, "left")
        out = joined.drop(*(f"{flag}_{i}" for i in range(len(own))))
        known = F.lit(True)
        for n in own:
            known = known & column(n).isNotNull()
        resolved.append(replace(rule, expression=F.when(known, F.col(flag).isNull())))
    return out, resolved
