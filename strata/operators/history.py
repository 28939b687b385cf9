"""Type-2 history: every version of a key with the time from and until which it held.

Versions are points in time; the intervals follow from them. So a late version splits the interval
it falls into, whatever order loads come in, and a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column, existing_names, require_columns
from strata.operators.dedupe import total_order

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"
_LOAD, _RANK = "_load", "_rank"


def history(versions: DataFrame, keys: Sequence[str], compare: str | None = None) -> DataFrame:
    """Versions (one per key and ``effective_from``) with ``effective_to`` and ``is_current``.

    An interval ends where the key's next one begins; the last is open and current. With
    ``compare`` a version equal in that column to the one before it is left out: then a version
    that comes late, between two that were equal, is followed by none.
    """
    names = existing_names(versions, keys)
    by_time = Window.partitionBy(*(column(k) for k in names)).orderBy(column(FROM).asc_nulls_first())
    if compare is not None:
        before = F.lag(F.struct(column(compare))).over(by_time)
        changed = before.isNull() | ~F.struct(column(compare)).eqNullSafe(before)
        versions = versions.withColumn(_RANK, changed).filter(_RANK).drop(_RANK)
    until = F.lead(column(FROM)).over(by_time)
    return versions.withColumns({TO: until, CURRENT: F.lead(F.lit(True)).over(by_time).isNull()})


def merge_history(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    at: str,
    compare: str | None = None,
) -> DataFrame:
    """The history after a load: ``target`` (a history, or None) with the versions of ``source``.

    ``at`` names the source's column that tells since when a version holds. Of versions of a key
    with the same time the newer load's counts, within a load the highest in all columns. Keys
    match null-safely; a version of unknown time holds before all others. Histories of keys that
    the source doesn't have are handed on as they are: only the keys that it has are sorted again.
    A key's versions meet in one task, after at most one per time and input partition is kept.
    """
    require_columns(source, [*keys, at], "history source")
    names = existing_names(source, keys)
    fresh = source.withColumnRenamed(existing_names(source, [at])[0], FROM).withColumn(_LOAD, F.lit(1))
    untouched = None
    if target is not None:
        wanted = source.select(*(column(k).alias(f"_new_{k}") for k in names)).distinct()
        same = F.lit(True)
        for k in names:
            same = same & column(k).eqNullSafe(column(f"_new_{k}"))
        old = target.drop(TO, CURRENT).withColumn(_LOAD, F.lit(0))
        fresh = fresh.unionByName(old.join(wanted, same, "left_semi"), allowMissingColumns=True)
        untouched = target.join(wanted, same, "left_anti")
    order = total_order(fresh, [_LOAD], [*names, FROM])
    ranked = fresh.withColumn(_RANK, F.row_number().over(Window.partitionBy(*(column(k) for k in names), FROM).orderBy(*order)))
    found = history(ranked.filter(F.col(_RANK) == 1).drop(_RANK, _LOAD), keys, compare)
    return found if untouched is None else found.unionByName(untouched, allowMissingColumns=True)
