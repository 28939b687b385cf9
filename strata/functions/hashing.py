"""Digests and surrogate keys.

The digest formula and the murmur3 key define values already stored in warehouses, so both
are kept exactly, with their known limits: NULL and '' digest alike, text holding the
separator can collide, and a murmur3 key has 31 bits. Use ``algorithm="xxhash64"`` for new
tables with more than some ten thousand keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column, existing_names

# They define stored digests.
SEPARATOR = "||"
NO_KEY_TEXT = "NO_BUSINESS_KEY"
NO_COLUMNS_TEXT = "NO_RECORD_COLS"
BUSINESS_KEY_HASH = "business_key_hash"
RECORD_HASH = "record_hash"

_LONG_MAX = (1 << 63) - 1


def digest(columns: Sequence[Column], empty_text: str) -> Column:
    """SHA-256 of the columns' text, NULL written as ''; of ``empty_text`` without columns."""
    if not columns:
        return F.sha2(F.lit(empty_text), 256)
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def business_key_hash(df: DataFrame, keys: Iterable[str]) -> Column:
    return digest([column(c) for c in existing_names(df, keys)], NO_KEY_TEXT)


def record_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Digest of the record: the given columns, or all but the two digests themselves."""
    own = {BUSINESS_KEY_HASH, RECORD_HASH}
    names = existing_names(df, df.columns if columns is None else columns)
    return digest([column(c) for c in names if c.lower() not in own], NO_COLUMNS_TEXT)


def add_hashes(
    df: DataFrame, keys: Iterable[str], record_columns: Iterable[str] | None = None
) -> DataFrame:
    """Add both digests in one projection.

    With ``record_columns=None`` the record digest also covers ``business_key_hash``'s
    inputs and any load stamps, so it changes on each load; the silver plan passes the
    business columns instead.
    """
    return df.withColumns(
        {
            BUSINESS_KEY_HASH: business_key_hash(df, keys),
            RECORD_HASH: record_hash(df, record_columns),
        }
    )


def joined_digest(*columns: Column) -> Column:
    """Digest of a natural id's parts: NULL parts are skipped, all-NULL gives NULL."""
    known = F.coalesce(*[c.cast("string") for c in columns])
    text = F.concat_ws(SEPARATOR, *[c.cast("string") for c in columns])
    return F.when(known.isNotNull(), F.sha2(text, 256))


def surrogate_key(
    *columns: Column | str, algorithm: str = "murmur3", null_key: str = "hash", as_type: str | None = None
) -> Column:
    """A non-negative bigint key computed from natural-key columns, so links need no join.

    ``murmur3`` gives 31-bit keys; ``xxhash64`` gives 63-bit keys. With ``null_key="hash"``
    an all-NULL natural key gets the hash seed (42) as the key, with ``"null"`` it gets NULL.
    Both ends of a link must have the same type, as 7 as int and 7 as bigint hash differently;
    ``as_type`` casts the natural keys to one type first.
    """
    cols = [column(c) if isinstance(c, str) else c for c in columns]
    if as_type is not None:
        cols = [c.cast(as_type) for c in cols]
    if algorithm == "murmur3":
        # Widened before abs, as abs of the smallest int does not fit an int.
        key = F.abs(F.hash(*cols).cast("bigint"))
    elif algorithm == "xxhash64":
        key = F.xxhash64(*cols).bitwiseAND(F.lit(_LONG_MAX))
    else:
        raise ValueError(f"unknown key algorithm {algorithm!r}")
    if null_key == "hash":
        return key
    if null_key == "null":
        any_known = cols[0].isNotNull()
        for c in cols[1:]:
            any_known = any_known | c.isNotNull()
        return F.when(any_known, key)
    raise ValueError(f"unknown null_key {null_key!r}")


# --- keys that collide ------------------------------------------------------------------------

KEY_BITS = 31


def key_base(*columns: Column | str, bits: int = KEY_BITS) -> Column:
    """The murmur3 key, in as many bits: what colliding natural keys share."""
    return F.pmod(surrogate_key(*columns), F.lit(1 << bits))


def collision_free_keys(rows: DataFrame, natural: str, known: DataFrame | None = None, bits: int = KEY_BITS) -> DataFrame:
    """A key of its own for each new natural key: ``natural``, ``key``.

    The first natural key of a base takes the base as its key, so nearly all keys are what
    :func:`surrogate_key` gives; the n-th after it is probed to base + n * 2^bits, which no other
    base reaches. ``known`` (natural, key) are those of earlier loads: they keep their keys, and
    new ones of the same base come after them, in the order of the natural key. NULL gets no key.
    Only keys are shuffled: once to find the new ones, once by their base.
    """
    fresh = rows.select(column(natural).alias("natural")).filter("natural IS NOT NULL").distinct()
    held = None
    if known is not None:
        fresh = fresh.join(known.select("natural"), "natural", "left_anti")
        last = F.max(F.shiftright("key", bits)).alias("last")
        held = known.groupBy(F.pmod("key", F.lit(1 << bits)).alias("base")).agg(last)
    based = fresh.withColumn("base", key_base("natural", bits=bits))
    place = F.row_number().over(Window.partitionBy("base").orderBy("natural")) - 1
    if held is None:
        probe = place
    else:
        based = based.join(held, "base", "left")
        probe = place + F.coalesce(F.col("last") + 1, F.lit(0))
    return based.select("natural", (F.col("base") + probe.cast("bigint") * F.lit(1 << bits)).alias("key"))


def probed(keys: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """The keys that aren't their base: as few as collide, and all that a link has to look up."""
    return keys.filter(F.col("key") >= F.lit(1 << bits))


def link_keys(
    facts: DataFrame, natural: str, name: str, exceptions: DataFrame, small: bool = False, bits: int = KEY_BITS
) -> DataFrame:
    """``facts`` with the key of a natural key as ``name``, computed but for the ``exceptions``.

    ``small`` says that the exceptions were measured to fit a broadcast: facts aren't shuffled then.
    """
    looked_up = exceptions.select(F.col("natural").alias("_natural"), F.col("key").alias("_key"))
    joined = facts.join(F.broadcast(looked_up) if small else looked_up, column(natural) == F.col("_natural"), "left")
    computed = F.when(column(natural).isNotNull(), key_base(natural, bits=bits))
    return joined.withColumn(name, F.coalesce("_key", computed)).drop("_natural", "_key")
