"""Type-1 upsert as a join: target and source in, the table's next state out.

Plain files have no row-level update, so a merge computes the whole next state and the
caller writes it to a new place. Keys match null-safely, a matched row is replaced when its
compared column differs, and target rows without a source row stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, existing_names, find_name, require_columns
from strata.functions.hashing import BUSINESS_KEY_HASH, RECORD_HASH
from strata.operators.dedupe import latest_per_key

ACTION = "_action"
KEEP, NOOP, UPDATE, INSERT = "KEEP", "NOOP", "UPDATE", "INSERT"
ACTIONS = (KEEP, NOOP, UPDATE, INSERT)

_IN_TARGET = "_in_target"
_IN_SOURCE = "_in_source"
_PREFIX = "_new_"

# A source is broadcast only when it was measured to be no larger than this.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class MergeColumns:
    """How each target column is filled: decided by name, before the plan is built."""

    keys: list[str]
    written: list[str]
    preserved: list[str]
    untouched: list[str]

    @staticmethod
    def of(
        target: DataFrame,
        source: DataFrame,
        keys: Sequence[str],
        preserve: Iterable[str] = (),
        exclude: Iterable[str] = (),
    ) -> MergeColumns:
        keys = [k for k in keys if k]
        if not keys:
            raise ValueError("a merge needs key columns")
        require_columns(source, keys, "merge source")
        require_columns(target, keys, "merge target")
        key_names = existing_names(target, keys)
        skipped = {c.lower() for c in exclude}
        kept = {c.lower() for c in preserve}
        written, preserved, untouched = [], [], []
        for name in target.columns:
            if name in key_names:
                continue
            if name.lower() in skipped or find_name(source, name) is None:
                untouched.append(name)
            elif name.lower() in kept:
                preserved.append(name)
            else:
                written.append(name)
        return MergeColumns(key_names, written, preserved, untouched)


_DIGITS, _TEXT = b"\x01", b"\x00"


def _packed(text: Column) -> Column:
    """A text in half the bytes where it is lower-case hexadecimal digits, told apart by its first byte."""
    digits = F.unhex(text)
    is_hex = F.lower(F.hex(digits)).eqNullSafe(text)
    return F.when(is_hex, F.concat(F.lit(_DIGITS), digits)).otherwise(F.concat(F.lit(_TEXT), text.cast("binary")))


def _unpacked(packed: Column) -> Column:
    rest = F.substring(packed, 2, (1 << 31) - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(_DIGITS), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _shared_digests(target: DataFrame, source: DataFrame, cols: MergeColumns) -> list[str]:
    """Digest columns of the target that both sides hold as text."""
    text = T.StringType()
    return [
        n
        for n in (*cols.written, *cols.preserved)
        if n.lower() in (BUSINESS_KEY_HASH, RECORD_HASH)
        and target.schema[n].dataType == source.schema[find_name(source, n)].dataType == text
    ]


def _renamed_source(source: DataFrame, cols: MergeColumns) -> DataFrame:
    names = [*cols.keys, *cols.written, *cols.preserved]
    picked = [column(find_name(source, n)).alias(_PREFIX + n) for n in names]
    return source.select(*picked, F.lit(True).alias(_IN_SOURCE))


def _same_key(keys: Sequence[str], null_safe: bool = True) -> Column:
    condition = F.lit(True)
    for key in keys:
        old, new = column(key), column(_PREFIX + key)
        condition = condition & (old.eqNullSafe(new) if null_safe else old == new)
    return condition


def _changed(cols: MergeColumns, compare: str | None, order: str | None = None) -> Column:
    """Whether a matched row differs and isn't older; NULL on one side only counts as a difference."""
    last = next((c for c in cols.written if order and c.lower() == order.lower()), None)
    if last is not None:
        # An unknown place in the order counts as new.
        older = F.coalesce(column(_PREFIX + last) < column(last), F.lit(False))
        return ~older & _changed(cols, compare)
    name = next((c for c in cols.written if compare and c.lower() == compare.lower()), None)
    if not cols.written:
        return F.lit(False)
    if name is None:
        return F.lit(True)
    return ~column(name).eqNullSafe(column(_PREFIX + name))


def _next_state(
    joined: DataFrame, target: DataFrame, cols: MergeColumns, compare: str | None, order: str | None = None
) -> DataFrame:
    action = (
        F.when(F.col(_IN_SOURCE).isNull(), KEEP)
        .when(F.col(_IN_TARGET).isNull(), INSERT)
        .when(_changed(cols, compare, order), UPDATE)
        .otherwise(NOOP)
    )
    staged = joined.withColumn(ACTION, action)
    is_new = F.col(ACTION) == INSERT
    takes_source = F.col(ACTION).isin(INSERT, UPDATE)
    out = []
    for name in target.columns:
        old, new = column(name), column(_PREFIX + name)
        if name in cols.keys:
            value = F.when(is_new, new).otherwise(old)
        elif name in cols.written:
            value = F.when(takes_source, new).otherwise(old)
        elif name in cols.preserved:
            value = F.when(is_new, new).otherwise(old)
        else:
            value = old
        out.append(value.alias(name))
    return staged.select(*out, ACTION)


def merge_scd1(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    compare: str | None = "record_hash",
    preserve: Iterable[str] = (),
    exclude: Iterable[str] = (),
    on_duplicate: str = "assume_unique",
    sequence: str | None = None,
    small_source: bool = False,
    order: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """The target after the upsert, each row with the action that produced it.

    ``compare`` names the column whose difference means "changed"; without it (or when
    either side lacks it) every match updates. ``preserve`` columns keep their first value,
    ``exclude`` columns are never written. With ``order`` a matched row whose value of that column
    is smaller in the source than in the target is left as it is. Source keys must be unique: ``on_duplicate="latest"``
    makes them so, otherwise the caller has checked it. ``null_safe=False`` is for keys that are
    never NULL: a plain comparison lets Spark use how a bucketed target is laid out.

    By default both sides meet in one full outer join, one shuffle each. ``small_source=True``
    says the source was measured to fit a broadcast (see :func:`fits_broadcast`): then the
    target is streamed past it without any shuffle.
    """
    if on_duplicate == "latest":
        source = latest_per_key(source, keys, sequence)
    elif on_duplicate != "assume_unique":
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    cols = MergeColumns.of(target, source, keys, preserve, exclude)
    new = _renamed_source(source, cols)
    old = target.withColumn(_IN_TARGET, F.lit(True))
    same_key = _same_key(cols.keys, null_safe)
    if not small_source:
        # Digests are most of a row: they are shuffled as bytes, and are text again after the join.
        digests = _shared_digests(target, source, cols)
        old = old.withColumns({n: _packed(column(n)) for n in digests})
        new = new.withColumns({_PREFIX + n: _packed(column(_PREFIX + n)) for n in digests})
        state = _next_state(old.join(new, same_key, "full_outer"), target, cols, compare, order)
        return state.withColumns({n: _unpacked(column(n)) for n in digests})

    new_keys = new.select(*[column(_PREFIX + k) for k in cols.keys])
    old_keys = target.select(*[column(k) for k in cols.keys])
    # Distinct keys found in the source, so never larger than the source itself.
    hits = old_keys.join(F.broadcast(new_keys), same_key, "left_semi").distinct()
    fresh = new.join(F.broadcast(hits), same_key, "left_anti")
    current = _next_state(old.join(F.broadcast(new), same_key, "left"), target, cols, compare, order)
    return current.unionByName(_added(fresh, old, target, cols, compare))


def _added(fresh: DataFrame, old: DataFrame, target: DataFrame, cols: MergeColumns, compare: str | None) -> DataFrame:
    """Source rows that no target row matches, as rows of the target."""
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema.fields]
    return _next_state(fresh.select(*blanks, "*"), target, cols, compare)


# --- merges that shuffle only the rows that change ----------------------------------------------

# Keys are hashed to places, some per source row, whose bits are broadcast: at most 48 MB of them.
PLACES_PER_ROW = 4
MAX_PLACES = 1 << 27
NEW, SAME, CHANGED = "new", "same", "changed"
_BUCKET, _BIT, _JOINS = "_bucket", "_bit", "_joins"


def can_sift(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys hash alike: plain types, the same on both sides."""
    plain = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    kinds = [target.schema[n].dataType for n in existing_names(target, keys)]
    return kinds == [source.schema[n].dataType for n in existing_names(source, keys)] and all(
        isinstance(kind, plain) or kind == T.StringType() for kind in kinds
    )


def key_places(rows: int) -> int:
    """How many places the keys of so many source rows are hashed to."""
    return max(1, min(PLACES_PER_ROW * rows, MAX_PLACES))


def _place(df: DataFrame, keys: Sequence[str], places: int) -> Column:
    return F.pmod(F.xxhash64(*[column(n) for n in existing_names(df, keys)]), F.lit(places))


def _comparable(df: DataFrame, compare: str | None) -> Column:
    """What two rows differ in when they differ in ``compare``: of a text, 128 bits."""
    name = find_name(df, compare) if compare else None
    if name is None:
        return F.lit(None).cast("binary")
    value = column(name)
    return F.unhex(F.md5(value.cast("binary"))) if df.schema[name].dataType == T.StringType() else value


def decide(
    target: DataFrame, source: DataFrame, keys: Sequence[str], places: int, compare: str | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """For each source row the place of its key, and whether it is new, the same or changed; few columns are shuffled.

    ``carried`` are columns of the target row it matches. Without a column to compare, or if a side lacks
    it, a row that matches has changed.
    """
    names = existing_names(target, keys)
    picked = [column(find_name(source, k)).alias(_PREFIX + k) for k in names]
    new = source.select(*picked, _comparable(source, compare).alias("_new"))
    old = target.select(*[column(n) for n in (*names, *carried)], _comparable(target, compare).alias("_old"), F.lit(True).alias(_IN_TARGET))
    joined = new.join(old, _same_key(names), "left")
    compared = bool(compare and find_name(target, compare) and find_name(source, compare))
    same = F.col("_old").eqNullSafe(F.col("_new")) if compared else F.lit(False)
    kind = F.when(F.col(_IN_TARGET).isNull(), NEW).when(same, SAME).otherwise(CHANGED)
    place = _place(joined, [_PREFIX + k for k in names], places).alias("_place")
    return joined.select(*[column(n) for n in carried], place, kind.alias("_kind"))


def sieve(decided: DataFrame) -> DataFrame:
    """The places where keys are new, the same or changed, as bitmaps: one row for each 32,768 places."""
    # Dealt out by bitmap first, as each task would otherwise build all bitmaps.
    dealt = decided.select(F.bitmap_bucket_number("_place").alias(_BUCKET), F.bitmap_bit_position("_place").alias(_BIT), "_kind")
    bits = [F.expr(f"bitmap_construct_agg({_BIT}) FILTER (WHERE _kind = '{kind}')").alias(f"_{kind}") for kind in (NEW, SAME, CHANGED)]
    return dealt.repartition(_BUCKET).groupBy(_BUCKET).agg(*bits)


def _is_set(bitmap: str) -> Column:
    byte = F.substring(F.col(bitmap), F.floor(F.col(_BIT) / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.getbit(value, (F.col(_BIT) % 8).cast("int")) == 1, F.lit(False))


def _sifted(df: DataFrame, keys: Sequence[str], places: int, bitmaps: DataFrame) -> DataFrame:
    place = _place(df, keys, places)
    placed = df.withColumns({_BUCKET: F.bitmap_bucket_number(place), _BIT: F.bitmap_bit_position(place)})
    marked = placed.join(F.broadcast(bitmaps), _BUCKET, "left")
    # Where no key has changed, keys that share a place are all new or all the same.
    joins = _is_set(f"_{CHANGED}") | (_is_set(f"_{SAME}") & _is_set(f"_{NEW}"))
    return marked.select(*[column(c) for c in df.columns], joins.alias(_JOINS), _is_set(f"_{NEW}").alias(f"_{NEW}"))


def merge_sifted(
    target: DataFrame, source: DataFrame, keys: Sequence[str], bitmaps: DataFrame, places: int, *,
    compare: str | None = "record_hash", preserve: Iterable[str] = (), exclude: Iterable[str] = (), order: str | None = None,
) -> DataFrame:
    """What :func:`merge_scd1` gives, by a join of only those rows whose place holds a changed key.

    Target rows elsewhere stay as they are, matched or not (both as KEEP), and source rows elsewhere are new or
    the same: neither is shuffled. ``bitmaps`` is the :func:`sieve` of what was decided for this target
    and source, with as many ``places``.
    """
    cols = MergeColumns.of(target, source, keys, preserve, exclude)
    old, new = _sifted(target, keys, places, bitmaps), _sifted(source, keys, places, bitmaps)
    left = old.filter(~F.col(_JOINS)).select(*[column(c) for c in target.columns], F.lit(KEEP).alias(ACTION))
    fresh = new.filter(~F.col(_JOINS) & F.col(f"_{NEW}")).select(*[column(c) for c in source.columns])
    added = _added(_renamed_source(fresh, cols), target.withColumn(_IN_TARGET, F.lit(True)), target, cols, compare)
    old, new = (df.filter(_JOINS).drop(_JOINS, f"_{NEW}") for df in (old, new))
    joined = merge_scd1(old, new, keys, compare=compare, preserve=preserve, exclude=exclude, order=order)
    return left.unionByName(joined).unionByName(added)


# --- merges that don't shuffle what they keep ----------------------------------------------------

# Where a row is stored: a hash of its file's path (2^-64 a pair of files) and its number there.
FILE, ROW = "_file", "_row"
_OLD = "_old_"
# A bitmap of replaced rows has 4 KB; more of them aren't broadcast.
MAX_BITMAPS = 16_384


def located(files: DataFrame) -> DataFrame:
    """A read table with the place of each row."""
    return files.withColumns({FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], finish: Callable[[DataFrame], DataFrame], *,
    compare: str | None = "record_hash", preserve: Iterable[str] = (), exclude: Iterable[str] = (), order: str | None = None,
) -> DataFrame:
    """The rows a merge adds or replaces, as :func:`merge_scd1` gives them, with the place of the row they replace.

    ``finish`` adds to source rows the columns that follow from the others, once they are shuffled. Of the
    ``located`` target only keys, what is compared and what an updated row keeps are shuffled.
    """
    table = target.drop(FILE, ROW)
    cols = MergeColumns.of(table, finish(source), keys, preserve, exclude)
    ordered = [c for c in cols.written if order and c.lower() == order.lower()]
    carried = [*cols.keys, *cols.preserved, *cols.untouched, *ordered, FILE, ROW]
    old = target.select(*[column(c).alias(_OLD + c) for c in carried], _comparable(table, compare).alias("_was"), F.lit(True).alias(_IN_TARGET))
    same_key = F.lit(True)
    for key in cols.keys:
        same_key = same_key & column(find_name(source, key)).eqNullSafe(column(_OLD + key))
    joined = finish(source.join(old, same_key, "left"))
    compared = any(c.lower() == (compare or "").lower() for c in cols.written)
    changed = ~F.col("_was").eqNullSafe(_comparable(joined, compare)) if compared else F.lit(bool(cols.written))
    for name in ordered:
        older = F.coalesce(column(find_name(joined, name)) < column(_OLD + name), F.lit(False))
        changed = ~older & changed
    is_new = F.col(_IN_TARGET).isNull()
    out = []
    for name in table.columns:
        if name in cols.untouched:
            value = column(_OLD + name)
        elif name in cols.written:
            value = column(find_name(joined, name))
        else:
            value = F.when(is_new, column(find_name(joined, name))).otherwise(column(_OLD + name))
        out.append(value.alias(name))
    places = [column(_OLD + name).alias(name) for name in (FILE, ROW)]
    action = F.when(is_new, INSERT).otherwise(UPDATE).alias(ACTION)
    return joined.filter(is_new | changed).select(*out, *places, action)


def replaced_rows(changed: DataFrame) -> DataFrame:
    """Which rows of the target are replaced, exactly: a bitmap for each 32,768 rows of a file."""
    spots = changed.filter(F.col(ACTION) == UPDATE).select(FILE, F.bitmap_bucket_number(ROW).alias(_BUCKET), F.bitmap_bit_position(ROW).alias(_BIT))
    return spots.repartition(FILE, _BUCKET).groupBy(FILE, _BUCKET).agg(F.bitmap_construct_agg(_BIT).alias("_replaced"))


def kept_rows(target: DataFrame, replaced: DataFrame, small: bool) -> DataFrame:
    """The rows of a ``located`` target that stay; they aren't shuffled if the bitmaps were measured to be small."""
    placed = target.withColumns({_BUCKET: F.bitmap_bucket_number(ROW), _BIT: F.bitmap_bit_position(ROW)})
    marked = placed.join(F.broadcast(replaced) if small else replaced, [FILE, _BUCKET], "left").filter(~_is_set("_replaced"))
    return marked.select(*[column(c) for c in target.drop(FILE, ROW).columns], F.lit(KEEP).alias(ACTION))


def matching_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], small_source: bool = False) -> DataFrame:
    """Target rows whose key occurs in the source, NULL matching NULL."""
    names = existing_names(target, keys)
    wanted = source.select(*[column(find_name(source, k)).alias(_PREFIX + k) for k in names])
    return target.join(F.broadcast(wanted) if small_source else wanted, _same_key(names), "left_semi")


def _row_bytes(df: DataFrame) -> Column:
    """A bound on a row's size in memory: fixed slots, text, and nested values by their JSON."""
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        value = column(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 8 * F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return size


def fits_broadcast(
    df: DataFrame, rows: int | None = None, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether a frame is small enough to broadcast, by rows and then by bytes.

    The row count of a written table comes from its file footers, unless the caller knows
    it; bytes are summed only when that count is small.
    """
    if (df.count() if rows is None else rows) > max_rows:
        return False
    size = df.agg(F.sum(_row_bytes(df))).first()[0]
    return (size or 0) <= max_bytes


def merge_action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))


def merge_metrics() -> list[Column]:
    """Aggregates for an observation placed between a merge and its sink."""
    action = F.col(ACTION)
    return [
        F.count_if(action == INSERT).alias("rows_inserted"),
        F.count_if(action == UPDATE).alias("rows_updated"),
        F.count_if(action.isin(INSERT, UPDATE)).alias("rows_written"),
    ]
