"""Incremental state: how far each load has read its source.

State rows hold watermarks as text, as sources differ in type; bounds are cast back to the
column's own type, so the range filter reaches the parquet scan. The text of a point in time
carries its offset, so it means the same in a session of another time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, find_name
from strata.operators.dedupe import latest_per_key


def watermark_state(log: DataFrame) -> DataFrame:
    """One row per load from an append-only log of watermark moves: the latest move.

    A load that was told to start over since has no row.
    """
    return latest_per_key(log, ["pipeline_id"], "updated_timestamp").filter(F.col("current_watermark").isNotNull())


def start_over(state: DataFrame) -> DataFrame:
    """Moves that end the history of the loads in ``state``: each starts over, as if never run."""
    moment = F.current_timestamp()
    nothing = F.lit(None).cast("string")
    return state.withColumns(
        {
            "previous_watermark": F.col("current_watermark"),
            "current_watermark": nothing,
            "last_successful_batch_id": nothing,
            "last_successful_audit_id": nothing,
            "updated_timestamp": moment,
        }
    )


def load_position(log: DataFrame, pipeline_id: str) -> tuple[str | None, str | None]:
    """A load's watermark, and the time it was last told to start over; one aggregate, no sort."""
    own = log.filter(F.col("pipeline_id") == pipeline_id)
    ended = F.max(F.when(F.col("current_watermark").isNull(), F.col("updated_timestamp")))
    return tuple(own.agg(F.max_by("current_watermark", "updated_timestamp"), as_text(ended, T.TimestampType())).first())


def current_watermark(state: DataFrame | None, pipeline_id: str) -> str | None:
    """A load's watermark; None without a state table or before its first success."""
    if state is None:
        return None
    row = state.filter(F.col("pipeline_id") == pipeline_id).select("current_watermark").limit(1).first()
    return row[0] if row else None


def incremental_slice(
    df: DataFrame,
    name: str,
    low: object = None,
    high: object = None,
    lag: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows with ``low < name <= high``; with ``inclusive`` those at ``low`` too.

    Without ``low`` (a first load) rows whose watermark is NULL are read too; later loads
    cannot place them and skip them. ``lag`` (an interval such as ``"1 hour"``) moves ``low``
    back, to catch rows that arrived late; the merge makes reading a row twice harmless.
    """
    found = find_name(df, name)
    if found is None:
        raise ValueError(f"no watermark column {name!r}")
    value = column(found)
    dtype = df.schema[found].dataType

    def bound(limit: object) -> Column:
        return F.lit(limit).cast(dtype)

    if low is None:
        return df if high is None else df.filter(value.isNull() | (value <= bound(high)))
    start = bound(low) if lag is None else bound(low) - F.expr(f"INTERVAL {lag}")
    sliced = df.filter(value >= start if inclusive else value > start)
    return sliced if high is None else sliced.filter(value <= bound(high))


def watermark_bounds(df: DataFrame, name: str) -> DataFrame:
    """One row: how many rows a slice holds and how far it reaches.

    Taken before the load, so that rows landing meanwhile wait for the next one. Reads one
    column.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        as_text(F.max(column(find_name(df, name))), df.schema[find_name(df, name)].dataType).alias("high_watermark"),
    )


def as_text(value: Column, dtype: T.DataType) -> Column:
    """A watermark's text; a cast to ``dtype`` gives the value back."""
    if isinstance(dtype, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return value.cast("string")


def advance_watermarks(state: DataFrame, moves: DataFrame) -> DataFrame:
    """The state after each load's move: known loads shift current to previous.

    Moves to an unknown (NULL) watermark are ignored. Both sides have one row per load.
    """
    stamps = ("last_successful_run_timestamp", "updated_timestamp")
    carried = ("watermark_column", "current_watermark", "last_successful_batch_id", "last_successful_audit_id", *stamps)
    new = moves.filter(F.col("current_watermark").isNotNull()).select(
        "pipeline_id", *[F.col(c).alias(f"_new_{c}") for c in carried], F.lit(True).alias("_moved")
    )
    joined = state.join(new, "pipeline_id", "full_outer")
    moved = F.col("_moved").isNotNull()

    def after(name: str) -> Column:
        return F.when(moved, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    previous = F.when(moved, F.col("current_watermark")).otherwise(F.col("previous_watermark"))
    return joined.select(
        "pipeline_id",
        after("watermark_column"),
        previous.alias("previous_watermark"),
        *[after(name) for name in carried[1:]],
    )
