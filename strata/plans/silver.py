"""Silver entities: what each bronze table must look like before it is loaded.

An entity is a list of columns to derive when the source lacks them, or (for vehicles) a
full projection from alternative names. Everything is one projection over the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import Derived, Picker, column, derive_missing, existing_names, find_name
from strata.functions.hashing import add_hashes, joined_digest
from strata.operators.dedupe import latest_per_key, orderable


@dataclass(frozen=True)
class Choice:
    """An output column taken from the first of several names the source has."""

    name: str
    names: tuple[str, ...]
    dtype: str = "string"
    convert: bool = False

    def build(self, pick: Picker) -> Column:
        value = pick.first(*self.names, dtype=self.dtype)
        return (value.cast(self.dtype) if self.convert else value).alias(self.name)


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]
    derived: tuple[Derived, ...] = ()
    projection: tuple[Choice, ...] = field(default=())


# Bronze lineage columns and the names they get in silver.
LINEAGE = {
    "pipeline_id": "source_pipeline_id",
    "batch_id": "source_batch_id",
    "ingestion_timestamp": "source_ingestion_timestamp",
    "record_hash": "source_record_hash",
    "source_file_name": "source_file_name",
}
UPDATE_STAMP = "silver_update_timestamp"


def _first(name: str, *names: str, dtype: str = "timestamp") -> Derived:
    return Derived(name, lambda pick: pick.first(*names, dtype=dtype))


def _day_of(name: str, *names: str) -> Derived:
    return Derived(name, lambda pick: F.to_date(pick.first(*names, dtype="timestamp")))


def _constant(name: str, value: int) -> Derived:
    return Derived(name, lambda pick: F.lit(value))


def _amount(pick: Picker, name: str) -> Column:
    return F.coalesce(pick.first(name, default=0), F.lit(0))


def _sum_of(name: str, *names: str) -> Derived:
    def build(pick: Picker) -> Column:
        total = _amount(pick, names[0])
        for other in names[1:]:
            total = total + _amount(pick, other)
        return total

    return Derived(name, build)


def _product_of(name: str, left: str, right: str) -> Derived:
    return Derived(name, lambda pick: _amount(pick, left) * _amount(pick, right))


def _earliest_known(name: str, *names: str) -> Derived:
    return Derived(name, lambda pick: F.coalesce(*[pick.first(n, dtype="date") for n in names]))


def _digest_of(name: str, *names: str) -> Derived:
    return Derived(name, lambda pick: joined_digest(*[pick.first(n) for n in names]))


# Entity, key and column names, and the order in which alternatives are tried.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity("vehicle_model", ("model_id",)),
        Entity("dealer", ("dealer_id",)),
        Entity("customer", ("customer_id",)),
        Entity(
            "vehicle",
            ("vin",),
            projection=(
                Choice("vin", ("vin",)),
                Choice("model_id", ("model_id", "vehicle_model_id")),
                Choice("customer_id", ("current_customer_id", "customer_id")),
                Choice("dealer_id", ("selling_dealer_id", "dealer_id")),
                Choice("registration_number", ("registration_number",)),
                Choice("production_date", ("manufacture_date", "production_date"), "date", True),
                Choice("delivery_date", ("sale_date", "delivery_date"), "date", True),
                Choice("warranty_start_date", ("warranty_start_date",), "date", True),
                Choice("warranty_end_date", ("warranty_end_date",), "date", True),
                Choice("current_odometer_km", ("current_odometer_km", "odometer_km"), "double"),
                Choice("odometer_km", ("odometer_km", "current_odometer_km"), "double"),
                Choice("vehicle_status", ("vehicle_status",)),
                Choice("color", ("color",)),
                Choice("engine_number", ("engine_number",)),
                Choice("chassis_number", ("chassis_number",)),
                Choice("powertrain_type", ("powertrain_type",)),
                Choice("emission_standard", ("emission_standard",)),
            ),
        ),
        Entity("part", ("part_id",)),
        Entity("failure_code", ("failure_code",)),
        Entity(
            "service_order",
            ("service_order_id",),
            derived=(
                _first("opened_timestamp", "open_timestamp", "created_timestamp"),
                _first("closed_timestamp", "close_timestamp", "completed_timestamp"),
                _day_of("open_date", "opened_timestamp"),
                _day_of("close_date", "closed_timestamp"),
                _sum_of("total_service_cost", "labor_cost", "parts_cost", "other_cost"),
                _constant("repeat_repair_count", 0),
            ),
        ),
        Entity(
            "repair_job",
            ("repair_job_id",),
            derived=(
                _day_of("repair_date", "completed_timestamp", "started_timestamp"),
                _product_of("labor_cost", "labor_hours", "labor_rate"),
            ),
        ),
        Entity(
            "part_consumption",
            ("part_consumption_id",),
            derived=(
                _product_of("extended_cost", "quantity", "unit_cost"),
                _day_of("consumption_date", "consumption_timestamp", "created_timestamp"),
            ),
        ),
        Entity(
            "warranty_claim",
            ("warranty_claim_id",),
            derived=(
                _earliest_known(
                    "decision_date", "claim_approved_date", "claim_rejected_date", "claim_submitted_date"
                ),
                _constant("claim_count", 1),
                _first("warranty_type", "claim_type", dtype="string"),
            ),
        ),
        Entity(
            "vehicle_daily_usage",
            ("usage_id",),
            derived=(_digest_of("usage_id", "vin", "usage_date"),),
        ),
        Entity(
            "breakdown",
            ("breakdown_id",),
            derived=(
                _day_of("breakdown_date", "breakdown_timestamp"),
                _day_of("resolved_date", "resolved_timestamp"),
            ),
        ),
    )
}


def entity_for(target: str, keys: Sequence[str] = ()) -> Entity:
    """The entity of a target table; a table without special work only gets its keys."""
    name = target.split(".")[-1]
    return ENTITIES.get(name, Entity(name, tuple(keys)))


def standardise_lineage(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Rename bronze lineage columns to ``source_*``, adding typed NULLs for absent ones."""
    stamp = F.current_timestamp() if load_ts is None else load_ts
    renames = {find_name(df, old): new for old, new in LINEAGE.items() if find_name(df, old)}
    out = df.withColumnsRenamed(renames) if renames else df
    absent = {}
    for new in LINEAGE.values():
        if find_name(out, new) is None:
            moment = new == LINEAGE["ingestion_timestamp"]
            absent[new] = stamp if moment else F.lit(None).cast("string")
    return out.withColumns(absent) if absent else out


def business_columns(df: DataFrame) -> list[str]:
    """Columns of a conformed frame that describe the record rather than how it arrived."""
    lineage = {n.lower() for n in LINEAGE.values()}
    return [c for c in df.columns if c.lower() not in lineage]


def conform(df: DataFrame, entity: Entity, load_ts: Column | None = None) -> DataFrame:
    """The entity's columns in canonical form, with lineage. A narrow transformation."""
    if entity.projection:
        pick = Picker(df)
        lineage = existing_names(df, LINEAGE)
        df = df.select(*[c.build(pick) for c in entity.projection], *[column(n) for n in lineage])
    else:
        df = derive_missing(df, entity.derived)
    return standardise_lineage(df, load_ts)


def latest(
    df: DataFrame, entity: Entity, keys: Sequence[str], sequence: str | Sequence[str] | None = None, load_ts: Column | None = None
) -> DataFrame:
    """The latest row per key in canonical form; ``keys`` and ``sequence`` are names of that form.

    Derived columns are added after the shuffle if neither the key nor the order needs them: where all other
    columns are equal they are too, so they decide no tie.
    """
    first = [sequence] if isinstance(sequence, str) else list(sequence or [])
    before = {new: old for old, new in LINEAGE.items()}
    given = {name: find_name(df, before.get(name, name)) for name in (*keys, *first)}
    # An absent lineage column is the same in all rows.
    needed = [n for n in (*keys, *first) if given[n] is None and not (n in first and n in before)]
    early = entity.projection or needed or any(k in LINEAGE or k in before for k in keys) or any(n in LINEAGE for n in first)
    if early or not all(orderable(f.dataType) for f in df.schema.fields):
        return latest_per_key(conform(df, entity, load_ts), keys, first)
    return conform(latest_per_key(df, [given[k] for k in keys], [given[n] for n in first if given[n]]), entity, load_ts)


def stamp(
    df: DataFrame,
    keys: Sequence[str],
    batch_id: str,
    load_ts: Column | None = None,
    hash_scope: str = "business",
) -> DataFrame:
    """Add load stamps and digests to a conformed frame.

    The record digest covers business columns, so a row that arrives again unchanged is
    recognised. ``hash_scope="all"`` covers lineage and stamps too, as older tables may
    have stored it; every match then counts as changed.
    """
    if hash_scope not in ("business", "all"):
        raise ValueError(f"unknown hash_scope {hash_scope!r}")
    covered = business_columns(df) if hash_scope == "business" else None
    moment = F.current_timestamp() if load_ts is None else load_ts
    stamped = df.withColumns(
        {
            "silver_batch_id": F.lit(batch_id),
            "silver_load_timestamp": moment,
            UPDATE_STAMP: moment,
            "is_valid": F.lit(True),
        }
    )
    return add_hashes(stamped, keys, covered)


def transform(
    df: DataFrame,
    target: str,
    batch_id: str,
    keys: Sequence[str] = (),
    load_ts: Column | None = None,
    hash_scope: str = "business",
) -> DataFrame:
    """Bronze rows as silver rows, before deduplication and quality rules."""
    entity = entity_for(target, keys)
    return stamp(conform(df, entity, load_ts), entity.keys, batch_id, load_ts, hash_scope)
