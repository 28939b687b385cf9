"""Gold dimensions and facts: surrogate keys, links and calendar keys over silver rows.

Links are recomputed from natural keys, so building any gold table is one projection: no
join and no shuffle. Facts stay at the grain of their silver source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import Picker, require_columns
from strata.functions.dates import date_key
from strata.functions.hashing import surrogate_key

Names = tuple[str, ...]


@dataclass(frozen=True)
class GoldTable:
    """A gold table: its key and, per added column, the silver names it is taken from."""

    name: str
    key: str
    natural_key: Names
    links: dict[str, Names] = field(default_factory=dict)
    date_keys: dict[str, Names] = field(default_factory=dict)
    measures: dict[str, tuple[Names, int]] = field(default_factory=dict)

    @property
    def is_dimension(self) -> bool:
        return self.name.startswith("dim_")


VEHICLE = ("vin",)
DEALER = ("dealer_id",)
CUSTOMER = ("customer_id",)
FAILURE_CODE = ("failure_code",)
PART = ("part_id", "part_number")

# Table and column names of the star, and the order in which alternatives
# are tried.
GOLD_TABLES: dict[str, GoldTable] = {
    t.name: t
    for t in (
        GoldTable("dim_vehicle_model", "vehicle_model_key", ("model_id",)),
        GoldTable("dim_customer", "customer_key", CUSTOMER),
        GoldTable("dim_dealer", "dealer_key", DEALER),
        GoldTable("dim_part", "part_key", PART),
        GoldTable("dim_failure_code", "failure_code_key", FAILURE_CODE),
        GoldTable("dim_vehicle", "vehicle_key", VEHICLE, links={"vehicle_model_key": ("model_id",)}),
        GoldTable(
            "fact_service_order",
            "service_order_key",
            ("service_order_id",),
            links={"vehicle_key": VEHICLE, "dealer_key": DEALER, "customer_key": CUSTOMER},
            date_keys={
                "open_date_key": ("open_date", "opened_timestamp"),
                "close_date_key": ("close_date", "closed_timestamp"),
            },
            measures={
                "total_service_cost": (("total_service_cost", "total_service_amount"), 0),
                "repeat_repair_count": (("repeat_repair_count",), 0),
            },
        ),
        GoldTable(
            "fact_repair_job",
            "repair_job_key",
            ("repair_job_id",),
            links={"vehicle_key": VEHICLE, "dealer_key": DEALER, "failure_code_key": FAILURE_CODE},
            date_keys={"repair_date_key": ("repair_date", "completed_timestamp", "started_timestamp")},
        ),
        GoldTable(
            "fact_part_consumption",
            "part_consumption_key",
            ("part_consumption_id",),
            links={"vehicle_key": VEHICLE, "dealer_key": DEALER, "part_key": PART},
            date_keys={"consumption_date_key": ("consumption_date", "consumption_timestamp")},
            measures={"extended_cost": (("extended_cost",), 0)},
        ),
        GoldTable(
            "fact_warranty_claim",
            "warranty_claim_key",
            ("warranty_claim_id",),
            links={"vehicle_key": VEHICLE, "dealer_key": DEALER},
            date_keys={
                "submitted_date_key": ("claim_submitted_date",),
                "decision_date_key": ("decision_date", "claim_approved_date", "claim_rejected_date"),
            },
            measures={"claim_count": (("claim_count",), 1)},
        ),
        GoldTable(
            "fact_vehicle_daily_usage",
            "vehicle_usage_key",
            ("usage_id",),
            links={"vehicle_key": VEHICLE, "customer_key": CUSTOMER},
            date_keys={"date_key": ("usage_date",)},
        ),
        GoldTable(
            "fact_breakdown",
            "breakdown_key",
            ("breakdown_id",),
            links={
                "vehicle_key": VEHICLE,
                "dealer_key": DEALER,
                "customer_key": CUSTOMER,
                "failure_code_key": FAILURE_CODE,
            },
            date_keys={
                "breakdown_date_key": ("breakdown_date", "breakdown_timestamp"),
                "resolved_date_key": ("resolved_date", "resolved_timestamp"),
            },
        ),
    )
}

DATE_DIMENSION = "dim_date"


def gold_table(target: str) -> GoldTable:
    name = target.split(".")[-1]
    if name not in GOLD_TABLES:
        raise ValueError(f"no gold table {name!r}; known: {sorted(GOLD_TABLES)}")
    return GOLD_TABLES[name]


def natural_key_name(df: DataFrame, table: GoldTable) -> str:
    """The silver column that identifies a row of the table."""
    pick = Picker(df)
    for name in table.natural_key:
        if pick.has(name):
            return name
    require_columns(df, table.natural_key[:1], table.name)
    raise AssertionError("unreachable")


def build_gold(
    df: DataFrame,
    target: str | GoldTable,
    *,
    key_algorithm: str = "murmur3",
    null_key: str = "hash",
    key_type: str | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """Silver rows plus a gold table's keys, links, calendar keys and stamps.

    ``key_type`` names the type natural keys are hashed as, for sources that do not agree.
    """
    table = target if isinstance(target, GoldTable) else gold_table(target)
    pick = Picker(df)
    moment = F.current_timestamp() if load_ts is None else load_ts

    def hashed(names: Names) -> Column | None:
        present = [n for n in names if pick.has(n)]
        if not present:
            return None
        natural = pick.first(*present)
        return surrogate_key(natural, algorithm=key_algorithm, null_key=null_key, as_type=key_type)

    def link(name: str, names: Names) -> Column:
        given = pick.first(name) if pick.has(name) and not table.is_dimension else None
        options = [c for c in (given, hashed(names)) if c is not None]
        return F.coalesce(*options) if options else F.lit(None).cast("bigint")

    natural_key_name(df, table)
    added = {table.key: hashed(table.natural_key)}
    added |= {name: link(name, names) for name, names in table.links.items()}
    added |= {
        name: date_key(pick.first(*names, dtype="date")) for name, names in table.date_keys.items()
    }
    added |= {
        name: pick.first(*names, default=default) for name, (names, default) in table.measures.items()
    }
    if table.is_dimension:
        added |= {
            "effective_from": moment,
            "effective_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    added |= {"created_timestamp": moment, "updated_timestamp": moment}
    return df.withColumns(added)
