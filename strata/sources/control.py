"""Control tables: their schemas, the shipped load and rule definitions, and look-ups."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import FAIL_PIPELINE, WARN, Rule


def _schema(text: str) -> T.StructType:
    """A nullable schema from ``name type, name type`` text."""
    fields = (part.split() for part in text.replace("\n", " ").split(",") if part.strip())
    types = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
        "timestamp": T.TimestampType(),
    }
    return T.StructType([T.StructField(name, types[kind]) for name, kind in fields])


# Column names of the control tables.
PIPELINE_CONFIG = _schema("""
    pipeline_id string, pipeline_name string, pipeline_group string,
    source_catalog string, source_schema string, source_object string, source_type string,
    target_catalog string, target_schema string, target_object string,
    load_type string, transformation_mode string, processing_notebook string,
    custom_transform_notebook string, audit_enabled boolean,
    primary_key_columns string, sequence_column string, watermark_column string,
    merge_condition string, execution_order int, retry_count int, timeout_minutes int,
    is_active boolean, created_by string, created_timestamp timestamp,
    updated_by string, updated_timestamp timestamp
""")
DATA_QUALITY_RULE = _schema("""
    rule_id string, pipeline_id string, rule_name string, rule_description string,
    rule_type string, column_name string, rule_expression string,
    reference_object string, reference_column string, severity string,
    failure_action string, threshold_value double, is_active boolean,
    created_by string, created_timestamp timestamp, updated_by string, updated_timestamp timestamp
""")
DATA_QUALITY_RESULT = _schema("""
    dq_result_id string, audit_id string, workflow_audit_id string, batch_id string,
    pipeline_id string, rule_id string, rule_name string, rule_type string, severity string,
    evaluated_row_count bigint, failed_row_count bigint, passed_row_count bigint,
    failure_percentage double, threshold_value double, rule_status string,
    failure_action string, evaluated_timestamp timestamp, sample_failed_records string
""")
REJECTED_RECORD = _schema("""
    rejection_id string, audit_id string, workflow_audit_id string, batch_id string,
    pipeline_id string, source_object string, target_object string, source_record string,
    rejection_reason string, failed_rule_ids string, severity string,
    source_file_name string, source_file_path string, rejected_timestamp timestamp
""")
PIPELINE_WATERMARK = _schema("""
    pipeline_id string, watermark_column string, previous_watermark string,
    current_watermark string, last_successful_batch_id string,
    last_successful_audit_id string, last_successful_run_timestamp timestamp,
    updated_timestamp timestamp
""")
PIPELINE_RUN_AUDIT = _schema("""
    audit_id string, workflow_audit_id string, batch_id string, pipeline_id string,
    pipeline_name string, pipeline_group string, source_object string, target_object string,
    load_type string, run_status string, start_timestamp timestamp, end_timestamp timestamp,
    duration_seconds bigint, rows_read bigint, rows_written bigint, rows_inserted bigint,
    rows_updated bigint, rows_deleted bigint, rows_rejected bigint, rows_duplicated bigint,
    rows_quarantined bigint, source_watermark string, target_watermark string,
    source_file_name string, source_file_path string, delta_table_version bigint,
    delta_operation string, delta_operation_metrics string, job_id string, job_run_id string,
    task_key string, notebook_path string, cluster_id string, error_code string,
    error_message string, error_stacktrace string, created_timestamp timestamp,
    updated_timestamp timestamp
""")
PIPELINE_EVENT_LOG = _schema("""
    event_id string, audit_id string, workflow_audit_id string, batch_id string,
    pipeline_id string, event_type string, event_level string, event_message string,
    event_payload string, event_timestamp timestamp
""")
WORKFLOW_RUN_AUDIT = _schema("""
    workflow_audit_id string, workflow_name string, workflow_run_name string, batch_id string,
    job_id string, job_run_id string, trigger_type string, triggered_by string,
    run_status string, start_timestamp timestamp, end_timestamp timestamp,
    duration_seconds bigint, total_pipelines bigint, successful_pipelines bigint,
    failed_pipelines bigint, skipped_pipelines bigint, warning_pipelines bigint,
    total_rows_read bigint, total_rows_inserted bigint, total_rows_updated bigint,
    total_rows_deleted bigint, total_rows_rejected bigint, error_code string,
    error_message string, created_timestamp timestamp, updated_timestamp timestamp
""")
PIPELINE_PARAMETER = _schema("pipeline_id string, parameter_name string, parameter_value string")
PIPELINE_DEPENDENCY = _schema("parent_pipeline_id string, child_pipeline_id string")

# Load types.
FULL, APPEND, MERGE, SCD1 = "FULL", "APPEND", "MERGE", "SCD1"
LOAD_TYPES = (FULL, APPEND, MERGE, SCD1)
DEFAULT_MODE = "METADATA"

# Id patterns of the shipped loads.
SILVER_PATTERN = "PL_SILVER_%"
GOLD_PATTERN = "PL_GOLD_%"

# Id suffix, title, bronze table, silver table, key, execution order.
SILVER_LOADS = (
    ("VEHICLE_MODEL", "Vehicle Model", "vehicle_model", "vehicle_model", "model_id", 10),
    ("DEALER", "Dealer", "dealer", "dealer", "dealer_id", 20),
    ("CUSTOMER", "Customer", "customer", "customer", "customer_id", 30),
    ("VEHICLE", "Vehicle", "vehicle", "vehicle", "vin", 40),
    ("PART", "Part", "part_master", "part", "part_id", 50),
    ("FAILURE_CODE", "Failure Code", "failure_code", "failure_code", "failure_code", 60),
    ("SERVICE_ORDER", "Service Order", "service_order", "service_order", "service_order_id", 70),
    ("REPAIR_JOB", "Repair Job", "repair_job", "repair_job", "repair_job_id", 80),
    ("PART_CONSUMPTION", "Part Consumption", "part_consumption", "part_consumption", "part_consumption_id", 90),
    ("WARRANTY_CLAIM", "Warranty Claim", "warranty_claim", "warranty_claim", "warranty_claim_id", 100),
    ("VEHICLE_USAGE", "Vehicle Usage", "vehicle_daily_usage", "vehicle_daily_usage", "usage_id", 110),
    ("BREAKDOWN", "Breakdown", "breakdown", "breakdown", "breakdown_id", 120),
)

# Id suffix, title, silver table, gold table, key, load type, execution order.
GOLD_LOADS = (
    ("DIM_DATE", "Date Dimension", "vehicle_daily_usage", "dim_date", "date_key", FULL, 10),
    ("DIM_VEHICLE_MODEL", "Vehicle Model Dimension", "vehicle_model", "dim_vehicle_model", "vehicle_model_key", MERGE, 20),
    ("DIM_CUSTOMER", "Customer Dimension", "customer", "dim_customer", "customer_key", MERGE, 30),
    ("DIM_DEALER", "Dealer Dimension", "dealer", "dim_dealer", "dealer_key", MERGE, 40),
    ("DIM_PART", "Part Dimension", "part", "dim_part", "part_key", MERGE, 50),
    ("DIM_FAILURE_CODE", "Failure Code Dimension", "failure_code", "dim_failure_code", "failure_code_key", MERGE, 60),
    ("DIM_VEHICLE", "Vehicle Dimension", "vehicle", "dim_vehicle", "vehicle_key", MERGE, 70),
    ("FACT_SERVICE_ORDER", "Service Order Fact", "service_order", "fact_service_order", "service_order_key", MERGE, 100),
    ("FACT_REPAIR_JOB", "Repair Job Fact", "repair_job", "fact_repair_job", "repair_job_key", MERGE, 110),
    ("FACT_PART_CONSUMPTION", "Part Consumption Fact", "part_consumption", "fact_part_consumption", "part_consumption_key", MERGE, 120),
    ("FACT_WARRANTY_CLAIM", "Warranty Claim Fact", "warranty_claim", "fact_warranty_claim", "warranty_claim_key", MERGE, 130),
    ("FACT_VEHICLE_DAILY_USAGE", "Vehicle Daily Usage Fact", "vehicle_daily_usage", "fact_vehicle_daily_usage", "vehicle_usage_key", MERGE, 140),
    ("FACT_BREAKDOWN", "Breakdown Fact", "breakdown", "fact_breakdown", "breakdown_key", MERGE, 150),
)

# Rule id, load id suffix, rule name, checked column.
NOT_NULL_RULES = (
    ("DQ_SILVER_VEHICLE_VIN_NOT_NULL", "VEHICLE", "VIN is not null", "vin"),
    ("DQ_SILVER_SERVICE_ORDER_ID_NOT_NULL", "SERVICE_ORDER", "Service order ID is not null", "service_order_id"),
    ("DQ_SILVER_REPAIR_JOB_ID_NOT_NULL", "REPAIR_JOB", "Repair job ID is not null", "repair_job_id"),
    ("DQ_SILVER_PART_CONSUMPTION_ID_NOT_NULL", "PART_CONSUMPTION", "Part consumption ID is not null", "part_consumption_id"),
    ("DQ_SILVER_WARRANTY_CLAIM_ID_NOT_NULL", "WARRANTY_CLAIM", "Warranty claim ID is not null", "warranty_claim_id"),
    ("DQ_SILVER_USAGE_ID_NOT_NULL", "VEHICLE_USAGE", "Usage ID is not null", "usage_id"),
    ("DQ_SILVER_BREAKDOWN_ID_NOT_NULL", "BREAKDOWN", "Breakdown ID is not null", "breakdown_id"),
)

DEFAULT_CATALOG = "warehouse"


@dataclass(frozen=True)
class LoadSpec:
    """One load: where from, where to, by which key and how."""

    pipeline_id: str
    pipeline_name: str
    pipeline_group: str
    source_object: str
    target_object: str
    load_type: str
    primary_key_columns: tuple[str, ...]
    sequence_column: str | None = None
    watermark_column: str | None = None
    transformation_mode: str = DEFAULT_MODE


def specs(config: DataFrame) -> DataFrame:
    """Load definitions as the fields of a :class:`LoadSpec`: full names, defaults, key lists."""

    def full_name(side: str) -> Column:
        parts = [F.col(f"{side}_{part}") for part in ("catalog", "schema", "object")]
        return F.concat_ws(".", *parts).alias(f"{side}_object")

    def or_else(name: str, default: Column) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), default).alias(name)

    keys = F.transform(F.split(F.coalesce("primary_key_columns", F.lit("")), ","), lambda key: F.trim(key))
    return config.select(
        "pipeline_id",
        or_else("pipeline_name", F.col("pipeline_id")),
        or_else("pipeline_group", F.lit("")),
        full_name("source"),
        full_name("target"),
        or_else("load_type", F.lit(MERGE)),
        F.filter(keys, lambda key: key != "").alias("primary_key_columns"),
        "sequence_column",
        "watermark_column",
        or_else("transformation_mode", F.lit(DEFAULT_MODE)),
    )


def _collected(found: DataFrame) -> list[LoadSpec]:
    return [LoadSpec(**{**r.asDict(), "primary_key_columns": tuple(r["primary_key_columns"])}) for r in found.collect()]


def active_load(config: DataFrame, pipeline_id: str) -> LoadSpec:
    found = _collected(specs(active_listing(config).filter(F.col("pipeline_id") == pipeline_id).limit(1)))
    if not found:
        raise ValueError(f"no active load {pipeline_id!r}")
    return found[0]


def active_listing(config: DataFrame, group: str | None = None) -> DataFrame:
    """Active loads, of one group or all, in execution order. Ties go by id."""
    active = config.filter(F.col("is_active"))
    if group:
        active = active.filter(F.col("pipeline_group") == group)
    return active.orderBy("execution_order", "pipeline_id")


def active_loads(config: DataFrame, group: str | None = None) -> list[LoadSpec]:
    """Specs of the listing, in one query. A control table has one row per load."""
    return _collected(specs(active_listing(config, group)))


def config_listing(config: DataFrame, patterns: Iterable[str] = (SILVER_PATTERN, GOLD_PATTERN)) -> DataFrame:
    """The configuration report: loads by group and execution order."""
    return (
        config.filter(id_matches("pipeline_id", patterns))
        .select("pipeline_group", "execution_order", "pipeline_id", "source_object", "target_object")
        .orderBy("pipeline_group", "execution_order", "pipeline_id")
    )


def group_counts(config: DataFrame, patterns: Iterable[str] = (SILVER_PATTERN, GOLD_PATTERN)) -> DataFrame:
    return (
        config.filter(id_matches("pipeline_id", patterns))
        .groupBy("pipeline_group")
        .agg(F.count(F.lit(1)).alias("pipeline_count"))
        .orderBy("pipeline_group")
    )


def id_matches(name: str, patterns: Iterable[str]) -> Column:
    condition = F.lit(False)
    for pattern in patterns:
        condition = condition | F.col(name).like(pattern)
    return condition


def replace_matching(
    table: DataFrame,
    fresh: DataFrame,
    names: Iterable[str] = ("pipeline_id",),
    patterns: Iterable[str] = (SILVER_PATTERN, GOLD_PATTERN),
) -> DataFrame:
    """Drop the rows whose id matches a pattern in any named column, then add ``fresh``.

    An unknown (NULL) id matches nothing, so its row stays.
    """
    matched = F.lit(False)
    for name in names:
        matched = matched | F.coalesce(id_matches(name, patterns), F.lit(False))
    return table.filter(~matched).unionByName(fresh)


def _seed_row(pipeline_id, name, group, source, target, load_type, key, order, catalog) -> dict:
    layers = {"SILVER": ("bronze", "silver"), "GOLD": ("silver", "gold")}[group]
    return {
        "pipeline_id": pipeline_id,
        "pipeline_name": name,
        "pipeline_group": group,
        "source_catalog": catalog,
        "source_schema": layers[0],
        "source_object": source,
        "source_type": "TABLE",
        "target_catalog": catalog,
        "target_schema": layers[1],
        "target_object": target,
        "load_type": load_type,
        "transformation_mode": "NOTEBOOK",
        "audit_enabled": True,
        "primary_key_columns": key,
        "watermark_column": "ingestion_timestamp",
        "execution_order": order,
        "retry_count": 1,
        "timeout_minutes": 60,
        "is_active": True,
        "created_by": "bootstrap",
        "updated_by": "bootstrap",
    }


def _frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    values = [tuple(row.get(name) for name in schema.names) for row in rows]
    stamps = [n for n in ("created_timestamp", "updated_timestamp") if n in schema.names]
    return spark.createDataFrame(values, schema).withColumns({n: F.current_timestamp() for n in stamps})


def seed_config(spark: SparkSession, catalog: str = DEFAULT_CATALOG) -> DataFrame:
    """The shipped loads: 12 silver and 13 gold."""
    rows = [
        _seed_row(f"PL_SILVER_{suffix}", f"Silver {title} Load", "SILVER", source, target, MERGE, key, order, catalog)
        for suffix, title, source, target, key, order in SILVER_LOADS
    ]
    rows += [
        _seed_row(f"PL_GOLD_{suffix}", f"Gold {title}", "GOLD", source, target, load_type, key, order, catalog)
        for suffix, title, source, target, key, load_type, order in GOLD_LOADS
    ]
    return _frame(spark, rows, PIPELINE_CONFIG)


def seed_rules(spark: SparkSession) -> DataFrame:
    """The shipped quality rules: keys of seven silver tables must not be NULL."""
    rows = [
        {
            "rule_id": rule_id,
            "pipeline_id": f"PL_SILVER_{suffix}",
            "rule_name": name,
            "rule_description": name.replace(" is not null", " must not be null"),
            "rule_type": "NOT_NULL",
            "column_name": col,
            "rule_expression": f"{col} IS NOT NULL",
            "severity": "CRITICAL",
            "failure_action": FAIL_PIPELINE,
            "threshold_value": 0.0,
            "is_active": True,
            "created_by": "bootstrap",
            "updated_by": "bootstrap",
        }
        for rule_id, suffix, name, col in NOT_NULL_RULES
    ]
    return _frame(spark, rows, DATA_QUALITY_RULE)


def active_rules(rules: DataFrame | None, pipeline_id: str) -> list[Rule]:
    """A load's active rules in order of rule id; no rule table means no rules."""
    if rules is None:
        return []
    own = rules.filter((F.col("pipeline_id") == pipeline_id) & F.col("is_active"))
    return [
        Rule(
            rule_id=r["rule_id"],
            rule_name=r["rule_name"],
            expression=None if r["reference_object"] else r["rule_expression"],
            failure_action=r["failure_action"] or WARN,
            rule_type=r["rule_type"],
            severity=r["severity"],
            threshold_value=r["threshold_value"],
            column_name=r["column_name"],
            reference_object=r["reference_object"] or None,
            reference_column=r["reference_column"] or r["column_name"],
        )
        for r in own.orderBy("rule_id").collect()
    ]
