"""Every operator as a query over the given tables.

Outputs are plain (text, numbers, dates, booleans): timestamps are cast to text, load times
and random ids are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import coalesce_existing, derive_missing, first_existing
from strata.functions.hashing import business_key_hash, collision_free_keys, link_keys, probed, record_hash, surrogate_key
from strata.operators import quality
from strata.operators.align import align, cast_failures
from strata.operators.calendar import calendar_columns, date_range_of
from strata.operators.dedupe import duplicate_counts, latest_per_key, repeated_keys
from strata.operators.history import merge_history
from strata.operators.merge import ACTION, fits_broadcast, merge_action_counts, merge_scd1
from strata.operators.quality import Rule
from strata.operators.references import resolve_references
from strata.plans import gold, silver
from strata.plans.audit import (
    RUN_LOG,
    complete_workflow,
    event_log,
    latest_runs,
    run_state,
    start_workflow,
    table_counts,
    workflow_rollup,
)
from strata.plans.loads import REJECT_LOG, RESULT_LOG, WATERMARK_LOG, SilverOptions, gold_load, run_group, silver_load
from strata.plans.reset import reset_control
from strata.sources import control, raw
from strata.sources.bucketed import BucketedTable, buckets_for
from strata.sources.control import LoadSpec
from strata.sources.folders import shared_folder
from strata.sources.lake import Lake
from strata.streaming.stream import file_stream, stream_silver, without_redelivery
from strata.streaming.watermark import advance_watermarks, incremental_slice, watermark_bounds, watermark_state

Query = Callable[[SparkSession, str], DataFrame]

BATCH = "B1"
USAGE_SEQUENCE = ("ts", "event_id")
# The two overlapping slices of repair jobs that the merge queries load one after another.
FIRST_UNTIL = "1999-01-01 00:00:00"
SECOND_AFTER = "1998-01-01 00:00:00"
SLICE_LOW, SLICE_HIGH = "1996-06-30 00:00:00", "1999-12-31 00:00:00"
STATE_UNTIL = "2024-01-15 00:00:00"


def load_time():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text."""
    texts = {
        f.name: F.col(f.name).cast("string")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    return df.withColumns(texts) if texts else df


# --- silver ---------------------------------------------------------------------------------


def bronze_of(target: str) -> str:
    return "part_master" if target == "part" else target


def silver_rows(df: DataFrame, target: str, batch_id: str = BATCH) -> DataFrame:
    """Bronze rows conformed, deduplicated and stamped."""
    entity = silver.entity_for(target)
    sequence = USAGE_SEQUENCE if target == "vehicle_daily_usage" else "source_ingestion_timestamp"
    latest = silver.latest(df, entity, entity.keys, sequence, load_time())
    return silver.stamp(latest, entity.keys, batch_id, load_time())


def silver_of(spark: SparkSession, folder: str, target: str) -> DataFrame:
    return silver_rows(raw.BRONZE[bronze_of(target)](spark, folder), target)


HIDDEN = ("silver_load_timestamp", "silver_update_timestamp", *silver.LINEAGE.values())


def silver_query(target: str) -> Query:
    return lambda spark, folder: plain(silver_of(spark, folder, target).drop(*HIDDEN))


# --- gold -----------------------------------------------------------------------------------


def gold_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source = {t: s for _, _, s, t, *_ in control.GOLD_LOADS}[name]
    return gold.build_gold(silver_of(spark, folder, source), name, load_ts=load_time())


def gold_query(name: str) -> Query:
    table = gold.GOLD_TABLES[name]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        built = gold_of(spark, folder, name)
        shown = [table.key, gold.natural_key_name(built, table), *table.links, *table.date_keys, *table.measures]
        if table.is_dimension:
            shown += ["effective_to", "is_current"]
        return plain(built.select(*shown))

    return query


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    days = date_range_of(raw.table(spark, folder, "orders"), F.col("o_orderdate"))
    return calendar_columns(days, load_time()).drop("created_timestamp", "updated_timestamp")


def gold_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts({name: gold_of(spark, folder, name) for name in gold.GOLD_TABLES})


# --- columns and digests --------------------------------------------------------------------


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return raw.table(spark, folder, "lineitem")


LINE_KEY = ("l_orderkey", "l_linenumber")


def hash_business_key(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem(spark, folder)
    return df.select(*LINE_KEY, business_key_hash(df, LINE_KEY).alias("business_key_hash"))


def hash_record(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem(spark, folder)
    return df.select(*LINE_KEY, record_hash(df).alias("record_hash"))


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of orders and customers, some customers being unknown."""
    orders = raw.table(spark, folder, "orders")
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return orders.select(
        "o_orderkey",
        surrogate_key("o_orderkey").alias("order_key"),
        surrogate_key(customer).alias("customer_key"),
        surrogate_key(customer, null_key="null").alias("known_customer_key"),
    )


def first_existing_query(spark: SparkSession, folder: str) -> DataFrame:
    df = raw.table(spark, folder, "orders").withColumn("spare", F.nullif("o_orderstatus", F.lit("F")))
    return df.select(
        "o_orderkey",
        first_existing(df, ["closed_at", "O_ORDERDATE"]).cast("string").alias("moment"),
        first_existing(df, ["discount", "rebate"], 0).alias("discount"),
        first_existing(df, ["remark"]).alias("remark"),
        first_existing(df, ["spare", "o_orderpriority"]).alias("by_presence"),
        coalesce_existing(df, ["spare", "o_orderpriority"]).alias("by_value"),
    )


def derive_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """One derived column is kept from the source, the others are computed."""
    orders = raw.service_order(spark, folder).withColumn("total_service_cost", F.col("labor_cost") * 2)
    derived = derive_missing(orders, silver.ENTITIES["service_order"].derived)
    return plain(derived)


def lineage_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Two of five lineage columns arrive, under other letter case."""
    rows = raw.table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("PIPELINE_ID"),
        F.col("ts").alias("Ingestion_Timestamp"),
    )
    return plain(silver.standardise_lineage(rows, load_time()))


ALIGN_TARGET = T.StructType(
    [
        T.StructField("L_ORDERKEY", T.StringType()),
        T.StructField("l_linenumber", T.LongType()),
        T.StructField("l_quantity", T.IntegerType()),
        T.StructField("l_shipdate", T.DateType()),
        T.StructField("l_extendedprice", T.StringType()),
        T.StructField("inspector", T.StringType()),
        T.StructField("inspected_on", T.DateType()),
        T.StructField("line_id", T.LongType()),
    ]
)


def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    return align(lineitem(spark, folder), ALIGN_TARGET, exclude=["LINE_ID"])


SIZE_TARGET = T.StructType(
    [T.StructField("p_partkey", T.LongType()), T.StructField("size_text", T.IntegerType())]
)


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    unit = F.when(F.col("p_type") == "ECONOMY", " in").otherwise("")
    return raw.table(spark, folder, "part").select("p_partkey", F.concat(F.col("p_size"), unit).alias("size_text"))


def align_blank_misfits(spark: SparkSession, folder: str) -> DataFrame:
    return align(_sizes(spark, folder), SIZE_TARGET, on_cast_error="null")


def align_misfits(spark: SparkSession, folder: str) -> DataFrame:
    df = _sizes(spark, folder)
    return df.filter(cast_failures(df, SIZE_TARGET))


# --- deduplication --------------------------------------------------------------------------


def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    return plain(latest_per_key(lineitem(spark, folder), LINE_KEY, "l_shipdate"))


def dedupe_unordered(spark: SparkSession, folder: str) -> DataFrame:
    """No sequence, and one key name the frame lacks: ties go by the other columns."""
    return plain(latest_per_key(raw.table(spark, folder, "events"), ["user_id", "event_type", "missing"]))


def dedupe_counts(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_counts(lineitem(spark, folder), LINE_KEY)


def repeated_key_report(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_keys(lineitem(spark, folder), LINE_KEY)


# --- merges ---------------------------------------------------------------------------------


def repair_job_slices(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of repair jobs, read up to one time and again from an earlier one."""
    jobs = raw.repair_job(spark, folder)
    name = "completed_timestamp"
    first = incremental_slice(jobs, name, None, FIRST_UNTIL)
    second = incremental_slice(jobs, name, SECOND_AFTER)
    return silver_rows(first, "repair_job"), silver_rows(second, "repair_job", "B2")


MERGED = ("repair_job_id", "vin", "labor_cost", "repair_date", "silver_batch_id", "record_hash")


def merge_query(spark: SparkSession, folder: str) -> DataFrame:
    target, source = repair_job_slices(spark, folder)
    merged = merge_scd1(target, source, ["repair_job_id"])
    return merged.select(*MERGED, F.col(ACTION).alias("action"))


def merge_measured(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert, written so that the source is broadcast when it was measured small."""
    target, source = repair_job_slices(spark, folder)
    lake = Lake(spark, shared_folder(spark, "merge"))
    source = lake.stage("repair_job", source)
    merged = merge_scd1(target, source, ["repair_job_id"], small_source=fits_broadcast(source))
    return merged.select(*MERGED, F.col(ACTION).alias("action"))


def merge_preserving(spark: SparkSession, folder: str) -> DataFrame:
    """Every match updates, one column keeps its first value, one is never written."""
    target, source = repair_job_slices(spark, folder)
    merged = merge_scd1(
        target,
        source,
        ["repair_job_id"],
        compare=None,
        preserve=["silver_batch_id"],
        exclude=["vin"],
    )
    return merged.select(*MERGED, F.col(ACTION).alias("action"))


def merge_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert into a bucketed table: only the second slice is shuffled."""
    target, source = repair_job_slices(spark, folder)
    jobs = raw.repair_job(spark, folder)
    rows = incremental_slice(jobs, "completed_timestamp", None, FIRST_UNTIL).count()
    table = BucketedTable(spark, f"repair_job_{uuid4().hex}", ["repair_job_id"], buckets_for(rows, 8))
    table.create(target)
    return table.merged(source).select(*MERGED, F.col(ACTION).alias("action"))


def merge_history_query(spark: SparkSession, folder: str) -> DataFrame:
    """Vehicles by month of order: a load, one with late and equal months, and that one again."""
    orders = raw.service_order(spark, folder).select(
        "vin", F.date_trunc("month", "open_timestamp").alias("month"), "service_order_id", "labor_cost"
    )
    first, second = (orders.filter(F.col("service_order_id") % 3 == 0), orders.filter(F.col("service_order_id") % 3 == 1))
    held = merge_history(None, first, ["vin"], "month")
    held = merge_history(held, second, ["vin"], "month")
    return plain(merge_history(held, second, ["vin"], "month"))


COLLIDING_BITS = 20


def surrogate_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of few bits, so that many collide: given out in two loads, and linked to by facts."""
    jobs = raw.repair_job(spark, folder)
    early = incremental_slice(jobs, "completed_timestamp", None, FIRST_UNTIL)
    known = collision_free_keys(early, "repair_job_id", bits=COLLIDING_BITS)
    keys = known.unionByName(collision_free_keys(jobs, "repair_job_id", known, COLLIDING_BITS))
    exceptions = _lake(spark, "keys").stage("exceptions", probed(keys, COLLIDING_BITS))
    facts = raw.part_consumption(spark, folder).select("part_consumption_id", "part_id")
    linked = link_keys(facts, "part_consumption_id", "repair_job_key", exceptions, fits_broadcast(exceptions), COLLIDING_BITS)
    return linked.select("part_consumption_id", "part_id", "repair_job_key")


def merge_actions(spark: SparkSession, folder: str) -> DataFrame:
    target, source = repair_job_slices(spark, folder)
    return merge_action_counts(merge_scd1(target, source, ["repair_job_id"]))


# --- quality --------------------------------------------------------------------------------

DQ_RULES = (
    Rule("Q1", "Tax below eight percent", "l_tax < 0.08", quality.WARN, "RANGE", "LOW"),
    Rule("Q2", "More than five pieces", "l_quantity > 5", quality.QUARANTINE, "RANGE"),
    Rule("Q3", "Discount at most nine percent", "l_discount <= 0.09", quality.DROP_RECORD, "RANGE"),
    Rule("Q4", "Order known", "l_orderkey IS NOT NULL", quality.FAIL_PIPELINE, "NOT_NULL"),
    Rule("Q5", "Not returned", "l_returnflag <> 'R'", quality.QUARANTINE, "DOMAIN"),
    Rule("Q6", "At most six lines", "l_linenumber < 7", quality.WARN, "RANGE", "LOW"),
)
STOPPING_RULES = (*DQ_RULES[:4], Rule("Q4B", "Price known", "l_extendedprice < 90000", quality.FAIL_PIPELINE), *DQ_RULES[4:])
DQ_SHOWN = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")


def dq_input(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with some values unknown, so that predicates become unknown too."""
    return lineitem(spark, folder).withColumns(
        {
            "l_quantity": F.nullif("l_quantity", F.lit(50.0)),
            "l_returnflag": F.nullif("l_returnflag", F.lit("A")),
        }
    )


def dq_good(policy: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        classified = quality.classify(dq_input(spark, folder), DQ_RULES, policy)
        return quality.good_rows(classified).select(*DQ_SHOWN, "dq_status", "dq_error_message")

    return query


def dq_rejected(spark: SparkSession, folder: str) -> DataFrame:
    classified = quality.classify(dq_input(spark, folder), DQ_RULES)
    rejected = quality.rejected_rows(classified, DQ_RULES)
    return rejected.select(*DQ_SHOWN, "dq_status", "dq_error_message", F.col(quality.FAILED_RULE).alias("failed_rule_id"))


def dq_reject_records(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rejects, their JSON payload read back."""
    classified = quality.classify(dq_input(spark, folder), DQ_RULES)
    records = quality.reject_records(
        quality.rejected_rows(classified, DQ_RULES),
        audit_id="A1",
        batch_id=BATCH,
        pipeline_id="P1",
        source_object="lineitem",
        target_object="good_lines",
        rejected_ts=load_time(),
    )
    payload = F.from_json("source_record", "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, dq_status string")
    return records.select(
        payload.alias("p"), "audit_id", "source_object", "target_object", "rejection_reason", "failed_rule_ids", "severity"
    ).select("p.*", "audit_id", "source_object", "target_object", "rejection_reason", "failed_rule_ids", "severity")


def dq_results(rules: tuple[Rule, ...]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        classified = quality.classify(dq_input(spark, folder), rules)
        return quality.rule_counts(classified, rules)

    return query


REFERENCE_RULES = (
    DQ_RULES[1],
    Rule("R1", "Supplier known", None, quality.WARN, "REFERENTIAL", "LOW", 0.0, "l_suppkey", "supplier", "s_suppkey"),
    Rule("R2", "Part known", None, quality.QUARANTINE, "REFERENTIAL", "HIGH", 0.0, "l_partkey", "part", "p_partkey"),
    DQ_RULES[4],
    Rule(
        "R3", "Order of this day known", None, quality.DROP_RECORD, "REFERENTIAL", "HIGH", 0.0,
        "l_orderkey, l_shipdate", "order_day", "o_orderkey, day",
    ),
)


def _reference(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Reference tables in which some keys are missing, repeated, or of another type."""
    if name == "part":
        return raw.table(spark, folder, "part").filter("p_type <> 'ECONOMY'").select(F.col("p_partkey").cast("string"))
    if name == "order_day":
        lines = lineitem(spark, folder).filter("l_linenumber % 3 <> 1")
        return lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("day"))
    suppliers = raw.table(spark, folder, "supplier").filter("s_acctbal > 0")
    return suppliers.unionByName(suppliers)


def _referential(spark: SparkSession, folder: str) -> tuple[DataFrame, list[Rule]]:
    lines = dq_input(spark, folder).withColumn("l_partkey", F.nullif("l_partkey", F.lit(7)))
    rows, rules = resolve_references(
        lines, REFERENCE_RULES, partial(_reference, spark, folder), lambda df: _lake(spark, "missing").stage("missing", df)
    )
    return quality.classify(rows, rules), rules


THRESHOLD_RULES = (
    Rule("T1", "Tax below eight percent", "l_tax < 0.08", quality.WARN, "RANGE", "LOW", 50.0),
    Rule("T2", "More than five pieces", "l_quantity > 5", quality.QUARANTINE, "RANGE", "HIGH", 5.0),
    Rule("T3", "Discount at most nine percent", "l_discount <= 0.09", quality.FAIL_PIPELINE, "RANGE", "HIGH", 40.0),
    Rule("T4", "Not returned", "l_returnflag <> 'R'", quality.FAIL_PIPELINE, "DOMAIN", "HIGH", 10.0),
    Rule("T5", "At most six lines", "l_linenumber < 7", quality.WARN, "RANGE", "LOW", 0.0),
)


def dq_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Two rules that would stop a load: one tolerates its failed rows, the other doesn't."""
    classified = quality.classify(dq_input(spark, folder), THRESHOLD_RULES)
    return quality.rule_counts(classified, THRESHOLD_RULES, thresholds=True)


def dq_threshold_load(spark: SparkSession, folder: str) -> DataFrame:
    """A load that goes on although a rule that stops it has failed rows, within its threshold."""
    lake = _lake(spark, "threshold")
    spec = spec_for("repair_job", "bronze.repair_job", control.MERGE, ("repair_job_id",), None, "completed_timestamp")
    rules = [Rule("HOURS", "At least two hours", "labor_hours >= 2", quality.FAIL_PIPELINE, threshold_value=10.0)]
    options = SilverOptions(load_ts=load_time(), enforce_thresholds=True)
    silver_load(lake, spec, "B1", source=raw.repair_job(spark, folder), rules=rules, options=options)
    return lake.read("repair_job").select(*MERGED, "dq_status")


def dq_referential(spark: SparkSession, folder: str) -> DataFrame:
    classified, rules = _referential(spark, folder)
    good = quality.good_rows(classified).withColumn(quality.FAILED_RULE, F.lit(None).cast("string"))
    both = good.unionByName(quality.rejected_rows(classified, rules))
    return both.select(*DQ_SHOWN, "dq_status", "dq_error_message", F.col(quality.FAILED_RULE).alias("failed_rule_id"))


def dq_referential_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rule_counts(*_referential(spark, folder))


def dq_result_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts in the stored shape, without the random id and the time."""
    counts = quality.rule_counts(quality.classify(dq_input(spark, folder), DQ_RULES, "fail"), DQ_RULES, "fail")
    stored = quality.rule_results(counts, audit_id="A1", batch_id=BATCH, pipeline_id="P1", evaluated_ts=load_time())
    return stored.drop("dq_result_id", "evaluated_timestamp")


# --- incremental ----------------------------------------------------------------------------


def incremental(spark: SparkSession, folder: str) -> DataFrame:
    return plain(incremental_slice(raw.table(spark, folder, "orders"), "o_orderdate", SLICE_LOW, SLICE_HIGH))


def incremental_lag(spark: SparkSession, folder: str) -> DataFrame:
    return plain(incremental_slice(raw.table(spark, folder, "events"), "ts", STATE_UNTIL, lag="6 hours"))


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    pending = incremental_slice(raw.table(spark, folder, "events"), "ts", STATE_UNTIL)
    return watermark_bounds(pending, "ts")


def _moves(events: DataFrame, batch_id: str) -> DataFrame:
    return (
        events.groupBy(F.concat(F.lit("PL_"), F.upper("event_type")).alias("pipeline_id"))
        .agg(F.max("ts").cast("string").alias("current_watermark"))
        .select(
            "pipeline_id",
            F.lit("ts").alias("watermark_column"),
            F.lit(None).cast("string").alias("previous_watermark"),
            "current_watermark",
            F.lit(batch_id).alias("last_successful_batch_id"),
            F.concat(F.lit("A-"), F.col("pipeline_id")).alias("last_successful_audit_id"),
            load_time().alias("last_successful_run_timestamp"),
            load_time().alias("updated_timestamp"),
        )
    )


def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    """Each event type is a load; sign-ups have no state yet, errors do not move."""
    events = raw.table(spark, folder, "events")
    state = _moves(events.filter((F.col("ts") <= STATE_UNTIL) & (F.col("event_type") != "signup")), "B1")
    moves = _moves(events.filter((F.col("ts") > STATE_UNTIL) & (F.col("event_type") != "error")), "B2")
    return advance_watermarks(state, moves).drop("last_successful_run_timestamp", "updated_timestamp")


# --- control tables -------------------------------------------------------------------------


def config_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as load definitions: one per part, grouped by brand, ordered by size."""
    layer = F.when(F.col("p_type") == "ECONOMY", "PL_GOLD_").when(F.col("p_type") == "STANDARD", "PL_OTHER_").otherwise("PL_SILVER_")
    return raw.table(spark, folder, "part").select(
        F.concat(layer, F.col("p_partkey")).alias("pipeline_id"),
        F.col("p_brand").alias("pipeline_group"),
        F.col("p_name").alias("source_object"),
        F.concat(F.lit("t_"), F.col("p_name")).alias("target_object"),
        F.col("p_size").alias("execution_order"),
        (F.col("p_size") % 3 != 0).alias("is_active"),
    )


def load_listing(spark: SparkSession, folder: str) -> DataFrame:
    return control.active_listing(config_rows(spark, folder))


def load_group_listing(spark: SparkSession, folder: str) -> DataFrame:
    return control.active_listing(config_rows(spark, folder), "Brand#2")


def config_report(spark: SparkSession, folder: str) -> DataFrame:
    return control.config_listing(config_rows(spark, folder))


def load_group_counts(spark: SparkSession, folder: str) -> DataFrame:
    return control.group_counts(config_rows(spark, folder))


def config_reset(spark: SparkSession, folder: str) -> DataFrame:
    """Matching definitions are dropped and the active ones added anew."""
    config = config_rows(spark, folder)
    fresh = config.filter("is_active").withColumn("pipeline_group", F.lit("RESET"))
    return control.replace_matching(config, fresh)


def _control_lake(spark: SparkSession, folder: str) -> Lake:
    """Control tables of all parts: definitions, rules, parameters, dependencies, watermarks."""
    lake = _lake(spark, "control")
    config = config_rows(spark, folder)
    part = config.select("pipeline_id", "source_object", "execution_order")
    lake.overwrite("pipeline_config", config, "B1")
    rules = part.filter("execution_order > 20")
    lake.overwrite("data_quality_rule", rules.select("pipeline_id", F.col("source_object").alias("rule_id")), "B1")
    parameters = part.filter("execution_order <= 30")
    lake.overwrite("pipeline_parameter", parameters.select(
        "pipeline_id", F.lit("order").alias("parameter_name"), F.col("execution_order").cast("string").alias("parameter_value")), "B1")
    lake.overwrite("pipeline_dependency", part.select(
        F.when(F.col("execution_order") % 2 == 0, F.col("source_object")).otherwise(F.col("pipeline_id")).alias("parent_pipeline_id"),
        F.when(F.col("execution_order") % 5 == 0, F.col("pipeline_id")).otherwise(F.col("source_object")).alias("child_pipeline_id")), "B1")
    moves = part.select(
        "pipeline_id", F.lit("ts").alias("watermark_column"), F.lit("0").alias("previous_watermark"),
        F.col("execution_order").cast("string").alias("current_watermark"), F.lit("B1").alias("last_successful_batch_id"),
        F.lit("A1").alias("last_successful_audit_id"), load_time().alias("last_successful_run_timestamp"),
        load_time().alias("updated_timestamp"))
    lake.append_log(WATERMARK_LOG, control.PIPELINE_WATERMARK, moves)
    return lake


def control_reset(spark: SparkSession, folder: str) -> DataFrame:
    """What the five tables hold after a reset that adds some definitions and rules anew."""
    lake = _control_lake(spark, folder)
    config = config_rows(spark, folder).filter("is_active").withColumn("pipeline_group", F.lit("RESET"))
    rules = config.filter("execution_order > 40").select("pipeline_id", F.lit("NEW").alias("rule_id"))
    reset_control(lake, "B2", {"pipeline_config": config, "data_quality_rule": rules})
    state = watermark_state(lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK))
    shown = {
        "pipeline_config": (lake.read("pipeline_config"), "pipeline_id", "pipeline_group"),
        "data_quality_rule": (lake.read("data_quality_rule"), "pipeline_id", "rule_id"),
        "pipeline_parameter": (lake.read("pipeline_parameter"), "pipeline_id", "parameter_value"),
        "pipeline_dependency": (lake.read("pipeline_dependency"), "parent_pipeline_id", "child_pipeline_id"),
        "pipeline_watermark": (state, "pipeline_id", "current_watermark"),
    }
    frames = [df.select(F.lit(n).alias("table_name"), F.col(a).alias("id"), F.col(b).alias("detail")) for n, (df, a, b) in shown.items()]
    return reduce(DataFrame.unionByName, frames)


def control_reset_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two incremental loads, a reset, and the next load, which reads all rows again."""
    lake = _lake(spark, "reset")
    spec = spec_for("service_order", "bronze.service_order", control.APPEND, ("service_order_id",), "open_timestamp")
    spec = replace(spec, pipeline_id="PL_SILVER_ORDER")
    orders = raw.service_order(spark, folder)
    silver_load(lake, spec, "B1", source=incremental_slice(orders, "open_timestamp", None, SLICE_HIGH))
    silver_load(lake, spec, "B2", source=orders)
    reset_control(lake, "R1")
    silver_load(lake, spec, "B3", source=orders)
    silver_load(lake, spec, "B4", source=orders)
    return lake.read("service_order").select(*ORDER_SHOWN, "silver_batch_id")


def run_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run-audit rows: a user's day is a run, each event a later state of it."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "signup", "RUNNING").when(kind == "error", "FAILED").when(kind == "view", "SKIPPED").otherwise("SUCCESS")
    )
    day = F.col("ts").cast("date").cast("string")
    ts = F.col("ts").cast("timestamp")
    amount = F.floor("value").cast("bigint")
    return raw.table(spark, folder, "events").select(
        F.concat_ws("/", day, F.col("user_id")).alias("audit_id"),
        F.concat(F.lit("W-"), day).alias("workflow_audit_id"),
        day.alias("batch_id"),
        F.concat(F.lit("PL_"), F.col("user_id")).alias("pipeline_id"),
        status.alias("run_status"),
        F.col("ts").cast("date").cast("timestamp").alias("start_timestamp"),
        ts.alias("end_timestamp"),
        ts.alias("updated_timestamp"),
        amount.alias("rows_read"),
        F.nullif(F.floor(F.col("value") / 2).cast("bigint"), F.lit(0)).alias("rows_inserted"),
        F.floor(F.col("value") / 4).cast("bigint").alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
        F.when(kind == "click", F.lit(0)).otherwise(F.floor(F.col("value") / 50)).cast("bigint").alias("rows_rejected"),
        F.when(kind == "error", F.col("props")).alias("error_message"),
        "event_id",
    )


def _run_states(spark: SparkSession, folder: str) -> DataFrame:
    return run_state(run_rows(spark, folder), ("updated_timestamp", "event_id"))


def run_states(spark: SparkSession, folder: str) -> DataFrame:
    return _run_states(spark, folder).select("audit_id", "workflow_audit_id", "run_status", "rows_read", "event_id")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return plain(event_log(run_rows(spark, folder)))


def rollup(spark: SparkSession, folder: str) -> DataFrame:
    return workflow_rollup(_run_states(spark, folder)).drop("start_timestamp", "end_timestamp")


def newest_runs(spark: SparkSession, folder: str) -> DataFrame:
    return plain(latest_runs(_run_states(spark, folder)))


# --- whole loads ----------------------------------------------------------------------------


def spec_for(target: str, source: str, load_type: str, keys: tuple[str, ...], watermark: str | None = None, sequence: str | None = None) -> LoadSpec:
    return LoadSpec(f"PL_{target.upper()}", target, "SILVER", source, target, load_type, keys, sequence, watermark)


def _lake(spark: SparkSession, name: str) -> Lake:
    return Lake(spark, shared_folder(spark, name))


ORDER_SHOWN = ("service_order_id", "vin", "dealer_id", "open_date", "total_service_cost", "business_key_hash", "record_hash")


def write_full(spark: SparkSession, folder: str) -> DataFrame:
    """A full load replaces what an earlier load wrote."""
    lake = _lake(spark, "full")
    spec = spec_for("service_order", "bronze.service_order", control.FULL, ("service_order_id",))
    orders = raw.service_order(spark, folder)
    silver_load(lake, spec, "B0", source=incremental_slice(orders, "open_timestamp", None, SLICE_LOW))
    silver_load(lake, spec, BATCH, source=orders)
    return lake.read("service_order").select(*ORDER_SHOWN, "silver_batch_id", "dq_status")


def write_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads from one source: the second starts where the first one's watermark ended."""
    lake = _lake(spark, "append")
    spec = spec_for("service_order", "bronze.service_order", control.APPEND, ("service_order_id",), "open_timestamp")
    orders = raw.service_order(spark, folder)
    silver_load(lake, spec, "B1", source=incremental_slice(orders, "open_timestamp", None, SLICE_HIGH))
    silver_load(lake, spec, "B2", source=orders)
    return lake.read("service_order").select(*ORDER_SHOWN, "silver_batch_id")


def _merged_lake(spark: SparkSession, folder: str, part_column: str | None = None) -> Lake:
    lake = _lake(spark, "silver")
    spec = spec_for("repair_job", "bronze.repair_job", control.MERGE, ("repair_job_id",), "completed_timestamp", "completed_timestamp")
    jobs = raw.repair_job(spark, folder)
    rules = [Rule("HOURS", "At least two hours", "labor_hours >= 2", quality.QUARANTINE)]
    options = SilverOptions(load_ts=load_time(), part_column=part_column)
    first = incremental_slice(jobs, "completed_timestamp", None, FIRST_UNTIL)
    silver_load(lake, spec, "B1", source=first, rules=rules, options=options)
    silver_load(lake, spec, "B2", source=jobs, rules=rules, options=options)
    return lake


def silver_load_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _merged_lake(spark, folder).read("repair_job").select(*MERGED, "dq_status")


def silver_load_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads into a table kept in parts."""
    return _merged_lake(spark, folder, "failure_code").read("repair_job").select(*MERGED, "dq_status")


def silver_load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    log = _merged_lake(spark, folder).log(REJECT_LOG, control.REJECTED_RECORD)
    return log.select(
        "batch_id", F.get_json_object("source_record", "$.repair_job_id").cast("bigint").alias("repair_job_id"), "rejection_reason"
    )


def silver_load_results(spark: SparkSession, folder: str) -> DataFrame:
    log = _merged_lake(spark, folder).log(RESULT_LOG, control.DATA_QUALITY_RESULT)
    return log.select("batch_id", "rule_id", "evaluated_row_count", "failed_row_count", "passed_row_count", "rule_status")


def silver_load_watermark(spark: SparkSession, folder: str) -> DataFrame:
    log = _merged_lake(spark, folder).log(WATERMARK_LOG, control.PIPELINE_WATERMARK)
    return watermark_state(log).select(
        "pipeline_id", "watermark_column", "previous_watermark", "current_watermark", "last_successful_batch_id"
    )


def gold_load_query(incremental: bool) -> Query:
    return lambda spark, folder: _gold_loads(spark, folder, incremental)


def _gold_loads(spark: SparkSession, folder: str, incremental: bool) -> DataFrame:
    """A fact is built from the silver table after each of two silver loads."""
    lake = _lake(spark, "gold")
    silver_spec = spec_for("service_order", "bronze.service_order", control.MERGE, ("service_order_id",))
    gold_spec = LoadSpec(
        "PL_FACT", "fact", "GOLD", "service_order", "fact_service_order", control.MERGE, ("service_order_key",)
    )
    orders = raw.service_order(spark, folder)
    silver_load(lake, silver_spec, "B1", source=incremental_slice(orders, "open_timestamp", None, SLICE_HIGH))
    gold_load(lake, gold_spec, "G1", incremental=incremental)
    silver_load(lake, silver_spec, "B2", source=orders)
    gold_load(lake, gold_spec, "G2", incremental=incremental)
    return lake.read("fact_service_order").select(
        "service_order_key", "service_order_id", "vehicle_key", "dealer_key", "customer_key", "open_date_key",
        "close_date_key", "total_service_cost", "repeat_repair_count", "silver_batch_id",
    )


def stream_query(spark: SparkSession, folder: str) -> DataFrame:
    """Usage rows loaded from a file stream."""
    root = shared_folder(spark, "stream")
    lake = Lake(spark, f"{root}/lake")
    events = raw.table(spark, folder, "events")
    stream = file_stream(spark, folder, events.schema, "events.parquet")
    usage = stream.select(
        F.col("user_id").alias("vin"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("usage_date"),
        "ts",
        "event_id",
        F.col("value").alias("distance_km"),
    )
    spec = spec_for("vehicle_daily_usage", "bronze.usage", control.MERGE, ("usage_id",), None, "ts")
    options = SilverOptions(load_ts=load_time())
    stream_silver(lake, usage, spec, f"{root}/checkpoint", options=options).awaitTermination()
    return plain(lake.read("vehicle_daily_usage").select(
        "usage_id", "vin", "usage_date", "ts", "event_id", "distance_km", "business_key_hash", "record_hash"
    ))


STREAM_FILES = 4


def stream_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """Usage rows in files that come newest first, the last one twice: what one batch would give."""
    root = shared_folder(spark, "stream")
    lake = Lake(spark, f"{root}/lake")
    events = raw.table(spark, folder, "events")
    number = F.floor(F.datediff(F.col("ts"), F.lit("1970-01-01")) / 7) % STREAM_FILES
    for i in [*reversed(range(STREAM_FILES)), 0]:
        events.filter(number == i).coalesce(1).write.mode("append").parquet(f"{root}/files")
    stream = file_stream(spark, f"{root}/files", events.schema, max_files=1)
    usage = without_redelivery(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_id"], "3650 days")
    usage = usage.select(
        F.col("user_id").alias("vin"), F.col("user_id").alias("customer_id"), F.col("ts").cast("date").alias("usage_date"),
        F.col("ts").cast(events.schema["ts"].dataType).alias("ts"), "event_id", F.col("value").alias("distance_km"),
    )
    spec = spec_for("vehicle_daily_usage", "bronze.usage", control.MERGE, ("usage_id",), None, "ts")
    stream_silver(lake, usage, spec, f"{root}/checkpoint", options=SilverOptions(load_ts=load_time())).awaitTermination()
    return plain(lake.read("vehicle_daily_usage").select(
        "usage_id", "vin", "usage_date", "ts", "event_id", "distance_km", "business_key_hash", "record_hash"
    ))


def _audited_loads(spark: SparkSession, folder: str) -> tuple[Lake, str]:
    """A workflow of three loads of one group: one succeeds, one rejects rows, one is stopped."""
    lake = _lake(spark, "group")
    jobs = raw.repair_job(spark, folder)
    config = [
        ("PL_ORDER", "service_order", "service_order_id", None, 1),
        ("PL_JOB", "repair_job", "repair_job_id", "completed_timestamp", 2),
        ("PL_BREAKDOWN", "breakdown", "breakdown_id", None, 3),
        ("PL_OFF", "dealer", "dealer_id", None, 0),
    ]
    names = control.PIPELINE_CONFIG.names
    rows = [
        tuple({
            "pipeline_id": pipeline, "pipeline_group": "SILVER", "source_catalog": "w", "source_schema": "bronze",
            "source_object": name, "target_catalog": "w", "target_schema": "silver", "target_object": name, "load_type": "MERGE",
            "primary_key_columns": key, "sequence_column": sequence, "execution_order": order, "is_active": pipeline != "PL_OFF",
        }.get(c) for c in names)
        for pipeline, name, key, sequence, order in config
    ]
    for name in ("service_order", "breakdown"):
        lake.overwrite(f"w.bronze.{name}", raw.BRONZE[name](spark, folder), "B0")
    lake.overwrite("w.bronze.repair_job", jobs, "B0")
    shown = "rule_id string, pipeline_id string, rule_name string, rule_type string, column_name string, rule_expression string, " \
        "reference_object string, reference_column string, severity string, failure_action string, threshold_value double, is_active boolean"
    rules = spark.createDataFrame([
        ("HOURS", "PL_JOB", "At least two hours", None, None, "labor_hours >= 2", None, None, None, "QUARANTINE", 0.0, True),
        ("CODE", "PL_BREAKDOWN", "Failure code below three", None, None, "failure_code < 3", None, None, None, "FAIL_PIPELINE", 0.0, True),
    ], shown)
    ids = start_workflow(lake, "nightly", batch_id=BATCH)
    control_rows = spark.createDataFrame(rows, control.PIPELINE_CONFIG)
    try:
        run_group(lake, control_rows, "SILVER", BATCH, rules=rules, workflow_audit_id=ids["workflow_audit_id"])
    except quality.DataQualityError:
        pass
    return lake, ids["workflow_audit_id"]


def group_run(spark: SparkSession, folder: str) -> DataFrame:
    """Tables after a group's active loads ran in order, until one was stopped by its rule."""
    lake, _ = _audited_loads(spark, folder)
    names = ("service_order", "repair_job", "breakdown", "dealer")
    found = {name: lake.find(f"w.silver.{name}") for name in names}
    return table_counts({name: df if df is not None else spark.range(0) for name, df in found.items()})


AUDIT_SHOWN = ("pipeline_id", "run_status", "rows_read", "rows_inserted", "rows_updated", "rows_rejected", "rows_duplicated", "error_code")


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the loads of a group wrote about themselves: each run's latest state."""
    lake, _ = _audited_loads(spark, folder)
    return run_state(lake.log(RUN_LOG, control.PIPELINE_RUN_AUDIT)).select(*AUDIT_SHOWN)


def workflow_completed(spark: SparkSession, folder: str) -> DataFrame:
    """The workflow's finished row, one of whose loads failed."""
    lake, workflow = _audited_loads(spark, folder)
    done = complete_workflow(lake, workflow, BATCH)
    return done.select(
        "workflow_name", "batch_id", "trigger_type", "run_status", "total_pipelines", "successful_pipelines", "failed_pipelines",
        "warning_pipelines", "total_rows_read", "total_rows_inserted", "total_rows_rejected",
    )


QUERIES: dict[str, Query] = {
    **{f"silver_{name}": silver_query(name) for name in silver.ENTITIES},
    "dim_date": dim_date,
    **{name: gold_query(name) for name in gold.GOLD_TABLES},
    "gold_row_counts": gold_row_counts,
    "hash_business_key": hash_business_key,
    "hash_record": hash_record,
    "surrogate_key": surrogate_keys,
    "first_existing": first_existing_query,
    "derive_if_absent": derive_if_absent,
    "lineage_columns": lineage_columns,
    "align_schema": align_schema,
    "align_blank_misfits": align_blank_misfits,
    "align_misfits": align_misfits,
    "dedupe_latest": dedupe_latest,
    "dedupe_unordered": dedupe_unordered,
    "dedupe_counts": dedupe_counts,
    "repeated_keys": repeated_key_report,
    "merge_scd1": merge_query,
    "merge_measured": merge_measured,
    "merge_preserving": merge_preserving,
    "merge_actions": merge_actions,
    "merge_bucketed": merge_bucketed,
    "merge_history": merge_history_query,
    "surrogate_collisions": surrogate_collisions,
    "dq_good": dq_good("pass"),
    "dq_good_strict": dq_good("fail"),
    "dq_rejected": dq_rejected,
    "dq_reject_records": dq_reject_records,
    "dq_results": dq_results(DQ_RULES),
    "dq_results_stopped": dq_results(STOPPING_RULES),
    "dq_result_rows": dq_result_rows,
    "dq_threshold": dq_threshold,
    "dq_threshold_load": dq_threshold_load,
    "dq_referential": dq_referential,
    "dq_referential_counts": dq_referential_counts,
    "incremental_slice": incremental,
    "incremental_lag": incremental_lag,
    "watermark_bounds": bounds,
    "watermark_advance": watermark_advance,
    "load_listing": load_listing,
    "load_group_listing": load_group_listing,
    "config_report": config_report,
    "load_group_counts": load_group_counts,
    "config_reset": config_reset,
    "control_reset": control_reset,
    "control_reset_load": control_reset_load,
    "run_states": run_states,
    "event_log": events,
    "workflow_rollup": rollup,
    "latest_runs": newest_runs,
    "write_full": write_full,
    "write_append": write_append,
    "silver_load_merge": silver_load_merge,
    "silver_load_parts": silver_load_parts,
    "silver_load_rejects": silver_load_rejects,
    "silver_load_results": silver_load_results,
    "silver_load_watermark": silver_load_watermark,
    "gold_load_merge": gold_load_query(False),
    "gold_load_incremental": gold_load_query(True),
    "stream_silver": stream_query,
    "stream_out_of_order": stream_out_of_order,
    "group_run": group_run,
    "load_audit": load_audit,
    "workflow_completed": workflow_completed,
}
