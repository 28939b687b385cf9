import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strata.functions.hashing import surrogate_key
from strata.operators.dedupe import latest_per_key
from strata.plans import gold, silver
from tests.conftest import rows


def when():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def conformed(df, name):
    return silver.conform(df, silver.entity_for(name), when())


def test_service_order_derivations(spark):
    df = spark.sql(
        "SELECT 1L service_order_id, TIMESTAMP'2025-03-04 05:06:07' created_timestamp, "
        "TIMESTAMP'2025-03-05 00:00:00' close_timestamp, CAST(NULL AS DOUBLE) labor_cost, 2.5D parts_cost"
    )
    row = conformed(df, "service_order").first()
    assert row["opened_timestamp"] == dt.datetime(2025, 3, 4, 5, 6, 7)
    assert (row["open_date"], row["close_date"]) == (dt.date(2025, 3, 4), dt.date(2025, 3, 5))
    assert (row["total_service_cost"], row["repeat_repair_count"]) == (2.5, 0)


def test_present_columns_are_not_derived_again(spark):
    df = spark.sql("SELECT 1L service_order_id, 9.0D TOTAL_SERVICE_COST, 1.0D labor_cost, 3 repeat_repair_count")
    row = conformed(df, "service_order").first()
    assert (row["TOTAL_SERVICE_COST"], row["repeat_repair_count"]) == (9.0, 3)


def test_a_bare_service_order_gets_typed_columns(spark):
    out = conformed(spark.sql("SELECT 1L service_order_id"), "service_order")
    types = dict(out.dtypes)
    assert (types["opened_timestamp"], types["close_date"], types["total_service_cost"]) == ("timestamp", "date", "int")
    assert "void" not in types.values()
    assert out.first()["total_service_cost"] == 0


def test_other_derivations(spark):
    job = conformed(spark.sql("SELECT 1 repair_job_id, 2.0D labor_hours, CAST(NULL AS DOUBLE) labor_rate, TIMESTAMP'2025-01-02 03:00:00' started_timestamp"), "repair_job").first()
    assert (job["labor_cost"], job["repair_date"]) == (0.0, dt.date(2025, 1, 2))
    part = conformed(spark.sql("SELECT 1 part_consumption_id, 2 quantity, 3 unit_cost"), "part_consumption").first()
    assert (part["extended_cost"], part["consumption_date"]) == (6, None)
    claim = conformed(
        spark.sql("SELECT 1 warranty_claim_id, CAST(NULL AS DATE) claim_approved_date, DATE'2025-02-01' claim_submitted_date, 'X' claim_type"),
        "warranty_claim",
    ).first()
    assert (claim["decision_date"], claim["claim_count"], claim["warranty_type"]) == (dt.date(2025, 2, 1), 1, "X")
    broken = conformed(spark.sql("SELECT 1 breakdown_id, TIMESTAMP'2025-01-02 03:00:00' breakdown_timestamp"), "breakdown").first()
    assert (broken["breakdown_date"], broken["resolved_date"]) == (dt.date(2025, 1, 2), None)


def test_usage_id(spark):
    df = spark.sql("SELECT * FROM VALUES ('V', DATE'2025-01-01'), ('V', NULL), (NULL, NULL) AS t(vin, usage_date)")
    ids = {(r["vin"], r["usage_date"]): r["usage_id"] for r in conformed(df, "vehicle_daily_usage").collect()}
    assert ids[("V", dt.date(2025, 1, 1))] == hashlib.sha256(b"V||2025-01-01").hexdigest()
    assert ids[("V", None)] == hashlib.sha256(b"V").hexdigest()
    assert ids[(None, None)] is None
    given = conformed(spark.sql("SELECT 'own' usage_id, 'V' vin"), "vehicle_daily_usage").first()
    assert given["usage_id"] == "own"


def test_vehicle_projection(spark):
    df = spark.sql(
        "SELECT 'V' vin, 'M' vehicle_model_id, 'old' customer_id, 'now' current_customer_id, 'D' dealer_id, "
        "'2024-01-02' production_date, '2024-02-03' sale_date, 5.5D odometer_km, 'dropped' extra, 'B7' batch_id"
    )
    out = conformed(df, "vehicle")
    row = out.first()
    assert "extra" not in out.columns and len(out.columns) == 17 + 5
    assert (row["model_id"], row["customer_id"], row["dealer_id"]) == ("M", "now", "D")
    assert (row["production_date"], row["delivery_date"]) == (dt.date(2024, 1, 2), dt.date(2024, 2, 3))
    assert (row["current_odometer_km"], row["odometer_km"]) == (5.5, 5.5)
    assert row["source_batch_id"] == "B7"
    assert dict(out.dtypes)["warranty_end_date"] == "date"


def test_lineage_is_renamed_or_filled(spark):
    df = spark.sql("SELECT 1 model_id, 'P' pipeline_id, 'h' record_hash")
    out = silver.standardise_lineage(df, when())
    row = out.first()
    assert out.columns == [
        "model_id", "source_pipeline_id", "source_record_hash", "source_batch_id", "source_ingestion_timestamp", "source_file_name",
    ]
    assert (row["source_pipeline_id"], row["source_record_hash"], row["source_batch_id"]) == ("P", "h", None)
    assert row["source_ingestion_timestamp"] == dt.datetime(2026, 1, 1)


def test_record_digest_ignores_how_a_row_arrived(spark):
    first = spark.sql("SELECT 1 model_id, 'x' name, 'B1' batch_id")
    second = spark.sql("SELECT 1 model_id, 'x' name, 'B2' batch_id")
    one = silver.transform(first, "a.b.vehicle_model", "L1", ["model_id"], when()).first()
    two = silver.transform(second, "a.b.vehicle_model", "L2", ["model_id"]).first()
    assert one["record_hash"] == two["record_hash"] == hashlib.sha256(b"1||x").hexdigest()
    assert one["business_key_hash"] == hashlib.sha256(b"1").hexdigest()
    assert (one["silver_batch_id"], one["is_valid"]) == ("L1", True)
    older = silver.transform(first, "vehicle_model", "L1", ["model_id"], when(), hash_scope="all").first()
    newer = silver.transform(first, "vehicle_model", "L2", ["model_id"], when(), hash_scope="all").first()
    assert older["record_hash"] != newer["record_hash"]
    with pytest.raises(ValueError):
        silver.transform(first, "vehicle_model", "L", ["model_id"], hash_scope="some")


def test_unknown_targets_only_get_their_keys(spark):
    out = silver.transform(spark.sql("SELECT 7 id, 'x' v"), "c.s.garage", "B", ["id"], when()).first()
    assert out["business_key_hash"] == hashlib.sha256(b"7").hexdigest()


def key_of(spark, value):
    return spark.sql(f"SELECT {value} AS v").select(surrogate_key("v")).first()[0]


def test_dimension(spark):
    out = gold.build_gold(spark.sql("SELECT 'V' vin, 'M' model_id, 999L vehicle_model_key"), "c.gold.dim_vehicle", load_ts=when())
    row = out.first()
    assert row["vehicle_key"] == key_of(spark, "'V'")
    assert row["vehicle_model_key"] == key_of(spark, "'M'")
    assert (row["is_current"], row["effective_to"], row["effective_from"]) == (True, None, dt.datetime(2026, 1, 1))
    assert dict(out.dtypes)["effective_to"] == "timestamp"


def test_part_key_falls_back_to_the_part_number(spark):
    assert gold.build_gold(spark.sql("SELECT 'N' part_number"), "dim_part").first()["part_key"] == key_of(spark, "'N'")
    both = gold.build_gold(spark.sql("SELECT 'I' part_id, 'N' part_number"), "dim_part")
    assert both.first()["part_key"] == key_of(spark, "'I'")


def test_fact_links_prefer_given_keys_and_defaults_fill_in(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'V', 5L, DATE'2025-01-02'), (2L, 'V', NULL, NULL) AS t(service_order_id, vin, vehicle_key, open_date)")
    out = {r["service_order_id"]: r for r in gold.build_gold(df, "fact_service_order").collect()}
    assert out[1]["vehicle_key"] == 5 and out[2]["vehicle_key"] == key_of(spark, "'V'")
    assert (out[1]["open_date_key"], out[2]["open_date_key"], out[1]["close_date_key"]) == (20250102, None, None)
    assert (out[1]["dealer_key"], out[1]["total_service_cost"], out[1]["repeat_repair_count"]) == (None, 0, 0)
    other = gold.build_gold(spark.sql("SELECT 1L service_order_id, 4.5D total_service_amount"), "fact_service_order")
    assert other.first()["total_service_cost"] == 4.5


def test_null_natural_keys(spark):
    df = spark.sql("SELECT 1L service_order_id, CAST(NULL AS STRING) vin")
    assert gold.build_gold(df, "fact_service_order").first()["vehicle_key"] == 42
    assert gold.build_gold(df, "fact_service_order", null_key="null").first()["vehicle_key"] is None
    wide = gold.build_gold(df, "fact_service_order", key_algorithm="xxhash64").first()
    assert wide["service_order_key"] > 2**31


def test_links_of_sources_with_other_key_types(spark):
    ints, longs = spark.sql("SELECT 7 vin"), spark.sql("SELECT 1L service_order_id, 7L vin")
    for key_type, same in ((None, False), ("string", True), ("bigint", True)):
        dimension = gold.build_gold(ints, "dim_vehicle", key_type=key_type).first()["vehicle_key"]
        fact = gold.build_gold(longs, "fact_service_order", key_type=key_type).first()["vehicle_key"]
        assert (dimension == fact) is same


def test_unknown_gold_table_and_missing_key(spark):
    with pytest.raises(ValueError, match="no gold table"):
        gold.build_gold(spark.range(1), "fact_unknown")
    with pytest.raises(ValueError, match="service_order_id"):
        gold.build_gold(spark.range(1), "fact_service_order")


def test_gold_tables_are_projections(spark):
    for name, table in gold.GOLD_TABLES.items():
        df = spark.range(3).select(*[F.col("id").alias(c) for c in table.natural_key])
        plan = gold.build_gold(df, name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert rows(gold.build_gold(df, name), table.key)


def test_what_follows_from_other_columns_is_not_shuffled(spark):
    jobs = spark.sql("SELECT id % 7 repair_job_id, id % 3 labor_hours, 2.5D labor_rate, timestamp'2025-01-01' completed_timestamp FROM range(40)")
    entity = silver.entity_for("repair_job")
    for sequence in ("completed_timestamp", "source_ingestion_timestamp", "labor_cost"):
        got = silver.latest(jobs, entity, entity.keys, sequence, when())
        want = latest_per_key(silver.conform(jobs, entity, when()), entity.keys, sequence)
        assert got.columns == want.columns and rows(got) == rows(want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("labor_cost" in plan[plan.index("Window"):]) == (sequence == "labor_cost")
