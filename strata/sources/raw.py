"""Raw tables as bronze entities: which column plays which part.

Natural keys are cast to bigint, so that both ends of a link hash alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEALERS = 100
VEHICLES = 1500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _key(name: str) -> Column:
    return F.col(name).cast("bigint")


def vehicle_model(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(_key("n_nationkey").alias("model_id"), "n_name", "n_regionkey")


def dealer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        _key("s_suppkey").alias("dealer_id"), "s_name", "s_nationkey", "s_acctbal"
    )


def customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        _key("c_custkey").alias("customer_id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def vehicle(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        _key("c_custkey").alias("vin"),
        _key("c_nationkey").alias("vehicle_model_id"),
        _key("c_custkey").alias("current_customer_id"),
        F.col("c_mktsegment").alias("vehicle_status"),
        F.col("c_acctbal").alias("odometer_km"),
    )


def part_master(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        _key("p_partkey").alias("part_id"), F.col("p_name").alias("part_number"), "p_brand", "p_type", "p_retailprice"
    )


def failure_code(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(_key("p_size").alias("failure_code")).distinct()


def service_order(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _key("o_orderkey").alias("service_order_id"),
        _key("o_custkey").alias("vin"),
        _key("o_custkey").alias("customer_id"),
        (_key("o_custkey") % DEALERS).alias("dealer_id"),
        F.col("o_orderdate").alias("open_timestamp"),
        F.col("o_totalprice").alias("labor_cost"),
    )


def _line_id() -> Column:
    return (_key("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint")


def repair_job(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _line_id().alias("repair_job_id"),
        (_key("l_orderkey") % VEHICLES).alias("vin"),
        _key("l_suppkey").alias("dealer_id"),
        _key("l_linenumber").alias("failure_code"),
        F.col("l_quantity").alias("labor_hours"),
        F.col("l_extendedprice").alias("labor_rate"),
        F.col("l_shipdate").alias("completed_timestamp"),
    )


def part_consumption(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _line_id().alias("part_consumption_id"),
        (_key("l_orderkey") % VEHICLES).alias("vin"),
        _key("l_suppkey").alias("dealer_id"),
        _key("l_partkey").alias("part_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("unit_cost"),
        F.col("l_shipdate").alias("consumption_timestamp"),
    )


def warranty_claim(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        _key("o_orderkey").alias("warranty_claim_id"),
        _key("o_custkey").alias("vin"),
        (_key("o_custkey") % DEALERS).alias("dealer_id"),
        day.alias("claim_submitted_date"),
        F.when(status == "F", F.date_add(day, 30)).alias("claim_approved_date"),
        F.when(status == "O", F.date_add(day, 10)).alias("claim_rejected_date"),
        F.col("o_orderpriority").alias("claim_type"),
    )


def vehicle_daily_usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        _key("user_id").alias("vin"),
        _key("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("usage_date"),
        "ts",
        "event_id",
        F.col("value").alias("distance_km"),
    )


def breakdown(spark: SparkSession, folder: str) -> DataFrame:
    errors = table(spark, folder, "events").filter(F.col("event_type") == "error")
    return errors.select(
        _key("event_id").alias("breakdown_id"),
        _key("user_id").alias("vin"),
        _key("user_id").alias("customer_id"),
        (_key("user_id") % DEALERS).alias("dealer_id"),
        (_key("event_id") % 7 + 1).alias("failure_code"),
        F.col("ts").alias("breakdown_timestamp"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("resolved_timestamp"),
    )


BRONZE = {
    "vehicle_model": vehicle_model,
    "dealer": dealer,
    "customer": customer,
    "vehicle": vehicle,
    "part_master": part_master,
    "failure_code": failure_code,
    "service_order": service_order,
    "repair_job": repair_job,
    "part_consumption": part_consumption,
    "warranty_claim": warranty_claim,
    "vehicle_daily_usage": vehicle_daily_usage,
    "breakdown": breakdown,
}
