"""Resetting the control tables."""

from pyspark.sql import functions as F

from strata.plans.loads import WATERMARK_LOG, silver_load
from strata.plans.reset import reset_control
from strata.sources import control
from strata.sources.control import LoadSpec
from strata.streaming.watermark import load_position, watermark_state
from tests.conftest import rows

SPEC = LoadSpec("PL_SILVER_X", "x", "SILVER", "b", "silver.x", "APPEND", ("id",), None, "at")


def source(spark, n):
    return spark.range(n).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))


def test_loads_start_over_and_other_rows_stay(spark, lake):
    other = LoadSpec(**{**SPEC.__dict__, "pipeline_id": "PL_OTHER", "target_object": "silver.y"})
    for spec in (SPEC, other):
        silver_load(lake, spec, "B1", source=source(spark, 3))
        silver_load(lake, spec, "B2", source=source(spark, 5))
    lake.overwrite("pipeline_dependency", spark.createDataFrame(
        [("PL_SILVER_X", "Q"), ("Q", "PL_GOLD_Z"), ("Q", "R"), (None, "R")], control.PIPELINE_DEPENDENCY), "B")
    new = spark.createDataFrame([("PL_SILVER_X", "PL_GOLD_NEW")], "parent_pipeline_id string, child_pipeline_id string")
    for _ in range(2):  # a second time changes nothing
        counts = reset_control(lake, "R1", {"pipeline_dependency": new})
        assert counts["pipeline_dependency"] == 3
        assert rows(lake.read("pipeline_dependency")) == [(None, "R"), ("PL_SILVER_X", "PL_GOLD_NEW"), ("Q", "R")]
        log = lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK)
        assert rows(watermark_state(log), "pipeline_id") == [("PL_OTHER",)]
        assert load_position(log, "PL_SILVER_X")[0] is None and log.count() == 5
    assert counts[WATERMARK_LOG] == 0
    assert silver_load(lake, SPEC, "B3", source=source(spark, 3)).counts["rows_read"] == 3
    assert silver_load(lake, SPEC, "B4", source=source(spark, 5)).counts["rows_read"] == 2
    assert silver_load(lake, other, "B3", source=source(spark, 5)).counts["rows_read"] == 0
    assert lake.read("silver.x").count() == 10 and lake.read("silver.y").count() == 5


def test_an_empty_warehouse_can_be_reset(spark, lake):
    config, rules = control.seed_config(spark), control.seed_rules(spark)
    counts = reset_control(lake, "R1", {"pipeline_config": config, "data_quality_rule": rules})
    assert (counts["pipeline_config"], counts["data_quality_rule"], counts[WATERMARK_LOG]) == (25, 7, 0)
    assert reset_control(lake, "R2", {"pipeline_config": config})["pipeline_config"] == 25
    assert lake.read("data_quality_rule").count() == 0
