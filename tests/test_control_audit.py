import datetime as dt

import pytest

from strata.plans.audit import (
    RUN_LOG,
    RunAudit,
    complete_workflow,
    fail_workflow,
    event_log,
    latest_runs,
    run_state,
    start_workflow,
    table_counts,
    workflow_rollup,
    workflow_state,
)
from strata.sources import control
from strata.sources.control import LoadSpec
from tests.conftest import rows

SPEC = LoadSpec("PL_X", "X load", "SILVER", "b.x", "s.x", "MERGE", ("id",))


def test_shipped_loads_and_rules(spark):
    config, rules = control.seed_config(spark), control.seed_rules(spark)
    assert config.schema.names == control.PIPELINE_CONFIG.names
    assert rows(control.group_counts(config)) == [("GOLD", 13), ("SILVER", 12)]
    assert rules.count() == 7
    listing = [s.target_object for s in control.active_loads(config, "SILVER")]
    assert listing[0] == "warehouse.silver.vehicle_model" and listing[-1] == "warehouse.silver.breakdown"
    assert [s.target_object.split(".")[-1] for s in control.active_loads(config, "GOLD")][0] == "dim_date"
    assert len(control.active_loads(config)) == 25
    own = control.active_rules(rules, "PL_SILVER_VEHICLE")
    assert [(r.rule_id, r.expression, r.stops) for r in own] == [("DQ_SILVER_VEHICLE_VIN_NOT_NULL", "vin IS NOT NULL", True)]
    assert control.active_rules(None, "PL_SILVER_VEHICLE") == []
    report = control.config_listing(config).collect()
    assert [r["pipeline_group"] for r in report] == ["GOLD"] * 13 + ["SILVER"] * 12


def test_active_load_and_its_defaults(spark):
    blank = {name: None for name in control.PIPELINE_CONFIG.names}
    one = {**blank, "pipeline_id": "P", "source_catalog": "c", "source_schema": "b", "source_object": "x",
           "target_catalog": "c", "target_schema": "s", "target_object": "y", "primary_key_columns": " a, b ,", "is_active": True}
    off = {**one, "pipeline_id": "OFF", "is_active": False}
    config = spark.createDataFrame([tuple(r.values()) for r in (one, off)], control.PIPELINE_CONFIG)
    spec = control.active_load(config, "P")
    assert spec == LoadSpec("P", "P", "", "c.b.x", "c.s.y", "MERGE", ("a", "b"), None, None, "METADATA")
    for missing in ("OFF", "NONE"):
        with pytest.raises(ValueError, match=missing):
            control.active_load(config, missing)


def test_reset_replaces_matching_rows_only(spark):
    table = spark.createDataFrame([("PL_SILVER_A", 1), ("PLXGOLDXB", 2), ("OWN", 3), (None, 4)], "pipeline_id string, v int")
    fresh = spark.createDataFrame([("PL_SILVER_A", 9)], "pipeline_id string, v int")
    # The underscore of a pattern stands for any character.
    assert rows(control.replace_matching(table, fresh)) == [(None, 4), ("OWN", 3), ("PL_SILVER_A", 9)]
    links = spark.createDataFrame([("OWN", "PL_GOLD_A"), ("OWN", None)], control.PIPELINE_DEPENDENCY)
    left = control.replace_matching(links, links.limit(0), ("parent_pipeline_id", "child_pipeline_id"))
    assert rows(left) == [("OWN", None)]


def test_run_rows_and_events(spark, lake):
    audit = RunAudit(lake, SPEC, "B1", "W1")
    audit.start()
    audit.complete({"rows_read": 5, "rows_inserted": 3, "version": 2, "operation": "MERGE"}, "a", "b")
    other = RunAudit(lake, SPEC, "B1", "W1")
    other.start()
    other.fail(ValueError("broken"), {"rows_read": 4})
    log = lake.log(RUN_LOG, control.PIPELINE_RUN_AUDIT)
    assert log.count() == 4
    state = {r["audit_id"]: r for r in run_state(log).collect()}
    done, failed = state[audit.audit_id], state[other.audit_id]
    assert (done["run_status"], done["rows_read"], done["rows_inserted"], done["target_watermark"]) == ("SUCCESS", 5, 3, "b")
    assert done["duration_seconds"] >= 0 and done["delta_operation"] == "MERGE"
    assert (failed["run_status"], failed["error_code"], failed["rows_read"]) == ("FAILED", "ValueError", 4)
    assert "ValueError: broken" in failed["error_stacktrace"]
    events = event_log(log)
    assert events.columns == control.PIPELINE_EVENT_LOG.names
    assert rows(events, "event_type", "event_level", "event_message") == [
        ("PIPELINE_COMPLETE", "INFO", "Completed PL_X"),
        ("PIPELINE_FAILED", "ERROR", "broken"),
        ("PIPELINE_START", "INFO", "Started PL_X"),
        ("PIPELINE_START", "INFO", "Started PL_X"),
    ]
    assert latest_runs(run_state(log), 1).count() == 1


def test_rollup_of_a_workflow(spark, lake):
    ids = start_workflow(lake, "nightly", "SCHEDULE", "me")
    for fails in (False, True, False):
        audit = RunAudit(lake, SPEC, ids["batch_id"], ids["workflow_audit_id"])
        audit.start()
        if fails:
            audit.fail(ValueError("x"), {"rows_read": 1})
        else:
            audit.complete({"rows_read": 10, "rows_inserted": 4, "rows_rejected": 1})
    done = complete_workflow(lake, **ids).first()
    assert (done["run_status"], done["total_pipelines"], done["failed_pipelines"]) == ("FAILED", 3, 1)
    assert (done["successful_pipelines"], done["warning_pipelines"], done["total_rows_read"]) == (2, 2, 21)
    assert (done["workflow_name"], done["trigger_type"], done["triggered_by"]) == ("nightly", "SCHEDULE", "me")
    assert done["duration_seconds"] >= 0 and done["end_timestamp"] >= done["start_timestamp"]
    assert workflow_state(lake).count() == 1
    assert workflow_state(lake).columns == control.WORKFLOW_RUN_AUDIT.names


def test_a_workflow_without_runs_succeeds(spark, lake):
    done = complete_workflow(lake, **start_workflow(lake, "empty")).first()
    assert (done["run_status"], done["total_pipelines"], done["total_rows_read"]) == ("SUCCESS", 0, 0)


def test_a_failed_workflow_keeps_its_error(spark, lake):
    ids = start_workflow(lake, "nightly")
    fail_workflow(lake, **ids, error=RuntimeError("upstream"))
    row = workflow_state(lake).first()
    assert (row["run_status"], row["error_code"], row["error_message"]) == ("FAILED", "RuntimeError", "upstream")
    assert row["duration_seconds"] >= 0 and row["workflow_name"] == "nightly"


def test_rollup_keeps_workflows_apart_and_treats_unknown_counts_as_zero(spark):
    at = dt.datetime(2025, 1, 1)
    names = "audit_id workflow_audit_id batch_id run_status rows_read rows_inserted rows_updated rows_deleted rows_rejected start_timestamp end_timestamp".split()
    data = [
        ("1", "W", "B", "SUCCESS", None, 1, 0, 0, None, at, at + dt.timedelta(seconds=30)),
        ("2", "W", "B", "SKIPPED", 5, None, 0, 0, 2, at + dt.timedelta(seconds=10), at + dt.timedelta(seconds=90)),
        ("3", "W", "C", "FAILED", 7, 0, 0, 0, 0, at, None),
    ]
    state = spark.createDataFrame(data, control.PIPELINE_RUN_AUDIT.__class__([control.PIPELINE_RUN_AUDIT[n] for n in names]))
    out = {r["batch_id"]: r for r in workflow_rollup(state).collect()}
    assert (out["B"]["total_rows_read"], out["B"]["total_rows_inserted"], out["B"]["duration_seconds"]) == (5, 1, 90)
    assert (out["B"]["skipped_pipelines"], out["B"]["run_status"], out["C"]["run_status"]) == (1, "SUCCESS", "FAILED")
    assert out["C"]["duration_seconds"] is None


def test_table_counts(spark):
    assert rows(table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
