"""Run history: append-only rows, and the reports over them.

A run writes a whole row when it starts and another when it ends, never an update. Its state
is its latest row, and the event log is a view of the same rows.
"""

from __future__ import annotations

import traceback
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.sources.control import PIPELINE_RUN_AUDIT, WORKFLOW_RUN_AUDIT, LoadSpec
from strata.sources.lake import Lake

# Run states and event names as stored in control tables.
RUNNING, SUCCESS, FAILED, SKIPPED = "RUNNING", "SUCCESS", "FAILED", "SKIPPED"
START_EVENT, COMPLETE_EVENT, FAILED_EVENT = "PIPELINE_START", "PIPELINE_COMPLETE", "PIPELINE_FAILED"
INFO, ERROR = "INFO", "ERROR"
COUNTERS = (
    "rows_read",
    "rows_written",
    "rows_inserted",
    "rows_updated",
    "rows_deleted",
    "rows_rejected",
    "rows_duplicated",
    "rows_quarantined",
)

RUN_LOG, WORKFLOW_LOG = "pipeline_run_audit", "workflow_run_audit"


def now() -> datetime:
    return datetime.now(timezone.utc)


def new_id() -> str:
    return str(uuid4())


def _append(lake: Lake, log: str, schema, values: dict) -> None:
    row = [tuple(values.get(name) for name in schema.names)]
    lake.append_log(log, schema, lake.spark.createDataFrame(row, schema))


@dataclass
class RunAudit:
    """Writes the audit rows and events of one load."""

    lake: Lake
    spec: LoadSpec
    batch_id: str
    workflow_audit_id: str | None = None
    audit_id: str = field(default_factory=new_id)
    started_at: datetime | None = None

    def _row(self, status: str, moment: datetime, **values) -> None:
        base = {
            "audit_id": self.audit_id,
            "workflow_audit_id": self.workflow_audit_id,
            "batch_id": self.batch_id,
            "pipeline_id": self.spec.pipeline_id,
            "pipeline_name": self.spec.pipeline_name,
            "pipeline_group": self.spec.pipeline_group,
            "source_object": self.spec.source_object,
            "target_object": self.spec.target_object,
            "load_type": self.spec.load_type,
            "run_status": status,
            "start_timestamp": self.started_at,
            "created_timestamp": self.started_at,
            "updated_timestamp": moment,
        }
        counters = {name: int(values.pop(name, 0) or 0) for name in COUNTERS}
        _append(self.lake, RUN_LOG, PIPELINE_RUN_AUDIT, {**base, **counters, **values})

    def start(self) -> None:
        self.started_at = now()
        self._row(RUNNING, self.started_at)

    def _finish(self, status: str, **values) -> None:
        end = now()
        seconds = int((end - self.started_at).total_seconds())
        self._row(status, end, end_timestamp=end, duration_seconds=seconds, **values)

    def complete(
        self, counts: dict, source_watermark: str | None = None, target_watermark: str | None = None
    ) -> None:
        self._finish(
            SUCCESS,
            **{name: counts.get(name, 0) for name in COUNTERS},
            source_watermark=source_watermark,
            target_watermark=target_watermark,
            delta_table_version=counts.get("version"),
            delta_operation=counts.get("operation"),
        )

    def fail(self, error: Exception, counts: dict) -> None:
        self._finish(
            FAILED,
            **{name: counts.get(name, 0) for name in COUNTERS},
            error_code=type(error).__name__,
            error_message=str(error),
            error_stacktrace="".join(traceback.format_exception(error)),
        )


def event_log(rows: DataFrame) -> DataFrame:
    """Start, completion and failure events, one per run-audit row."""
    status = F.col("run_status")

    def by_status(started: str | Column, completed: str | Column, failed: str | Column) -> Column:
        return F.when(status == RUNNING, started).when(status == FAILED, failed).otherwise(completed)

    return rows.select(
        F.concat_ws("/", "audit_id", status).alias("event_id"),
        "audit_id",
        "workflow_audit_id",
        "batch_id",
        "pipeline_id",
        by_status(START_EVENT, COMPLETE_EVENT, FAILED_EVENT).alias("event_type"),
        by_status(INFO, INFO, ERROR).alias("event_level"),
        by_status(
            F.concat(F.lit("Started "), "pipeline_id"),
            F.concat(F.lit("Completed "), "pipeline_id"),
            F.col("error_message"),
        ).alias("event_message"),
        F.lit(None).cast("string").alias("event_payload"),
        F.col("updated_timestamp").alias("event_timestamp"),
    )


def start_workflow(
    lake: Lake, name: str, trigger_type: str = "MANUAL", triggered_by: str | None = None, batch_id: str | None = None
) -> dict[str, str]:
    """Record that a workflow runs; gives the ids its loads carry."""
    ids = {"batch_id": batch_id or new_id(), "workflow_audit_id": new_id()}
    moment = now()
    totals = {n: 0 for n in WORKFLOW_RUN_AUDIT.names if n.startswith("total_") or n.endswith("_pipelines")}
    _append(
        lake,
        WORKFLOW_LOG,
        WORKFLOW_RUN_AUDIT,
        {
            **ids,
            **totals,
            "workflow_name": name,
            "workflow_run_name": name,
            "trigger_type": trigger_type,
            "triggered_by": triggered_by,
            "run_status": RUNNING,
            "start_timestamp": moment,
            "created_timestamp": moment,
            "updated_timestamp": moment,
        },
    )
    return ids


def run_state(rows: DataFrame, order: tuple[str, ...] = ("updated_timestamp", "end_timestamp")) -> DataFrame:
    """One row per run: its latest."""
    return latest_per_key(rows, ["audit_id"], order)


def latest_runs(state: DataFrame, limit: int = 50) -> DataFrame:
    """The newest runs, for a look at what happened last."""
    return (
        state.select(
            "audit_id",
            "pipeline_id",
            "run_status",
            "rows_read",
            "rows_inserted",
            "rows_updated",
            "rows_rejected",
            "error_message",
            "start_timestamp",
        )
        .orderBy(F.col("start_timestamp").desc(), "audit_id")
        .limit(limit)
    )


def _runs_with(status: str) -> Column:
    return F.count_if(F.col("run_status") == status)


def _total(name: str) -> Column:
    return F.sum(F.coalesce(F.col(name), F.lit(0))).cast("bigint").alias(f"total_{name}")


def workflow_rollup(state: DataFrame) -> DataFrame:
    """Totals per workflow and batch: runs by state, rows, and the time from first to last.

    A run that succeeded although rows were rejected counts as a warning too.
    """
    failed = _runs_with(FAILED)
    rejected = F.coalesce(F.col("rows_rejected"), F.lit(0))
    return state.groupBy("workflow_audit_id", "batch_id").agg(
        F.count(F.lit(1)).alias("total_pipelines"),
        _runs_with(SUCCESS).alias("successful_pipelines"),
        failed.alias("failed_pipelines"),
        _runs_with(SKIPPED).alias("skipped_pipelines"),
        F.count_if((F.col("run_status") == SUCCESS) & (rejected > 0)).alias("warning_pipelines"),
        _total("rows_read"),
        _total("rows_inserted"),
        _total("rows_updated"),
        _total("rows_deleted"),
        _total("rows_rejected"),
        F.when(failed > 0, FAILED).otherwise(SUCCESS).alias("run_status"),
        F.min("start_timestamp").alias("start_timestamp"),
        F.max("end_timestamp").alias("end_timestamp"),
        F.timestamp_diff("SECOND", F.min("start_timestamp"), F.max("end_timestamp")).alias("duration_seconds"),
    )


def complete_workflow(lake: Lake, workflow_audit_id: str, batch_id: str) -> DataFrame:
    """Append a workflow's finished row: its start row with the roll-up of its runs.

    A workflow without runs is complete with zero counts, as nothing of it failed.
    """
    own = (F.col("workflow_audit_id") == workflow_audit_id) & (F.col("batch_id") == batch_id)
    started = lake.log(WORKFLOW_LOG, WORKFLOW_RUN_AUDIT).filter(own & (F.col("run_status") == RUNNING))
    rollup = workflow_rollup(run_state(lake.log(RUN_LOG, PIPELINE_RUN_AUDIT).filter(own)))
    ids = ["workflow_audit_id", "batch_id"]
    fresh = [c for c in rollup.columns if c not in (*ids, "start_timestamp")]
    moment = F.current_timestamp()
    kept = started.drop(*fresh, "updated_timestamp")
    joined = kept.join(rollup.drop("start_timestamp"), ids, "left")
    zero = {n: F.coalesce(F.col(n), F.lit(0)) for n in fresh if n.startswith("total_") or n.endswith("_pipelines")}
    done = joined.withColumns(
        {
            **zero,
            "run_status": F.coalesce("run_status", F.lit(SUCCESS)),
            "end_timestamp": F.coalesce("end_timestamp", moment),
            "updated_timestamp": moment,
        }
    )
    lake.append_log(WORKFLOW_LOG, WORKFLOW_RUN_AUDIT, done)
    return workflow_state(lake).filter(own)


def fail_workflow(lake: Lake, workflow_audit_id: str, batch_id: str, error: Exception) -> None:
    """Append a workflow's failed row: its start row with the error."""
    own = (F.col("workflow_audit_id") == workflow_audit_id) & (F.col("batch_id") == batch_id)
    started = lake.log(WORKFLOW_LOG, WORKFLOW_RUN_AUDIT).filter(own & (F.col("run_status") == RUNNING))
    moment = F.current_timestamp()
    failed = started.withColumns(
        {
            "run_status": F.lit(FAILED),
            "end_timestamp": moment,
            "duration_seconds": F.timestamp_diff("SECOND", F.col("start_timestamp"), moment),
            "error_code": F.lit(type(error).__name__),
            "error_message": F.lit(str(error)),
            "updated_timestamp": moment,
        }
    )
    lake.append_log(WORKFLOW_LOG, WORKFLOW_RUN_AUDIT, failed)


def workflow_state(lake: Lake) -> DataFrame:
    rows = lake.log(WORKFLOW_LOG, WORKFLOW_RUN_AUDIT)
    return latest_per_key(rows, ["workflow_audit_id"], "updated_timestamp")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``table_name, row_count`` row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
