"""Declarative data-quality rules, evaluated in one pass.

Rules apply in order, and a row is judged by the first blocking rule it fails. Instead of
filtering and counting once per rule, each row gets the position of that rule; the good
rows, the rejected rows and every rule's counts then follow from one staged frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import payload_columns

# Rule actions and row states as stored in control tables.
WARN = "WARN"
QUARANTINE = "QUARANTINE"
DROP_RECORD = "DROP_RECORD"
FAIL_PIPELINE = "FAIL_PIPELINE"
BLOCKING = (QUARANTINE, DROP_RECORD, FAIL_PIPELINE)
PASSED = "PASSED"
FAILED = "FAILED"
REJECT_SEVERITY = "HIGH"

POSITION = "_failed_position"
ORPHAN = "_orphan_"
FAILED_RULE = "_failed_rule_id"
STATUS = "dq_status"
MESSAGE = "dq_error_message"


class DataQualityError(ValueError):
    """A rule that stops the load found failing rows."""


@dataclass(frozen=True)
class Rule:
    """A row predicate and what to do with rows for which it is false.

    A rule with a reference has no predicate of its own: the values of ``column_name`` have to
    occur in ``reference_column`` of ``reference_object`` (of several columns, named with commas,
    together); see :mod:`strata.operators.references`.
    """

    rule_id: str
    rule_name: str
    expression: str | Column | None
    failure_action: str | None = WARN
    rule_type: str | None = None
    severity: str | None = "CRITICAL"
    threshold_value: float | None = 0.0
    column_name: str | None = None
    reference_object: str | None = None
    reference_column: str | None = None

    @property
    def refers(self) -> bool:
        return self.reference_object is not None

    @property
    def blocks(self) -> bool:
        return self.failure_action in BLOCKING

    @property
    def stops(self) -> bool:
        return self.failure_action == FAIL_PIPELINE

    @property
    def predicate(self) -> Column:
        if self.expression is None:
            raise ValueError(f"{self.rule_id} refers to {self.reference_object}, which was not looked up")
        return F.expr(self.expression) if isinstance(self.expression, str) else self.expression

    @property
    def reason(self) -> str:
        return f"{self.rule_id}: {self.rule_name}"


def orphan_flag(index: int) -> str:
    """The column that is true where the rule at a position found no reference."""
    return f"{ORPHAN}{index}"


def _without_flags(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(ORPHAN)))


def _fails(rule: Rule, null_policy: str) -> Column:
    """True when a row fails the rule; an unknown predicate follows ``null_policy``."""
    if null_policy not in ("pass", "fail"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    return ~F.coalesce(rule.predicate, F.lit(null_policy == "pass"))


def classify(df: DataFrame, rules: Sequence[Rule], null_policy: str = "pass") -> DataFrame:
    """Add the position of the first blocking rule a row fails, NULL for a good row."""
    position = F.lit(None).cast("int")
    for index in reversed(range(len(rules))):
        if rules[index].blocks:
            position = F.when(_fails(rules[index], null_policy), F.lit(index)).otherwise(position)
    return df.withColumn(POSITION, position)


def good_rows(classified: DataFrame) -> DataFrame:
    return (
        _without_flags(classified.filter(F.col(POSITION).isNull()))
        .withColumns({STATUS: F.lit(PASSED), MESSAGE: F.lit(None).cast("string")})
        .drop(POSITION)
    )


def rejected_rows(classified: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that failed a blocking rule, each tagged with that rule."""
    rejected = _without_flags(classified.filter(F.col(POSITION).isNotNull()))
    if not rules:
        message = rule_id = F.lit(None).cast("string")
    else:
        reasons = F.array(*[F.lit(r.reason) for r in rules])
        ids = F.array(*[F.lit(r.rule_id) for r in rules])
        message = F.get(reasons, F.col(POSITION))
        rule_id = F.get(ids, F.col(POSITION))
    return rejected.withColumns(
        {STATUS: F.lit(FAILED), MESSAGE: message, FAILED_RULE: rule_id}
    ).drop(POSITION)


def _over(rule: Rule, failed: Column, evaluated: Column, thresholds: bool) -> Column:
    """Whether more rows failed a rule than it tolerates; its threshold is a percentage."""
    if not thresholds:
        return failed > 0
    return failed * F.lit(100.0) > F.lit(float(rule.threshold_value or 0.0)) * evaluated


def rule_counts(
    classified: DataFrame, rules: Sequence[Rule], null_policy: str = "pass", thresholds: bool = False
) -> DataFrame:
    """One row per rule that was reached: rows it saw, failed and passed.

    With ``thresholds`` a rule has failed, and one that stops the load does so, only when the
    percentage of failed rows is above the rule's threshold. Rows that failed a blocking rule are
    rejected either way.

    A rule sees the rows no earlier blocking rule took out. Rules after one that stops the
    load are not reached. All counts come from a single aggregation, without a shuffle of
    rows: each task contributes one partial row.
    """
    if not rules:
        raise ValueError("no rules to count")
    position = F.col(POSITION)
    counts = []
    for index, rule in enumerate(rules):
        reached = position.isNull() | (position >= index)
        failed = position == index if rule.blocks else reached & _fails(rule, null_policy)
        counts.append(F.count_if(reached).alias(f"_reached_{index}"))
        counts.append(F.count_if(failed).alias(f"_failed_{index}"))
    totals = classified.agg(*counts)
    stopped = [
        F.when(_over(rule, F.col(f"_failed_{index}"), F.col(f"_reached_{index}"), thresholds), F.lit(index))
        for index, rule in enumerate(rules)
        if rule.stops
    ]
    rows = [
        F.struct(
            F.lit(index).alias("rule_position"),
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.rule_name).alias("rule_name"),
            F.lit(rule.rule_type).cast("string").alias("rule_type"),
            F.lit(rule.severity).cast("string").alias("severity"),
            F.lit(rule.failure_action).cast("string").alias("failure_action"),
            F.lit(rule.threshold_value).cast("double").alias("threshold_value"),
            F.col(f"_reached_{index}").alias("evaluated_row_count"),
            F.col(f"_failed_{index}").alias("failed_row_count"),
            _over(rule, F.col(f"_failed_{index}"), F.col(f"_reached_{index}"), thresholds).alias("_over"),
        )
        for index, rule in enumerate(rules)
    ]
    stop = F.array_min(F.array(*stopped)) if stopped else F.lit(None).cast("int")
    per_rule = totals.select(stop.alias("_stop"), F.inline(F.array(*rows)))
    failed, evaluated = F.col("failed_row_count"), F.col("evaluated_row_count")
    return (
        per_rule.filter(F.col("_stop").isNull() | (F.col("rule_position") <= F.col("_stop")))
        .drop("_stop")
        .withColumns(
            {
                "passed_row_count": evaluated - failed,
                "failure_percentage": F.when(evaluated > 0, failed / evaluated * 100).otherwise(0.0),
                "rule_status": F.when(F.col("_over"), FAILED).otherwise(PASSED),
            }
        )
        .drop("_over")
    )


def rule_results(
    counts: DataFrame,
    *,
    audit_id: str,
    batch_id: str,
    pipeline_id: str,
    workflow_audit_id: str | None = None,
    evaluated_ts: Column | None = None,
) -> DataFrame:
    """Rule counts shaped as rows of the data-quality result table."""
    stamp = F.current_timestamp() if evaluated_ts is None else evaluated_ts
    return counts.select(
        F.uuid().alias("dq_result_id"),
        F.lit(audit_id).alias("audit_id"),
        F.lit(workflow_audit_id).cast("string").alias("workflow_audit_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(pipeline_id).alias("pipeline_id"),
        "rule_id",
        "rule_name",
        "rule_type",
        "severity",
        "evaluated_row_count",
        "failed_row_count",
        "passed_row_count",
        "failure_percentage",
        "threshold_value",
        "rule_status",
        "failure_action",
        stamp.alias("evaluated_timestamp"),
        F.lit(None).cast("string").alias("sample_failed_records"),
    )


def reject_records(
    rejected: DataFrame,
    *,
    audit_id: str,
    batch_id: str,
    pipeline_id: str,
    source_object: str,
    target_object: str,
    workflow_audit_id: str | None = None,
    rejected_ts: Column | None = None,
) -> DataFrame:
    """Rejected rows shaped as rows of the rejected-record table, the record kept as JSON."""
    stamp = F.current_timestamp() if rejected_ts is None else rejected_ts
    nothing = F.lit(None).cast("string")
    return rejected.select(
        F.uuid().alias("rejection_id"),
        F.lit(audit_id).alias("audit_id"),
        F.lit(workflow_audit_id).cast("string").alias("workflow_audit_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(pipeline_id).alias("pipeline_id"),
        F.lit(source_object).alias("source_object"),
        F.lit(target_object).alias("target_object"),
        F.to_json(F.struct(*payload_columns(rejected))).alias("source_record"),
        F.col(MESSAGE).alias("rejection_reason"),
        F.col(FAILED_RULE).alias("failed_rule_ids"),
        F.lit(REJECT_SEVERITY).alias("severity"),
        nothing.alias("source_file_name"),
        nothing.alias("source_file_path"),
        stamp.alias("rejected_timestamp"),
    )
