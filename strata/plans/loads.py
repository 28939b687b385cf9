"""The two kinds of load, and running a group of them.

Only this module and the lake run Spark actions. A silver load reads its slice of the source
twice, whatever the number of rules: one column of it to fix how far the load reaches, then
once to write a staged, deduplicated and classified copy from which all else is taken.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, existing_names, find_name
from strata.functions.hashing import BUSINESS_KEY_HASH, RECORD_HASH, add_hashes
from strata.operators import quality
from strata.operators.align import align, cast_failures
from strata.operators.calendar import DEFAULT_END, DEFAULT_START, dim_date
from strata.operators.dedupe import repeated_keys
from strata.operators.references import resolve_references
from strata.plans import gold, silver
from strata.plans.audit import RunAudit
from strata.sources import control
from strata.sources.control import LoadSpec
from strata.sources.lake import Lake
from strata.streaming.watermark import incremental_slice, load_position, watermark_bounds

RESULT_LOG, REJECT_LOG, WATERMARK_LOG = "data_quality_result", "rejected_record", "pipeline_watermark"
PRESERVED = ("effective_from", "created_timestamp")


@dataclass(frozen=True)
class LoadResult:
    audit_id: str
    counts: dict
    source_watermark: str | None = None
    target_watermark: str | None = None


@dataclass(frozen=True)
class SilverOptions:
    """Choices a silver load leaves open.

    ``on_cast_error``: ``"raise"`` fails the load on a value its target type cannot hold,
    ``"null"`` blanks the value, ``"reject"`` rejects the row. ``replayable`` says that the
    same batch id means the same rows again, as in a stream; an append then replaces them.
    ``part_column`` names the column a new target is kept in parts by. With
    ``enforce_thresholds`` a rule tolerates failed rows up to its threshold, in percent.
    """

    null_policy: str = "pass"
    on_cast_error: str = "raise"
    hash_scope: str = "business"
    watermark_lag: str | None = None
    exclude: tuple[str, ...] = ()
    load_ts: Column | None = None
    replayable: bool = False
    part_column: str | None = None
    enforce_thresholds: bool = False


@dataclass
class _Silver:
    """Working state of one silver load."""

    lake: Lake
    spec: LoadSpec
    batch_id: str
    rules: Sequence[quality.Rule]
    options: SilverOptions
    audit: RunAudit
    counts: dict = field(default_factory=dict)
    # Key and record columns of the digests, unless a column that a digest replaces is one of them.
    digested: tuple[Sequence[str], Sequence[str]] | None = None
    # Names what this load delivers: the same name again means the same rows, or those and more.
    delivery: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        entity = silver.entity_for(self.spec.target_object, self.spec.primary_key_columns)
        return self.spec.primary_key_columns or entity.keys

    @property
    def delivered(self) -> str | None:
        """The delivery's name where it is of use: for replays, and tables that can take a try back."""
        return self.delivery if self.options.replayable or self.lake.takes_deliveries else None

    @property
    def sequence(self) -> str:
        name = self.spec.sequence_column
        return silver.LINEAGE.get(name, name) or silver.LINEAGE["ingestion_timestamp"]

    def ids(self) -> dict:
        return {
            "audit_id": self.audit.audit_id,
            "batch_id": self.batch_id,
            "pipeline_id": self.spec.pipeline_id,
            "workflow_audit_id": self.audit.workflow_audit_id,
        }

    def bounded(self, source: DataFrame, incremental: bool) -> tuple[DataFrame, str | None, str | None]:
        """The rows to load, with the watermark they start after and the one they reach."""
        name = self.spec.watermark_column
        if self.options.replayable:
            self.delivery = json.dumps([self.spec.pipeline_id, self.batch_id])
        if not (incremental and name and find_name(source, name)):
            self.counts["rows_read"] = source.count()
            return source, None, None
        if self.options.watermark_lag and self.spec.load_type == control.APPEND:
            raise ValueError(f"{self.spec.pipeline_id}: an append can't take a watermark_lag, it would add rows again")
        low, since = load_position(self.lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK), self.spec.pipeline_id)
        # Until the watermark moves, each try starts here and reads at least what the last one did.
        self.delivery = self.delivery or json.dumps([self.spec.pipeline_id, "after", low, "since", since])
        pending = incremental_slice(source, name, low, lag=self.options.watermark_lag)
        rows, high = watermark_bounds(pending, name).first()
        self.counts["rows_read"] = rows
        return incremental_slice(source, name, low, high, self.options.watermark_lag), low, high

    def target_schema(self, df: DataFrame) -> tuple[T.StructType, bool]:
        """The target's schema, and whether it exists; a new target gets the source's own."""
        target = self.lake.find(self.spec.target_object)
        if target is not None:
            return target.schema, True
        return quality.good_rows(df.withColumn(quality.POSITION, F.lit(None).cast("int"))).schema, False

    def conformed(self, source: DataFrame) -> tuple[DataFrame, T.StructType, bool]:
        """Latest rows, stamped; with the target's schema and whether it exists."""
        opts = self.options
        entity = silver.entity_for(self.spec.target_object, self.keys)
        latest = silver.latest(source, entity, self.keys, self.sequence, opts.load_ts)
        # Digests are computed after the shuffle, for the surviving rows only.
        stamped = silver.stamp(latest, entity.keys, self.batch_id, opts.load_ts, opts.hash_scope)
        if not (find_name(latest, BUSINESS_KEY_HASH) or find_name(latest, RECORD_HASH)):
            business = opts.hash_scope == "business"
            self.digested = entity.keys, silver.business_columns(latest) if business else stamped.columns
        schema, exists = self.target_schema(stamped)
        if opts.on_cast_error == "reject":
            fits = ~cast_failures(stamped, schema, opts.exclude)
            rule = quality.Rule("CAST", "Value does not fit the target type", fits, quality.QUARANTINE, "CAST")
            self.rules = [*self.rules, rule]
        return stamped, schema, exists

    def stage(self, stamped: DataFrame) -> DataFrame:
        """Stamped rows, written without their digests, which are computed again where they are read."""
        if self.digested is None:
            return self.lake.stage(self.spec.target_object, stamped)
        staged = self.lake.stage(self.spec.target_object, stamped.drop(BUSINESS_KEY_HASH, RECORD_HASH))
        return add_hashes(staged, *self.digested).select(*[column(c) for c in stamped.columns])

    def staged(self, stamped: DataFrame) -> DataFrame:
        """Classified rows whose lineage is cut. Rules with references look up what is staged."""
        if not any(rule.refers for rule in self.rules):
            return self.stage(quality.classify(stamped, self.rules, self.options.null_policy))
        flagged, self.rules = resolve_references(
            self.stage(stamped),
            self.rules,
            self.lake.read,
            lambda missing: self.lake.stage(f"{self.spec.target_object}.missing", missing),
        )
        return quality.classify(flagged, self.rules, self.options.null_policy)

    def judge(self, staged: DataFrame) -> quality.Rule | None:
        """Count and record what the rules found; gives the rule that stops the load, if any."""
        if not self.rules:
            staged_rows, stop, rejected = staged.count(), None, 0
        else:
            counts = quality.rule_counts(
                staged, self.rules, self.options.null_policy, self.options.enforce_thresholds
            )
            rows = counts.collect()  # one row per rule
            found = self.lake.spark.createDataFrame(rows, counts.schema)
            results = quality.rule_results(found, **self.ids(), evaluated_ts=self.options.load_ts)
            self.lake.append_log(RESULT_LOG, control.DATA_QUALITY_RESULT, results, self.delivered)
            staged_rows = rows[0]["evaluated_row_count"]
            failing = {r["rule_position"]: r["failed_row_count"] for r in rows if r["failed_row_count"]}
            over = sorted(r["rule_position"] for r in rows if r["rule_status"] == quality.FAILED)
            stop = next((self.rules[i] for i in over if self.rules[i].stops), None)
            rejected = sum(n for i, n in failing.items() if self.rules[i].blocks)
            self.counts["rows_quarantined"] = sum(
                n for i, n in failing.items() if self.rules[i].failure_action == quality.QUARANTINE
            )
        self.counts["rows_duplicated"] = self.counts["rows_read"] - staged_rows
        self.counts["rows_rejected"] = rejected
        self.counts["_good"] = staged_rows - rejected
        return stop

    def write_rejects(self, staged: DataFrame, stop: quality.Rule | None) -> None:
        if not self.counts["rows_rejected"]:
            return
        reached = staged if stop is None else staged.filter(F.col(quality.POSITION) <= self.rules.index(stop))
        records = quality.reject_records(
            quality.rejected_rows(reached, self.rules),
            source_object=self.spec.source_object,
            target_object=self.spec.target_object,
            **self.ids(),
            rejected_ts=self.options.load_ts,
        )
        self.lake.append_log(REJECT_LOG, control.REJECTED_RECORD, records, self.delivered)

    def write_good(self, staged: DataFrame, schema: T.StructType, reread: bool = True) -> None:
        cast = "null" if self.options.on_cast_error == "null" else "raise"
        final = align(quality.good_rows(staged), schema, self.options.exclude, cast)
        good = self.counts.pop("_good")
        # Digests can be computed from aligned rows if these still hold what they were computed from.
        digested = self.digested
        for name in existing_names(staged, (*digested[0], *digested[1])) if digested else ():
            held = find_name(final, name)
            if held is None or final.schema[held].dataType != staged.schema[name].dataType:
                digested = None
                break
        if good or self.spec.load_type == control.FULL:
            self.counts |= _write(
                self.lake,
                self.spec,
                final,
                self.keys,
                self.batch_id,
                exclude=self.options.exclude,
                delivery=self.delivered,
                order=self.sequence if self.spec.sequence_column else None,
                rows=good,
                part_column=self.options.part_column,
                reread=reread,
                digested=digested,
            )

    def load_staged(self, staged: DataFrame, schema: T.StructType) -> None:
        stop = self.judge(staged)
        self.write_rejects(staged, stop)
        if stop is not None:
            raise quality.DataQualityError(f"{stop.reason}; {self.counts['rows_rejected']} rows rejected")
        self.write_good(staged, schema)

    def run(self, source: DataFrame, incremental: bool) -> LoadResult:
        rows, low, high = self.bounded(source, incremental)
        if self.counts["rows_read"] or self.spec.load_type == control.FULL:
            stamped, schema, exists = self.conformed(rows)
            if not self.rules and (self.spec.load_type in (control.FULL, control.APPEND) or not exists):
                # Nothing to judge and one output: written straight through.
                self.counts["_good"] = self.counts["rows_read"]
                self.write_good(quality.classify(stamped, [], self.options.null_policy), schema, reread=False)
                self.counts["rows_duplicated"] = self.counts["rows_read"] - self.counts["rows_written"]
            else:
                self.load_staged(self.staged(stamped), schema)
                self.lake.unstage(self.spec.target_object)
            _move_watermark(self.audit, self.spec.watermark_column, low, high)
        self.audit.complete(self.counts, low, high)
        return LoadResult(self.audit.audit_id, self.counts, low, high)


def _move_watermark(audit: RunAudit, name: str | None, low: str | None, high: str | None) -> None:
    """Append a load's new watermark, when it has one."""
    if high is None:
        return
    moment = F.current_timestamp()
    row = [(audit.spec.pipeline_id, name, low, high, audit.batch_id, audit.audit_id)]
    moves = audit.lake.spark.createDataFrame(
        row,
        "pipeline_id string, watermark_column string, previous_watermark string, current_watermark string, "
        "last_successful_batch_id string, last_successful_audit_id string",
    ).withColumns({"last_successful_run_timestamp": moment, "updated_timestamp": moment})
    audit.lake.append_log(WATERMARK_LOG, control.PIPELINE_WATERMARK, moves)


def _write(
    lake: Lake,
    spec: LoadSpec,
    df: DataFrame,
    keys: Sequence[str],
    batch_id: str,
    *,
    preserve: Sequence[str] = (),
    exclude: Sequence[str] = (),
    delivery: str | None = None,
    order: str | None = None,
    rows: int | None = None,
    part_column: str | None = None,
    reread: bool = True,
    digested: tuple[Sequence[str], Sequence[str]] | None = None,
) -> dict:
    """Write by load type. An unknown type is an error, not a merge."""
    if spec.load_type == control.FULL:
        return lake.overwrite(spec.target_object, df, batch_id, part_column)
    if spec.load_type == control.APPEND:
        return lake.append(spec.target_object, df, batch_id, delivery)
    if spec.load_type in (control.MERGE, control.SCD1):
        compare = RECORD_HASH if find_name(df, RECORD_HASH) else None
        # Only a lake's own merge keeps rows from being replaced by older ones.
        own = {"order": order, "reread": reread, "digested": digested} if lake.takes_deliveries else {}
        return lake.merge(
            spec.target_object,
            df,
            keys,
            batch_id,
            compare=compare,
            preserve=preserve,
            exclude=exclude,
            source_rows=rows,
            part_column=part_column,
            **own,
        )
    raise ValueError(f"unknown load type {spec.load_type!r}; known: {control.LOAD_TYPES}")


def _audited(audit: RunAudit, counts: dict, body: Callable[[], LoadResult]) -> LoadResult:
    audit.start()
    try:
        return body()
    except Exception as error:
        audit.fail(error, counts)
        raise


def silver_load(
    lake: Lake,
    spec: LoadSpec,
    batch_id: str,
    *,
    source: DataFrame | None = None,
    rules: Sequence[quality.Rule] = (),
    workflow_audit_id: str | None = None,
    incremental: bool = True,
    options: SilverOptions | None = None,
) -> LoadResult:
    """Load the new rows of a bronze table into its silver table.

    Rule results and rejected rows are kept even when a rule stops the load, which then
    raises :class:`~strata.operators.quality.DataQualityError`. The target is created on the
    first load when it does not exist.
    """
    audit = RunAudit(lake, spec, batch_id, workflow_audit_id)
    load = _Silver(lake, spec, batch_id, list(rules), options or SilverOptions(), audit)

    def body() -> LoadResult:
        return load.run(lake.read(spec.source_object) if source is None else source, incremental)

    return _audited(audit, load.counts, body)


def gold_load(
    lake: Lake,
    spec: LoadSpec,
    batch_id: str,
    *,
    workflow_audit_id: str | None = None,
    key_algorithm: str = "murmur3",
    null_key: str = "hash",
    key_type: str | None = None,
    exclude: Iterable[str] = (),
    part_column: str | None = None,
    incremental: bool = False,
    calendar: tuple[str, str] = (DEFAULT_START, DEFAULT_END),
    load_ts: Column | None = None,
) -> LoadResult:
    """Build a gold table from its silver source.

    By default the whole source is read. With ``incremental=True`` a merge takes only the rows
    that silver loads have written since the last gold load, or with the same stamp as its last
    rows; the others would be found unchanged. That needs silver loads whose stamps don't go
    back (which silver loads with a stamp of their own check), and unchanged key options.

    A merge matches on the surrogate key together with the natural key, so two natural keys
    that share a surrogate key stay two rows. Source keys are checked for repetition.
    """
    audit = RunAudit(lake, spec, batch_id, workflow_audit_id)
    excluded = tuple(exclude)
    merges = spec.load_type in (control.MERGE, control.SCD1)
    counts: dict = {}

    def body() -> LoadResult:
        keys, low, high = list(spec.primary_key_columns), None, None
        target = lake.find(spec.target_object)
        if spec.target_object.split(".")[-1] == gold.DATE_DIMENSION:
            built = dim_date(lake.spark, *calendar, load_ts)
            counts["rows_read"] = built.count()
        else:
            table = gold.gold_table(spec.target_object)
            silver_rows = lake.read(spec.source_object)
            if incremental and merges and find_name(silver_rows, silver.UPDATE_STAMP):
                log = lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK)
                low = None if target is None else load_position(log, spec.pipeline_id)[0]
                # Silver loads may share a stamp: rows at the bound are read again, which the
                # merge finds unchanged.
                pending = incremental_slice(silver_rows, silver.UPDATE_STAMP, low, inclusive=True)
                counts["rows_read"], high = watermark_bounds(pending, silver.UPDATE_STAMP).first()
                silver_rows = incremental_slice(silver_rows, silver.UPDATE_STAMP, low, high, inclusive=True)
            else:
                counts["rows_read"] = silver_rows.count()
            built = gold.build_gold(
                silver_rows,
                table,
                key_algorithm=key_algorithm,
                null_key=null_key,
                key_type=key_type,
                load_ts=load_ts,
            )
            keys.append(gold.natural_key_name(silver_rows, table))
        final = align(built, built.schema if target is None else target.schema, excluded)
        keys = [k for k in keys if find_name(final, k)]
        if merges:
            # A projection of a written table: cheap to read for checking, measuring and joining.
            repeated = repeated_keys(final, keys).limit(5).collect()
            if repeated:
                raise ValueError(f"{spec.target_object}: source repeats keys, such as {repeated}")
        if counts["rows_read"] or target is None or not merges:
            written = _write(
                lake,
                spec,
                final,
                keys,
                batch_id,
                preserve=PRESERVED,
                exclude=excluded,
                rows=counts["rows_read"],
                part_column=part_column,
            )
            counts.update(written)
        _move_watermark(audit, silver.UPDATE_STAMP, low, high)
        audit.complete(counts, low, high)
        return LoadResult(audit.audit_id, counts, low, high)

    return _audited(audit, counts, body)


def run_group(
    lake: Lake,
    config: DataFrame,
    group: str,
    batch_id: str,
    *,
    rules: DataFrame | None = None,
    workflow_audit_id: str | None = None,
    silver_options: SilverOptions | None = None,
    gold_options: dict | None = None,
) -> list[LoadResult]:
    """Run a group's active loads in order; the first error ends it."""
    results = []
    for spec in control.active_loads(config, group):
        if group == "SILVER":
            own = control.active_rules(rules, spec.pipeline_id)
            result = silver_load(
                lake, spec, batch_id, rules=own, workflow_audit_id=workflow_audit_id, options=silver_options
            )
        else:
            result = gold_load(
                lake, spec, batch_id, workflow_audit_id=workflow_audit_id, **(gold_options or {})
            )
        results.append(result)
    return results


def with_load_type(spec: LoadSpec, load_type: str) -> LoadSpec:
    return replace(spec, load_type=load_type)
