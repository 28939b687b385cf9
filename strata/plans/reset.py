"""Resetting the control tables, so that loads are defined anew and start over."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.align import align
from strata.plans.loads import WATERMARK_LOG
from strata.sources import control
from strata.sources.control import GOLD_PATTERN, SILVER_PATTERN, id_matches, replace_matching
from strata.sources.lake import Lake, empty_frame
from strata.streaming.watermark import start_over, watermark_state

CONTROL_TABLES = {
    "pipeline_parameter": (control.PIPELINE_PARAMETER, ("pipeline_id",)),
    "pipeline_dependency": (control.PIPELINE_DEPENDENCY, ("parent_pipeline_id", "child_pipeline_id")),
    "data_quality_rule": (control.DATA_QUALITY_RULE, ("pipeline_id",)),
    "pipeline_config": (control.PIPELINE_CONFIG, ("pipeline_id",)),
}


def reset_control(
    lake: Lake,
    batch_id: str,
    fresh: Mapping[str, DataFrame] | None = None,
    patterns: Iterable[str] = (SILVER_PATTERN, GOLD_PATTERN),
) -> dict[str, int]:
    """Drop what matches ``patterns`` from the five control tables and add the ``fresh`` rows.

    Gives the number of rows each of four tables has then, and of loads that start over. Watermarks
    are kept as a log, so a row is added that ends a load's history: its next incremental load reads
    all rows, and what it appends is a delivery of its own. Doing it again, after a failure or by
    mistake, ends in the same tables: loads that have started over have no history left to end.
    """
    patterns = tuple(patterns)
    counts = {}
    for name, (schema, ids) in CONTROL_TABLES.items():
        lake.create(name, schema)
        stored = lake.read(name)
        new = (fresh or {}).get(name, empty_frame(lake.spark, stored.schema))
        rows = replace_matching(stored, align(new, stored.schema), ids, patterns)
        counts[name] = lake.overwrite(name, rows, batch_id)["rows_written"]
    state = watermark_state(lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK))
    ended = lake.stage("control.start_over", start_over(state.filter(F.coalesce(id_matches("pipeline_id", patterns), F.lit(False)))))
    counts[WATERMARK_LOG] = ended.count()
    if counts[WATERMARK_LOG]:
        lake.append_log(WATERMARK_LOG, control.PIPELINE_WATERMARK, ended)
    return counts
