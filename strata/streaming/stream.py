"""A silver load fed by a stream: each micro-batch is one load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.quality import Rule
from strata.plans.loads import SilverOptions, silver_load
from strata.sources.control import LoadSpec
from strata.sources.lake import Lake


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New parquet files of a folder, each read exactly once per checkpoint."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def without_redelivery(stream: DataFrame, event_time: str, identity: Sequence[str], lateness: str) -> DataFrame:
    """Each row once, however many files bring it: the first delivery of its ``identity``.

    What was seen is kept as state until the event time, less ``lateness``, has passed it; a row
    that is later still is dropped, as it can't be known whether it was seen. Batches may come in
    any order of event time within that bound.
    """
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([event_time, *identity])


def stream_silver(
    lake: Lake,
    stream: DataFrame,
    spec: LoadSpec,
    checkpoint: str,
    *,
    rules: Sequence[Rule] = (),
    options: SilverOptions | None = None,
    workflow_audit_id: str | None = None,
) -> StreamingQuery:
    """Load what has arrived, then stop. The checkpoint is the watermark.

    A batch may be delivered again after a failure. Its id, made of the checkpoint's own id
    and the batch number, is then the same: an append takes the place of its first delivery,
    and a merge of the same rows changes nothing.
    """
    chosen = replace(options or SilverOptions(), replayable=True)

    def load(batch: DataFrame, number: int) -> None:
        query_id = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        batch_id = f"{query_id}-{number}"
        silver_load(
            lake,
            spec,
            batch_id,
            source=batch,
            rules=rules,
            workflow_audit_id=workflow_audit_id,
            incremental=False,
            options=chosen,
        )

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
