"""Tables of the session's catalog, for loads that write where row-level merges exist.

The same loads run against a :class:`~strata.sources.lake.Lake` or against this class. A
merge is handed to the catalog with ``DataFrame.mergeInto``; a catalog whose tables have no
row-level operations (plain parquet) refuses it, and then a Lake is the place to write to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, find_name
from strata.operators.align import align
from strata.operators.merge import INSERT, UPDATE, MergeColumns, merge_action_counts, merge_scd1
from strata.sources.folders import shared_folder
from strata.sources.lake import empty_frame


class CatalogTables:
    takes_deliveries = False

    def __init__(self, spark: SparkSession, control: str = "control", provider: str | None = None):
        self.spark = spark
        self.control = control
        self.provider = provider

    def _writer(self, df: DataFrame):
        return df.write.format(self.provider) if self.provider else df.write

    def log(self, name: str, schema: T.StructType) -> DataFrame:
        found = self.find(f"{self.control}.{name}")
        return empty_frame(self.spark, schema) if found is None else align(found, schema)

    def append_log(self, name: str, schema: T.StructType, rows: DataFrame, delivery: str | None = None) -> None:
        """Add rows to a log; of a ``delivery`` (a batch that may come again) those not there yet."""
        known = self.find(f"{self.control}.{name}") if delivery is not None else None
        if known is not None:
            ids = ["pipeline_id", "batch_id"]
            rows = rows.join(known.select(*ids).distinct(), ids, "left_anti")
        self._writer(align(rows, schema)).mode("append").saveAsTable(f"{self.control}.{name}")

    def find(self, name: str) -> DataFrame | None:
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else None

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        folder = shared_folder(self.spark, f"staging-{name}")
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def unstage(self, name: str) -> None:
        """A staged frame lies in a folder of its own below the checkpoint folder, which is cleared with it."""

    def _save(self, name: str, df: DataFrame, mode: str, operation: str, part_column: str | None = None) -> dict:
        observation = Observation()
        writer = self._writer(df.observe(observation, F.count(F.lit(1)).alias("rows"))).mode(mode)
        (writer.partitionBy(part_column) if part_column else writer).saveAsTable(name)
        rows = observation.get["rows"]
        return {
            "operation": operation,
            "rows_written": rows,
            "rows_inserted": rows,
            "rows_updated": 0,
            "rows_deleted": 0,
        }

    def overwrite(self, name: str, df: DataFrame, batch_id: str, part_column: str | None = None) -> dict:
        return self._save(name, df, "overwrite", "OVERWRITE", part_column)

    def append(self, name: str, df: DataFrame, batch_id: str, delivery: str | None = None) -> dict:
        """Add rows. A ``delivery`` that may come again can't be taken back here, so it is refused."""
        if delivery is not None:
            raise ValueError(f"{name}: a load that may be tried again has to merge into a catalog table")
        return self._save(name, df, "append", "APPEND")

    def merge(
        self,
        name: str,
        source: DataFrame,
        keys: Sequence[str],
        batch_id: str,
        *,
        compare: str | None = "record_hash",
        preserve: Sequence[str] = (),
        exclude: Sequence[str] = (),
        source_rows: int | None = None,
        part_column: str | None = None,
    ) -> dict:
        """Upsert ``source`` in place. Actions are counted first, from keys and digests alone."""
        target = self.find(name)
        if target is None:
            return {**self._save(name, source, "errorifexists", "MERGE", part_column)}
        cols = MergeColumns.of(target, source, keys, preserve, exclude)
        compared = [c for c in cols.written if compare and c.lower() == compare.lower()]
        # Without a compared column every match updates, so some written column must be kept.
        needed = [*cols.keys, *(compared or cols.written[:1])]
        merged = merge_scd1(
            target.select(*[column(c) for c in needed]),
            source.select(*[column(find_name(source, c)) for c in needed]),
            keys,
            compare=compare,
        )
        counts = {r["action"]: r["row_count"] for r in merge_action_counts(merged).collect()}
        inserted, updated = counts.get(INSERT, 0), counts.get(UPDATE, 0)

        new = source.alias("source")

        def old(field: str) -> Column:
            return F.col(f"{name}.`{field}`")

        def fresh(field: str) -> Column:
            return F.col(f"source.`{find_name(source, field)}`")

        match = old(cols.keys[0]).eqNullSafe(fresh(cols.keys[0]))
        for key in cols.keys[1:]:
            match = match & old(key).eqNullSafe(fresh(key))
        builder = new.mergeInto(name, match)
        if cols.written:
            changed = ~old(compared[0]).eqNullSafe(fresh(compared[0])) if compared else None
            matched = builder.whenMatched() if changed is None else builder.whenMatched(changed)
            builder = matched.update({c: fresh(c) for c in cols.written})
        everything = [*cols.keys, *cols.written, *cols.preserved]
        builder.whenNotMatched().insert({c: fresh(c) for c in everything}).merge()
        return {
            "operation": "MERGE",
            "rows_written": inserted + updated,
            "rows_inserted": inserted,
            "rows_updated": updated,
            "rows_deleted": 0,
        }
