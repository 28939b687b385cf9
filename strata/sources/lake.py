"""Named parquet tables under one shared folder, written by Spark's dynamic partition overwrite.

Each table is a folder partitioned by PART, a column that readers don't see. A merge reads the parts
that hold one of its keys, found by a join, and the parts its new rows go to; it writes these parts
anew and no other, and Spark puts them in place of the old ones when the whole job has succeeded. By
default a new row's part is the batch it came with, so a merge rewrites only the batches that hold a
changed key; with a part column it is that column's value. A row stays in the part it was first
written to.

What an append or a log row delivers has a part of its own, named by the delivery, so that a second
try takes the place of the first. A table should have one writer at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import column, existing_names, find_name
from strata.functions.dates import date_key
from strata.functions.hashing import BUSINESS_KEY_HASH, RECORD_HASH, add_hashes
from strata.operators.align import align
from strata.operators.merge import (
    ACTION,
    INSERT,
    MAX_BITMAPS,
    can_sift,
    changes,
    decide,
    fits_broadcast,
    kept_rows,
    key_places,
    located,
    matching_rows,
    merge_metrics,
    merge_scd1,
    merge_sifted,
    replaced_rows,
    sieve,
)
from strata.sources.folders import CODEC

DEFINITIONS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("part_column", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# A small source is broadcast only into parts with at least this many times its rows.
BROADCAST_RATIO = 10

# Tasks write to so few parts as they are; to more, rows are first brought together by part.
FEW_PARTS = 16

PART = "_part"
TEXT_PARTS = 256
NO_PART = "none"
WHOLE = "all"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def part_of(df: DataFrame, name: str | None, batch_id: str) -> Column:
    """The part a new row goes to: its batch, or a day, a whole number, or a digest of ``name``."""
    if name is None:
        return F.lit(f"batch-{_digest(batch_id)}")
    dtype = df.schema[find_name(df, name)].dataType
    value = column(find_name(df, name))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        part = date_key(value)
    elif isinstance(dtype, T.IntegralType):
        part = value
    else:
        part = F.pmod(F.xxhash64(value), F.lit(TEXT_PARTS))
    return F.coalesce(part.cast("string"), F.lit(NO_PART))


class Lake:
    # An append that is tried again takes the place of the first try.
    takes_deliveries = True

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[str, tuple[T.StructType, str | None]] = {}

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _stored(self, folder: str, schema: T.StructType) -> DataFrame:
        """Rows of a partitioned folder with their PART; one nobody has written to is empty."""
        whole = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        try:
            return self.spark.read.schema(whole).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, whole)

    @staticmethod
    def _replace_parts(df: DataFrame, folder: str) -> None:
        """Write the parts that ``df`` has rows of; the others stay as they are."""
        writer = df.write.mode("overwrite").options(**CODEC).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(folder)

    # --- append-only logs -------------------------------------------------------------

    def log(self, name: str, schema: T.StructType) -> DataFrame:
        """All rows of a log; a log nobody has written to is empty."""
        return self._stored(f"{self.root}/_logs/{name}", schema).drop(PART)

    def append_log(self, name: str, schema: T.StructType, rows: DataFrame, delivery: str | None = None) -> None:
        """Add rows to a log. Those of a ``delivery`` take the place of an earlier try of it."""
        folder = f"{self.root}/_logs/{name}"
        aligned = align(rows, schema)
        if delivery is None:
            aligned.withColumn(PART, F.lit("rows")).write.mode("append").options(**CODEC).partitionBy(PART).parquet(folder)
        else:
            self._replace_parts(aligned.withColumn(PART, F.lit(f"delivery-{_digest(delivery)}")), folder)

    # --- reading ----------------------------------------------------------------------

    def _definition(self, name: str) -> tuple[T.StructType, str | None] | None:
        """A table's schema and part column, which stay what they were when it was created."""
        if name not in self._known:
            rows = self.log("tables", DEFINITIONS).filter(F.col("table_name") == name)
            first = rows.orderBy("created_at", "table_schema").first()
            if first is None:
                return None
            self._known[name] = T.StructType.fromJson(json.loads(first["table_schema"])), first["part_column"]
        return self._known[name]

    def find(self, name: str) -> DataFrame | None:
        found = self._definition(name)
        return self._stored(self._folder(name), found[0]).drop(PART) if found else None

    def read(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise ValueError(f"no table {name!r} in {self.root}")
        return found

    # --- writing ----------------------------------------------------------------------

    def create(self, name: str, schema: T.StructType, part_column: str | None = None) -> None:
        """An empty table, so that loads have a schema to align to."""
        if self._definition(name) is None:
            row = self.spark.createDataFrame([(name, schema.json(), part_column)], T.StructType(DEFINITIONS.fields[:-1]))
            self.append_log("tables", DEFINITIONS, row.withColumn("created_at", F.current_timestamp()))

    def overwrite(self, name: str, df: DataFrame, batch_id: str, part_column: str | None = None) -> dict:
        """Replace all rows; an existing table keeps its schema.

        A table that has only ever been replaced is one part, which Spark exchanges when the job has
        succeeded; so ``df`` may be read from the table itself. With other parts, or without new
        rows, the folder is emptied first.
        """
        self.create(name, df.schema, part_column)
        schema, part_column = self._definition(name)
        folder = self._folder(name)
        others = part_column or not self._stored(folder, schema).filter(F.col(PART) != WHOLE).isEmpty()
        observation = Observation()
        placed = align(df, schema).withColumn(PART, part_of(df, part_column, batch_id) if part_column else F.lit(WHOLE))
        # A table of one part is written by the tasks that have the rows.
        placed = placed.hint("rebalance", PART) if part_column else placed
        watched = placed.observe(observation, F.count(F.lit(1)).alias("rows_written"))
        if others:
            watched.write.mode("overwrite").options(**CODEC).partitionBy(PART).parquet(folder)
        else:
            self._replace_parts(watched, folder)
            if not observation.get["rows_written"]:
                empty_frame(self.spark, placed.schema).write.mode("overwrite").partitionBy(PART).parquet(folder)
        return self._added("OVERWRITE", observation.get["rows_written"])

    def append(self, name: str, df: DataFrame, batch_id: str, delivery: str | None = None) -> dict:
        """Add rows, as a part of their own.

        Rows of a ``delivery`` take the place of an earlier try of it, so neither a replay nor a
        retry adds rows twice.
        """
        self.create(name, df.schema)
        part = f"delivery-{_digest(delivery)}" if delivery else f"delivery-{uuid4().hex}"
        observation = Observation()
        watched = df.observe(observation, F.count(F.lit(1)).alias("rows_written"))
        self._replace_parts(watched.withColumn(PART, F.lit(part)), self._folder(name))
        return self._added("APPEND", observation.get["rows_written"])

    @staticmethod
    def _added(operation: str, rows: int) -> dict:
        return {"operation": operation, "rows_written": rows, "rows_inserted": rows, "rows_updated": 0, "rows_deleted": 0}

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
        order: str | None = None,
        reread: bool = True,
        digested: tuple[Sequence[str], Sequence[str]] | None = None,
    ) -> dict:
        """Upsert ``source``, whose keys must be unique, into a table.

        With ``order`` a row isn't replaced by one whose value of that column is smaller.

        The source should be cheap to read several times, such as a written table. When it was
        measured to be small, and much smaller than the parts it meets, it is broadcast, and they
        are read without being shuffled. Otherwise keys and digests are joined first, and then only rows
        that may have changed (see ``merge_sifted``). ``digested`` names the columns that the source's two
        digests are computed from: then source rows are joined without them, and target rows that aren't replaced
        are read where they stand and not shuffled (see ``changes``). ``part_column`` is how a table that does not exist
        yet will be kept; with ``reread=False`` its first rows are read once, to be written.
        """
        new = self._definition(name) is None
        self.create(name, source.schema, part_column)
        schema, part_column = self._definition(name)
        # The stored types stand, whatever the source's are.
        source = align(source, T.StructType([f for f in schema.fields if find_name(source, f.name)]))
        source = source.withColumn(PART, part_of(source, part_column, batch_id))
        small, few = False, part_column is None
        if new:
            merged = source.withColumn(ACTION, F.lit(INSERT))
            if part_column and reread:
                few = self._are_few(source.select(PART).distinct())
        else:
            target = self._stored(self._folder(name), schema)
            small = fits_broadcast(source, source_rows)
            rows = source.count() if source_rows is None else source_rows
            places = key_places(rows)
            options = {"compare": compare, "preserve": [*preserve, PART], "exclude": exclude, "order": order}
            plain = not small and can_sift(target, source, keys)
            rests = plain and digested is not None and self._has_files(target)
            sifts = plain and not rests
            if rests:
                target, digests = located(target), existing_names(source, (BUSINESS_KEY_HASH, RECORD_HASH))
                found = changes(target, source.drop(*digests), keys, lambda df: add_hashes(df, *digested), **options)
                changed = self.stage(f"{name}.decided", found.drop(*digests))
                reached = changed.select(PART)
            elif sifts:
                # The whole target is looked through, but only its keys and digests are read.
                decided = self.stage(f"{name}.decided", decide(target, source, keys, places, compare, [PART]))
                reached = decided.select(PART).filter(F.col(PART).isNotNull()).unionByName(source.select(PART))
            else:
                held = matching_rows(target, source.drop(PART), keys, small).select(PART)
                reached = held.unionByName(source.select(PART))
            # Parts that hold a key of the source now, and parts its rows go to; one short row each.
            parts = self.stage(f"{name}.parts", reached.distinct())
            if rests and parts.isEmpty():
                self.unstage(f"{name}.decided")
                return {"operation": "MERGE", "rows_inserted": 0, "rows_updated": 0, "rows_written": 0, "rows_deleted": 0, "broadcast": False}
            few = self._are_few(parts)
            # The filter lets Spark read the parts that were found and skip the others' files.
            found = F.broadcast(parts.filter(F.col(PART) >= ""))
            touched = target.join(found, PART, "left_semi")
            if rests:
                replaced = self.stage(f"{name}.replaced", replaced_rows(changed))
                kept = kept_rows(touched, replaced, replaced.count() <= MAX_BITMAPS)
                merged = kept.unionByName(add_hashes(changed, *digested).select(*[column(c) for c in kept.columns]))
            elif sifts:
                merged = merge_sifted(touched.select(*schema.names, PART), source, keys, sieve(decided), places, **options)
            else:
                touched = touched.select(*schema.names, PART)
                if small and touched.count() < BROADCAST_RATIO * rows:
                    small = False
                merged = merge_scd1(touched, source, keys, small_source=small, **options)
        observation = Observation()
        # Rebalancing splits a part that holds much of the table over several tasks.
        merged = merged if few else merged.hint("rebalance", PART)
        watched = merged.observe(observation, *merge_metrics()).drop(ACTION)
        self._replace_parts(watched, self._folder(name))
        if not new and plain:
            self.unstage(f"{name}.decided")
            if rests:
                self.unstage(f"{name}.replaced")
        return {"operation": "MERGE", **observation.get, "rows_deleted": 0, "broadcast": small}

    @staticmethod
    def _has_files(table: DataFrame) -> bool:
        """Whether rows have a place in a file; a table nobody has written to has none."""
        try:
            return bool(table.select("_metadata.row_index").columns)
        except AnalysisException:
            return False

    @staticmethod
    def _are_few(parts: DataFrame) -> bool:
        return parts.limit(FEW_PARTS + 1).count() <= FEW_PARTS

    # --- staging ----------------------------------------------------------------------

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write a frame once and read it back: later steps no longer repeat its lineage.

        The next frame that is staged by this name takes its place; ``unstage`` empties it.
        """
        folder = f"{self.root}/_staging/{name.replace('.', '/')}/rows"
        df.write.mode("overwrite").options(**CODEC).parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def unstage(self, name: str) -> None:
        """Give up the space of a staged frame."""
        self.stage(name, empty_frame(self.spark, T.StructType([T.StructField("nothing", T.IntegerType())])))
