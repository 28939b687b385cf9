"""Loads against catalog tables. Parquet tables have no row-level merge, so only its refusal is seen here."""

import pytest
from pyspark.errors import PySparkException

from strata.plans.audit import RUN_LOG, run_state
from strata.plans.loads import SilverOptions, silver_load, with_load_type
from strata.sources import control
from strata.sources.catalog import CatalogTables
from strata.sources.control import LoadSpec
from tests.conftest import rows

SPEC = LoadSpec("PL_C", "c", "SILVER", "lakeside.bronze_thing", "lakeside.thing", "FULL", ("id",))


@pytest.fixture
def tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE lakeside LOCATION '{tmp_path}/lakeside'")
    yield CatalogTables(spark, "lakeside")
    spark.sql("DROP DATABASE lakeside CASCADE")


def test_loads_by_catalog_name(spark, tables):
    spark.sql("SELECT 1 id, 'a' v").write.saveAsTable(SPEC.source_object)
    assert silver_load(tables, SPEC, "B1").counts["rows_inserted"] == 1
    appended = silver_load(tables, with_load_type(SPEC, "APPEND"), "B2")
    assert appended.counts["rows_written"] == 1
    assert rows(spark.table("lakeside.thing"), "id", "v", "silver_batch_id") == [(1, "a", "B1"), (1, "a", "B2")]
    states = run_state(tables.log(RUN_LOG, control.PIPELINE_RUN_AUDIT))
    assert rows(states, "run_status") == [("SUCCESS",), ("SUCCESS",)]
    assert tables.log("nothing", control.REJECTED_RECORD).count() == 0


def test_a_first_merge_creates_and_a_second_needs_row_level_operations(spark, tables):
    merge = with_load_type(SPEC, "MERGE")
    assert silver_load(tables, merge, "B1", source=spark.sql("SELECT 1 id, 'a' v")).counts["rows_inserted"] == 1
    with pytest.raises(PySparkException, match="(?i)merge into table"):
        silver_load(tables, merge, "B2", source=spark.sql("SELECT 1 id, 'b' v UNION ALL SELECT 2, 'c'"))
    assert rows(spark.table("lakeside.thing"), "id", "v") == [(1, "a")]


def test_a_replayable_append_is_refused(spark, tables):
    with pytest.raises(ValueError, match="tried again"):
        silver_load(
            tables,
            with_load_type(SPEC, "APPEND"),
            "B1",
            source=spark.sql("SELECT 1 id"),
            options=SilverOptions(replayable=True),
        )
