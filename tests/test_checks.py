"""Every registered query against its SQL, and the plans the scale of the work depends on."""

import pytest

import __spark_entry__
from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= __spark_entry__.queries().keys()
    assert set(ORACLES) <= __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert compare.difference(spark, connection, FOLDER, name) is None


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(spark, "dedupe_latest")
    assert text.count("WindowGroupLimit") == 2 and ", Partial" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_slices_reach_the_scan(spark):
    assert "GreaterThan(o_orderdate" in plan(spark, "incremental_slice")
    text = plan(spark, "watermark_bounds")
    assert "GreaterThan(ts" in text and "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_rule_counts_move_one_row_per_task(spark):
    text = plan(spark, "dq_results")
    assert "Exchange SinglePartition" in text and "hashpartitioning" not in text
    assert "l_partkey" not in text


def test_latest_runs_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "latest_runs")


def test_no_python_and_no_cross_join_anywhere(spark):
    for name in QUERIES:
        if name.startswith(("write_", "silver_load", "gold_load", "stream_", "merge_measured")):
            continue  # these return what they have written
        text = plan(spark, name)
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
