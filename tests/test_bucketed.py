"""Merges into a bucketed table: same result, and the target isn't shuffled."""

from uuid import uuid4

import pytest

from strata.operators.merge import ACTION, merge_scd1
from strata.sources.bucketed import BUCKET_ROWS, BucketedTable, buckets_for, key_text
from tests.conftest import rows

SCHEMA = "a int, b string, v string"


@pytest.fixture
def table(spark):
    made = BucketedTable(spark, f"t_{uuid4().hex}", ["a", "b"], 4)
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.name}")


FIRST = [(1, "x", "old"), (1, None, "null"), (1, "", "empty"), (None, None, "none"), (2, "y", "stays"), (3, 'q"\\', "quoted")]
SECOND = [(1, "x", "new"), (1, None, "NULL"), (None, None, "NONE"), (9, "z", "added"), (3, 'q"\\', "QUOTED")]


def test_state_and_actions_are_those_of_a_plain_merge(spark, table):
    target, source = spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND, SCHEMA)
    table.create(target)
    want = merge_scd1(target, source, ["a", "b"], compare="v")
    assert rows(table.merged(source, compare="v").drop("_key_text"), "a", "b", "v", ACTION) == rows(want, "a", "b", "v", ACTION)
    for _ in range(2):
        table.merge(source, compare="v")
        assert rows(table.read()) == rows(want, "a", "b", "v")
    table.merge(source.limit(0), compare="v")
    assert rows(table.read()) == rows(want, "a", "b", "v")


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_only_the_batch_is_shuffled(spark, table, broadcast):
    table.create(spark.range(1000).selectExpr("cast(id as int) a", "'x' b", "'old' v"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        for _ in range(2):
            source = spark.range(500, 1500).selectExpr("cast(id as int) a", "'x' b", "'new' v")
            merged = table.merged(source, compare="v")
            tree = merged._jdf.queryExecution().executedPlan().toString()
            assert tree.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in tree
            scan = tree.index("FileScan")
            branch = tree[:scan].rsplit("SortMergeJoin", 1)[1]
            assert "Exchange" not in branch
            table.merge(source, compare="v")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_keys_as_text_tell_null_from_empty(spark):
    df = spark.createDataFrame([(1, None, ""), (1, "", ""), (1, "null", ""), (None, "1", "")], SCHEMA)
    assert df.select(key_text(df, ["A", "b"])).distinct().count() == 4


def test_buckets_grow_with_the_table():
    assert [buckets_for(n, 8) for n in (0, 10, 8 * BUCKET_ROWS, 8 * BUCKET_ROWS + 1)] == [8, 8, 8, 9]
    assert buckets_for(0) == 1 and buckets_for(100 * BUCKET_ROWS) == 100
