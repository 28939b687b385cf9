import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.align import align, cast_failures
from strata.operators.calendar import calendar_columns, date_range_of, dim_date
from strata.operators.dedupe import duplicate_counts, latest_per_key, repeated_keys
from tests.conftest import rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_default_calendar(spark):
    df = dim_date(spark)
    assert df.count() == 730
    by_key = {r["date_key"]: r for r in df.collect()}
    day = by_key[20250105]
    assert (day["day_name"], day["day_of_week"], day["is_weekend"]) == ("Sunday", 1, True)
    assert (day["month_name"], day["quarter_name"], day["week_of_year"]) == ("January", "Q1", 1)
    assert by_key[20261231]["quarter_name"] == "Q4" and not by_key[20261231]["is_weekend"]
    assert min(by_key) == 20250101


def test_calendar_bounds_are_inclusive(spark):
    assert dim_date(spark, "2024-02-28", "2024-03-01").count() == 3
    assert dim_date(spark, "2024-02-28", "2024-02-28").count() == 1


def test_calendar_of_a_table(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 1),), (None,)], "d date")
    assert rows(calendar_columns(date_range_of(df, F.col("d"))), "date_key") == [(20240101,), (20240102,), (20240103,)]


SCHEMA = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("km", T.IntegerType()),
        T.StructField("sold", T.DateType()),
        T.StructField("row_id", T.LongType()),
    ]
)


def test_align_casts_adds_drops_orders_and_excludes(spark):
    df = spark.createDataFrame([("5", "x", 1)], "KM string, extra string, Vin int")
    out = align(df, SCHEMA, exclude=["ROW_ID"])
    assert out.dtypes == [("vin", "string"), ("km", "int"), ("sold", "date")]
    assert rows(out) == [("1", 5, None)]


def test_align_keeps_a_column_that_differs_only_in_case(spark):
    df = spark.createDataFrame([("W1",)], "VIN string")
    assert rows(align(df, SCHEMA), "vin") == [("W1",)]


def test_align_on_values_that_do_not_cast(spark):
    df = spark.createDataFrame([("1", "12"), ("2", "many"), ("3", None)], "vin string, km string")
    with pytest.raises(PySparkException):
        align(df, SCHEMA).collect()
    assert rows(align(df, SCHEMA, on_cast_error="null"), "vin", "km") == [("1", 12), ("2", None), ("3", None)]
    assert rows(df.filter(cast_failures(df, SCHEMA)), "vin") == [("2",)]
    with pytest.raises(ValueError):
        align(df, SCHEMA, on_cast_error="ignore")


def test_align_twice_is_align_once(spark):
    df = spark.createDataFrame([("1", "12", "2024-01-01")], "vin string, km string, sold string")
    once = align(df, SCHEMA)
    assert rows(align(once, SCHEMA)) == rows(once)


def test_align_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "vin string")
    assert align(df, SCHEMA).columns == SCHEMA.names and align(df, SCHEMA).count() == 0


def test_latest_row_wins_and_null_sequences_lose(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, "new"), (1, None, "unknown"), (2, None, "only"), (None, 1, "a"), (None, 2, "b")],
        "k int, seq int, v string",
    )
    assert rows(latest_per_key(df, ["k"], "seq")) == [(None, 2, "b"), (1, 9, "new"), (2, None, "only")]


def test_ties_go_by_the_remaining_columns(spark):
    df = spark.createDataFrame([(1, 5, "a", 1), (1, 5, "b", 0)], "k int, seq int, v string, w int")
    assert rows(latest_per_key(df, ["k"], "seq")) == [(1, 5, "b", 0)]


def test_absent_keys_are_ignored_and_no_key_keeps_all(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert rows(latest_per_key(df, ["absent", "K"])) == [(1, "b")]
    assert latest_per_key(df, ["absent"]).count() == 3
    assert rows(duplicate_counts(df, ["absent"])) == [(3, 3, 0)]


def test_columns_without_an_order_do_not_break_the_tie_break(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS m, array(1, 2) AS a, named_struct('x', 1) AS s")
    assert latest_per_key(df, ["k"]).count() == 1


def test_counts_of_an_empty_frame(spark):
    assert rows(duplicate_counts(spark.createDataFrame([], "k int"), ["k"])) == [(0, 0, 0)]


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(repeated_keys(df, ["k"])) == [(None, 2), (1, 2)]


ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 9)), max_size=12)


@FEW
@given(data=ROWS, parts=st.integers(1, 5))
def test_dedupe_does_not_depend_on_partitioning(spark, data, parts):
    df = spark.createDataFrame(data, "k int, seq int, v int")
    want = sorted({k: max((s, v) for kk, s, v in data if kk == k) for k, _, _ in data}.items())
    got = rows(latest_per_key(df.repartition(parts), ["k"], "seq"))
    assert got == [(k, s, v) for k, (s, v) in want]
    assert duplicate_counts(df, ["k"]).first() == (len(data), len(want), len(data) - len(want))
