import hashlib
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.functions.columns import (
    Derived,
    coalesce_existing,
    column_types,
    derive_missing,
    first_existing,
    optional_column,
    payload_columns,
    require_columns,
)
from strata.functions.dates import date_key
from strata.functions.hashing import add_hashes, joined_digest, record_hash, surrogate_key
from tests.conftest import rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_first_existing_goes_by_presence_not_by_value(spark):
    df = spark.createDataFrame([(None, "b")], "first string, second string")
    assert rows(df.select(first_existing(df, ["absent", "first", "second"]))) == [(None,)]
    assert rows(df.select(coalesce_existing(df, ["absent", "first", "second"]))) == [("b",)]


def test_names_are_found_without_regard_to_case(spark):
    df = spark.createDataFrame([("x",)], "VIN string")
    assert rows(df.select(first_existing(df, ["vin"]))) == [("x",)]


def test_absent_columns_get_typed_nulls_or_the_default(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = df.select(
        first_existing(df, ["b"], dtype="date").alias("d"),
        first_existing(df, ["b"], 7).alias("seven"),
        optional_column(df, "b", "double").alias("x"),
        coalesce_existing(df, ["b", "c"], 3).alias("three"),
    )
    assert column_types(out) == {"d": "date", "seven": "int", "x": "double", "three": "int"}
    assert rows(out) == [(None, 7, None, 3)]


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert rows(df.select(first_existing(df, ["a.b"]))) == [(1,)]
    assert column_types(derive_missing(df, [Derived("d", lambda pick: pick.first("a.b") + 1)]))["d"] == "int"


def test_derivations_see_earlier_ones_and_skip_present_columns(spark):
    df = spark.createDataFrame([(1, 10)], "a int, KEPT int")
    out = derive_missing(
        df,
        [
            Derived("b", lambda pick: pick.first("a") + 1),
            Derived("kept", lambda pick: F.lit(-1)),
            Derived("c", lambda pick: pick.first("b") * 2),
        ],
    )
    assert out.columns == ["a", "KEPT", "b", "c"]
    assert rows(out) == [(1, 10, 2, 4)]


def test_required_columns_and_payload(spark):
    df = spark.createDataFrame([(1, 2)], "a int, _working int")
    require_columns(df, ["A"], "here")
    with pytest.raises(ValueError, match="here.*missing_one"):
        require_columns(df, ["a", "missing_one"], "here")
    assert payload_columns(df) == ["a"]


def test_digests_are_those_of_joined_text(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, "")], "k bigint, a string, b string")
    out = add_hashes(df, ["k"], ["a", "b"])
    assert rows(out, "business_key_hash", "record_hash") == sorted(
        [(sha("1"), sha("x||")), (sha("2"), sha("||"))]
    )


def test_digest_covers_all_columns_but_the_digests_by_default(spark):
    df = spark.createDataFrame([(1, "x", "old")], "k bigint, a string, record_hash string")
    assert rows(df.select(record_hash(df))) == [(sha("1||x"),)]


def test_digest_without_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = add_hashes(df, ["absent"], [])
    assert rows(out, "business_key_hash", "record_hash") == [(sha("NO_BUSINESS_KEY"), sha("NO_RECORD_COLS"))]


def test_known_limits_of_the_digest_are_kept(spark):
    df = spark.createDataFrame([("a||b", ""), ("a", "b||"), (None, "x"), ("", "x")], "a string, b string")
    hashes = [r[0] for r in df.select(record_hash(df)).collect()]
    assert hashes[0] == hashes[1] and hashes[2] == hashes[3]


def test_joined_digest_is_null_only_when_all_parts_are(spark):
    df = spark.createDataFrame([("v", None), (None, None)], "vin string, day string")
    assert rows(df.select(joined_digest(F.col("vin"), F.col("day")))) == [(None,), (sha("v"),)]


def test_surrogate_key_is_spark_hash_made_positive(spark):
    df = spark.range(-500, 500).withColumn("text", F.col("id").cast("string"))
    out = df.select(
        (surrogate_key("id") == F.abs(F.hash("id").cast("bigint"))).alias("a"),
        (surrogate_key("text") == F.abs(F.hash("text").cast("bigint"))).alias("b"),
        (surrogate_key("id") >= 0).alias("c"),
    )
    assert out.distinct().collect() == [(True, True, True)]


def test_surrogate_key_of_null(spark):
    df = spark.createDataFrame([(None,)], "id bigint")
    out = df.select(
        surrogate_key("id").alias("a"),
        surrogate_key("id", null_key="null").alias("b"),
        surrogate_key("id", algorithm="xxhash64").alias("c"),
        surrogate_key("id", algorithm="xxhash64", null_key="null").alias("d"),
    )
    assert rows(out) == [(42, None, 42, None)]


def test_surrogate_key_when_the_hash_is_the_smallest_int(spark):
    # The first bigint with that hash, found by search; abs of the smallest int overflows.
    df = spark.createDataFrame([(1957873941,)], "id bigint")
    assert df.select(F.hash("id"), surrogate_key("id")).first() == (-(2**31), 2**31)


def test_wide_surrogate_key_matches_xxhash64(spark):
    ids = [0, 1, -1, 7, 2**40, -(2**40)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = dict(df.select("id", surrogate_key("id", algorithm="xxhash64")).collect())
    for i in ids:
        assert got[i] == xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest() & (2**63 - 1)


def test_surrogate_key_rejects_unknown_choices(spark):
    for choice in ({"algorithm": "md5"}, {"null_key": "zero"}):
        with pytest.raises(ValueError):
            surrogate_key("id", **choice)


def test_date_keys_of_dates_timestamps_and_null(spark):
    df = spark.sql("SELECT DATE'2025-03-09' d, TIMESTAMP'2025-12-31 23:59:59' t, TIMESTAMP_NTZ'1999-01-02 00:00:00' n, CAST(NULL AS DATE) z")
    out = df.select(*[date_key(F.col(c)).alias(c) for c in df.columns])
    assert out.dtypes == [(c, "int") for c in df.columns]
    assert rows(out) == [(20250309, 20251231, 19990102, None)]
    assert df.select(F.date_format("d", "yyyyMMdd").cast("int")).first()[0] == 20250309
