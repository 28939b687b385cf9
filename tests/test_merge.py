import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import merge
from strata.operators.merge import ACTION, fits_broadcast, merge_action_counts, merge_scd1
from tests.conftest import rows
from tests.test_operators import FEW

TARGET = "k int, v string, record_hash string, note string"


def both_ways(target, source, keys, **options):
    """The merge by full join and by broadcast, which must agree."""
    shuffled = merge_scd1(target, source, keys, **options)
    broadcast = merge_scd1(target, source, keys, small_source=True, **options)
    assert rows(shuffled) == rows(broadcast)
    assert shuffled.schema.names == broadcast.schema.names == [*target.columns, ACTION]
    return shuffled


def test_the_four_actions(spark):
    target = spark.createDataFrame([(1, "keep", "h1", "t"), (2, "same", "h2", "t"), (3, "old", "h3", "t")], TARGET)
    source = spark.createDataFrame([(2, "same!", "h2"), (3, "new", "h3b"), (4, "fresh", "h4")], "k int, v string, record_hash string")
    assert rows(both_ways(target, source, ["k"])) == [
        (1, "keep", "h1", "t", "KEEP"),
        (2, "same", "h2", "t", "NOOP"),
        (3, "new", "h3b", "t", "UPDATE"),
        (4, "fresh", "h4", None, "INSERT"),
    ]
    assert rows(merge_action_counts(merge_scd1(target, source, ["k"]))) == [("INSERT", 1), ("KEEP", 1), ("NOOP", 1), ("UPDATE", 1)]


def test_null_keys_match_each_other(spark):
    target = spark.createDataFrame([(None, "a", "h", "t"), (0, "zero", "z", "t")], TARGET)
    source = spark.createDataFrame([(None, "b", "h2")], "k int, v string, record_hash string")
    assert rows(both_ways(target, source, ["k"]), "k", "v", ACTION) == [(None, "b", "UPDATE"), (0, "zero", "KEEP")]


def test_a_null_digest_on_one_side_is_a_change(spark):
    target = spark.createDataFrame([(1, "a", None, "t"), (2, "a", "h", "t"), (3, "a", None, "t")], TARGET)
    source = spark.createDataFrame([(1, "b", "h"), (2, "b", None), (3, "b", None)], "k int, v string, record_hash string")
    assert rows(both_ways(target, source, ["k"]), "k", "v", ACTION) == [(1, "b", "UPDATE"), (2, "b", "UPDATE"), (3, "a", "NOOP")]


def test_without_a_compared_column_every_match_updates(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(both_ways(target, source, ["k"])) == [(1, "a", "UPDATE")]


def test_preserved_excluded_and_source_only_columns(spark):
    target = spark.createDataFrame([(1, "a", "first", 10)], "k int, v string, created string, row_id int")
    source = spark.createDataFrame([(1, "b", "later", 99, "x"), (2, "c", "now", 98, "y")], "K int, V string, CREATED string, row_id int, extra string")
    out = both_ways(target, source, ["k"], preserve=["created"], exclude=["ROW_ID"])
    assert rows(out) == [(1, "b", "first", 10, "UPDATE"), (2, "c", "now", None, "INSERT")]


def test_several_keys(spark):
    target = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k int, j int, v string")
    source = spark.createDataFrame([(1, None, "c"), (2, 2, "d")], "k int, j int, v string")
    assert rows(both_ways(target, source, ["k", "j"])) == [
        (1, None, "c", "UPDATE"),
        (1, 2, "b", "KEEP"),
        (2, 2, "d", "INSERT"),
    ]


def test_only_key_columns(spark):
    target = spark.createDataFrame([(1,)], "k int")
    source = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(both_ways(target, source, ["k"])) == [(1, "NOOP"), (2, "INSERT")]


def test_empty_sides(spark):
    target = spark.createDataFrame([(1, "a", "h", "t")], TARGET)
    assert rows(both_ways(target, target.limit(0), ["k"]), "k", ACTION) == [(1, "KEEP")]
    assert rows(both_ways(target.limit(0), target, ["k"]), "k", ACTION) == [(1, "INSERT")]


def test_duplicate_source_keys_can_be_reduced_first(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, v string, seq int")
    source = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "k int, v string, seq int")
    out = merge_scd1(target, source, ["k"], on_duplicate="latest", sequence="seq")
    assert rows(out) == [(1, "c", 2, "UPDATE")]
    with pytest.raises(ValueError):
        merge_scd1(target, source, ["k"], on_duplicate="first")


def test_keys_are_required(spark):
    df = spark.createDataFrame([(1,)], "k int")
    for keys in ([], ["", ""], ["absent"]):
        with pytest.raises(ValueError):
            merge_scd1(df, df, keys)


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000, [1, 2]) for i in range(50)], "k int, v string, a array<int>")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=49)
    assert not fits_broadcast(df, rows=50, max_rows=49)
    assert not fits_broadcast(df, max_bytes=50_000)
    assert fits_broadcast(df.limit(0), max_bytes=0)


SIDE = st.dictionaries(st.one_of(st.none(), st.integers(0, 5)), st.tuples(st.integers(0, 3), st.sampled_from(["p", "q"])), max_size=6)


def frame(spark, side):
    return spark.createDataFrame([(k, v, h) for k, (v, h) in side.items()], "k int, v int, record_hash string")


@FEW
@given(old=SIDE, new=SIDE)
def test_merge_against_a_plain_model_and_again(spark, old, new):
    target, source = frame(spark, old), frame(spark, new)
    merged = both_ways(target, source, ["k"])
    want = dict(old)
    for k, (v, h) in new.items():
        if k not in old or old[k][1] != h:
            want[k] = (v, h)
    got = merged.drop(ACTION)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == want
    assert got.count() == len(want)
    again = merge_scd1(got, source, ["k"])
    assert rows(again.drop(ACTION)) == rows(got)
    assert {r[0] for r in merge_action_counts(again).collect()} <= {"KEEP", "NOOP"}


@pytest.mark.parametrize("compare", ["record_hash", None])
@pytest.mark.parametrize("places", [1, 7, 4000])
def test_sifted_merge_ends_like_the_plain_merge(spark, places, compare):
    """However many keys share a place, and whatever their texts, only KEEP and NOOP aren't told apart."""
    digest = F.when(F.col("k") % 7 == 0, F.lit("Not a digest")).otherwise(F.sha2((F.col("k") % 5).cast("string"), 256))
    key = F.when(F.col("id") > 0, F.col("id").cast("int")).alias("k")
    target = spark.range(300).select(key, F.lit("old").alias("v"), F.lit("t").alias("note")).withColumn("record_hash", digest)
    changed = F.when(F.col("k") % 9 == 0, F.lit(None)).when(F.col("k") % 4 == 0, F.lit("ABCD")).otherwise(F.col("record_hash"))
    source = spark.range(0, 600, 2).select(key, F.lit("new").alias("v")).withColumn("record_hash", digest).withColumn("record_hash", changed)
    assert merge.can_sift(target, source, ["k"])
    decided = merge.decide(target, source, ["k"], places, compare, ["note"])
    assert decided.count() == 300 and decided.filter("note IS NULL").count() == 150
    sifted = merge.merge_sifted(target, source, ["K"], merge.sieve(decided), places, compare=compare, preserve=["note"])
    plain = merge_scd1(target, source, ["k"], compare=compare, preserve=["note"])
    assert sifted.schema.names == plain.schema.names
    as_kept = F.when(F.col(ACTION) == "NOOP", "KEEP").otherwise(F.col(ACTION)).alias(ACTION)
    names = ["k", "v", "note", "record_hash"]
    assert rows(sifted.select(*names, as_kept)) == rows(plain.select(*names, as_kept))


def test_rows_that_did_not_change_are_not_joined(spark, monkeypatch):
    target = spark.range(2000).selectExpr("id k", "sha2(cast(id as string), 256) record_hash")
    source = spark.range(1990, 3000).selectExpr("id k", "sha2(if(id = 1995, 'x', cast(id as string)), 256) record_hash")
    places = merge.key_places(1010)
    joined = []
    plain = merge.merge_scd1
    monkeypatch.setattr(merge, "merge_scd1", lambda old, new, *a, **o: joined.append((old, new)) or plain(old, new, *a, **o))
    state = merge.merge_sifted(target, source, ["k"], merge.sieve(merge.decide(target, source, ["k"], places, "record_hash")), places)
    counts = dict(rows(merge_action_counts(state)))
    assert (counts["INSERT"], counts["UPDATE"], counts["KEEP"] + counts.get("NOOP", 0)) == (1000, 1, 1999)
    old, new = joined[0]
    assert old.count() < 20 and new.count() < 20


def test_digests_are_packed_for_the_shuffle_and_any_text_comes_back(spark):
    texts = ["ab" * 32, "AB" * 32, "abc", "", "\x01ab", "ab" * 32 + "\n", "zz", "äß", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    packed = merge._packed(F.col("t"))
    got = df.select("t", merge._unpacked(packed).alias("back"), F.octet_length(packed).alias("n")).collect()
    assert [r.t for r in got] == [r.back for r in got] == texts and got[0].n == 33 and got[1].n == 65


def test_a_full_join_shuffles_digests_as_bytes(spark):
    schema = "k int, record_hash string, business_key_hash string"
    target, source = (spark.createDataFrame([(1, "ab" * 32, "cd" * 32)], schema) for _ in range(2))
    plan = merge_scd1(target, source, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join FullOuter"):]
    assert below.count("unhex(record_hash") and below.count("unhex(business_key_hash")


@pytest.mark.parametrize("compare, order", [("record_hash", None), (None, None), ("record_hash", "v")])
def test_rows_that_stay_are_read_where_they_stand(spark, tmp_path, compare, order):
    """However rows lie in files, only KEEP and NOOP aren't told apart."""
    key = F.when(F.col("id") > 0, F.col("id").cast("int")).alias("k")
    digest = F.sha2((F.col("k") % 5).cast("string"), 256)
    target = spark.range(300).select(key, (F.col("id") % 3).alias("v"), F.lit("t").alias("note"), F.lit("own").alias("left")).withColumn("record_hash", digest)
    target.repartition(3).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(0, 600, 2).select(key, F.lit(1).cast("bigint").alias("v"), F.lit("new").alias("note"))

    def finish(df):
        return df.withColumn("record_hash", F.when(F.col("k") % 4 == 0, "ABCD").otherwise(F.sha2((F.col("k") % 5).cast("string"), 256)))

    options = {"compare": compare, "preserve": ["note"], "order": order}
    found = merge.changes(merge.located(target), source, ["K"], finish, **options).localCheckpoint()
    for small in (True, False):
        kept = merge.kept_rows(merge.located(target), merge.replaced_rows(found), small)
        plain = merge_scd1(target, finish(source), ["k"], **options)
        as_kept = F.when(F.col(ACTION) == "NOOP", "KEEP").otherwise(F.col(ACTION)).alias(ACTION)
        names = ["k", "v", "note", "left", "record_hash"]
        state = kept.unionByName(found.select(kept.columns))
        assert rows(state.select(*names, as_kept)) == rows(plain.select(*names, as_kept))
