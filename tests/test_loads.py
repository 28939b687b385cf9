import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import FAIL_PIPELINE, QUARANTINE, DataQualityError, Rule
from strata.plans.audit import RUN_LOG, run_state
from strata.plans.loads import (
    REJECT_LOG,
    RESULT_LOG,
    WATERMARK_LOG,
    SilverOptions,
    gold_load,
    run_group,
    silver_load,
    with_load_type,
)
from strata.sources import control
from strata.sources.control import LoadSpec
from strata.sources.folders import shared_folder
from strata.sources.lake import PART, Lake
from strata.sources import lake as lake_module
from strata.streaming.stream import file_stream, stream_silver, without_redelivery
from strata.streaming.watermark import (
    advance_watermarks,
    current_watermark,
    incremental_slice,
    watermark_bounds,
    watermark_state,
)
from tests.conftest import rows

SPEC = LoadSpec("PL_JOB", "job", "SILVER", "bronze.job", "silver.job", "MERGE", ("id",), None, "ingestion_timestamp")
BRONZE = "id int, v string, ingestion_timestamp timestamp"


def at(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def bronze(spark, *data):
    return spark.createDataFrame(list(data), BRONZE)


def state_of(lake):
    return watermark_state(lake.log(WATERMARK_LOG, control.PIPELINE_WATERMARK))


def test_slices(spark):
    df = bronze(spark, (1, "a", at(1)), (2, "b", at(2)), (3, "c", at(3)), (4, "d", None))
    name = "INGESTION_TIMESTAMP"
    assert rows(incremental_slice(df, name), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(incremental_slice(df, name, None, "2025-01-02 00:00:00"), "id") == [(1,), (2,), (4,)]
    assert rows(incremental_slice(df, name, "2025-01-01 00:00:00", "2025-01-02 00:00:00"), "id") == [(2,)]
    assert rows(incremental_slice(df, name, "2025-01-02 00:00:00"), "id") == [(3,)]
    assert rows(incremental_slice(df, name, "2025-01-02 00:00:00", lag="1 hour"), "id") == [(2,), (3,)]
    assert rows(watermark_bounds(df, name)) == [(4, "2025-01-03 00:00:00.000000Z")]
    assert rows(watermark_bounds(df.limit(0), name)) == [(0, None)]
    with pytest.raises(ValueError):
        incremental_slice(df, "absent")


def test_numeric_watermarks_compare_as_numbers(spark):
    assert rows(incremental_slice(spark.range(8, 12), "id", "9", "10")) == [(10,)]


def test_watermark_upsert(spark):
    def moves(*data):
        full = [(p, "c", None, w, b, "a", at(1), at(1)) for p, w, b in data]
        return spark.createDataFrame(full, control.PIPELINE_WATERMARK)

    state = advance_watermarks(moves(), moves(("P", "1", "B1"), ("Q", "1", "B1")))
    state = advance_watermarks(state, moves(("P", "2", "B2"), ("Q", None, "B2"), ("R", "5", "B2")))
    assert state.columns == control.PIPELINE_WATERMARK.names
    assert rows(state, "pipeline_id", "previous_watermark", "current_watermark", "last_successful_batch_id") == [
        ("P", "1", "2", "B2"),
        ("Q", None, "1", "B1"),
        ("R", None, "5", "B2"),
    ]
    assert current_watermark(state, "P") == "2"
    assert current_watermark(state, "Z") is None and current_watermark(None, "P") is None


def test_two_incremental_merges_and_a_rerun(spark, lake):
    day1 = bronze(spark, (1, "a", at(1)), (2, "b", at(1)), (2, "b2", at(1, 5)))
    first = silver_load(lake, SPEC, "B1", source=day1)
    assert {k: first.counts[k] for k in ("rows_read", "rows_duplicated", "rows_inserted")} == {
        "rows_read": 3, "rows_duplicated": 1, "rows_inserted": 2,
    }
    assert (first.source_watermark, first.target_watermark) == (None, "2025-01-01 05:00:00.000000Z")
    day2 = day1.unionByName(bronze(spark, (2, "b3", at(2)), (3, "c", at(2)), (1, "a", at(2))))
    second = silver_load(lake, SPEC, "B2", source=day2)
    assert (second.counts["rows_read"], second.counts["rows_inserted"], second.counts["rows_updated"]) == (3, 1, 1)
    assert rows(lake.read("silver.job"), "id", "v", "silver_batch_id") == [(1, "a", "B1"), (2, "b3", "B2"), (3, "c", "B2")]
    assert rows(state_of(lake), "previous_watermark", "current_watermark") == [("2025-01-01 05:00:00.000000Z", "2025-01-02 00:00:00.000000Z")]
    third = silver_load(lake, SPEC, "B3", source=day2)
    assert third.counts == {"rows_read": 0}
    again = silver_load(lake, SPEC, "B4", source=day2, incremental=False)
    assert (again.counts["rows_inserted"], again.counts["rows_updated"]) == (0, 0)
    states = run_state(lake.log(RUN_LOG, control.PIPELINE_RUN_AUDIT))
    assert rows(states, "run_status") == [("SUCCESS",)] * 4


def test_late_rows_are_read_again_with_a_lag(spark, lake):
    silver_load(lake, SPEC, "B1", source=bronze(spark, (1, "a", at(2))))
    late = bronze(spark, (1, "a", at(2)), (2, "late", at(1, 23)))
    assert silver_load(lake, SPEC, "B2", source=late).counts["rows_read"] == 0
    options = SilverOptions(watermark_lag="2 hours")
    caught = silver_load(lake, SPEC, "B3", source=late, options=options)
    assert (caught.counts["rows_read"], caught.counts["rows_inserted"], caught.counts["rows_updated"]) == (2, 1, 0)


def test_chunked_loads_end_like_one_full_load(spark, lake):
    data = [(i % 7, f"v{i}", at(1 + i % 3, i % 24)) for i in range(40)]
    spec = LoadSpec(**{**SPEC.__dict__, "sequence_column": "ingestion_timestamp"})
    chunks = LoadSpec(**{**spec.__dict__, "target_object": "silver.chunked", "pipeline_id": "PL_CHUNK"})
    silver_load(lake, spec, "F", source=bronze(spark, *data))
    for day in (1, 2, 3):
        arrived = [r for r in data if r[2].day <= day]
        silver_load(lake, chunks, f"C{day}", source=bronze(spark, *arrived))
    shown = ("id", "v", "record_hash")
    assert rows(lake.read("silver.chunked"), *shown) == rows(lake.read("silver.job"), *shown)


def test_quarantined_rows_are_kept_as_records(spark, lake):
    rules = [Rule("V", "v known", "v IS NOT NULL", QUARANTINE)]
    result = silver_load(lake, SPEC, "B1", source=bronze(spark, (1, "a", at(1)), (2, None, at(1))), rules=rules)
    assert (result.counts["rows_rejected"], result.counts["rows_quarantined"], result.counts["rows_inserted"]) == (1, 1, 1)
    reject = lake.log(REJECT_LOG, control.REJECTED_RECORD).first()
    assert '"id":2' in reject["source_record"] and reject["rejection_reason"] == "V: v known"
    found = lake.log(RESULT_LOG, control.DATA_QUALITY_RESULT).first()
    assert (found["evaluated_row_count"], found["failed_row_count"], found["failure_percentage"]) == (2, 1, 50.0)


def test_a_stopped_load_keeps_its_findings_and_writes_nothing(spark, lake):
    rules = [Rule("V", "v known", "v IS NOT NULL", QUARANTINE), Rule("K", "key known", "id IS NOT NULL", FAIL_PIPELINE), Rule("Z", "later", "id < 2", QUARANTINE)]
    source = bronze(spark, (1, "a", at(1)), (None, "b", at(1)), (2, None, at(1)), (3, "c", at(1)))
    with pytest.raises(DataQualityError, match="K: key known"):
        silver_load(lake, SPEC, "B1", source=source, rules=rules)
    assert lake.find("silver.job") is None and state_of(lake).count() == 0
    assert rows(lake.log(REJECT_LOG, control.REJECTED_RECORD), "failed_rule_ids") == [("K",), ("V",)]
    assert rows(lake.log(RESULT_LOG, control.DATA_QUALITY_RESULT), "rule_id") == [("K",), ("V",)]
    run = run_state(lake.log(RUN_LOG, control.PIPELINE_RUN_AUDIT)).first()
    assert (run["run_status"], run["error_code"], run["rows_read"], run["rows_rejected"]) == ("FAILED", "DataQualityError", 4, 2)


def test_values_that_do_not_fit_the_target(spark, lake):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.IntegerType())])
    source = bronze(spark, (1, "7", at(1)), (2, "seven", at(1)))
    for choice, want, rejected in (("null", [(1, 7), (2, None)], 0), ("reject", [(1, 7)], 1)):
        spec = LoadSpec(**{**SPEC.__dict__, "target_object": choice, "watermark_column": None})
        lake.create(choice, schema)
        result = silver_load(lake, spec, "B", source=source, options=SilverOptions(on_cast_error=choice))
        assert rows(lake.read(choice)) == want and result.counts["rows_rejected"] == rejected
    lake.create("raise", schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver_load(lake, LoadSpec(**{**SPEC.__dict__, "target_object": "raise"}), "B", source=source)
    assert lake.read("raise").count() == 0


def test_full_and_append(spark, lake):
    full = LoadSpec(**{**SPEC.__dict__, "load_type": "FULL", "watermark_column": None})
    silver_load(lake, full, "B1", source=bronze(spark, (1, "a", at(1))))
    silver_load(lake, full, "B2", source=bronze(spark, (2, "b", at(1))))
    assert rows(lake.read("silver.job"), "id") == [(2,)]
    append = with_load_type(full, "APPEND")
    result = silver_load(lake, append, "B3", source=bronze(spark, (2, "b", at(1)), (3, "c", at(1))))
    assert result.counts["rows_written"] == 2
    assert rows(lake.read("silver.job"), "id") == [(2,), (2,), (3,)]
    silver_load(lake, full, "B4", source=bronze(spark))
    assert lake.read("silver.job").count() == 0
    with pytest.raises(ValueError, match="unknown load type"):
        silver_load(lake, with_load_type(full, "MERG"), "B5", source=bronze(spark, (1, "a", at(1))))


def test_a_full_load_keeps_the_target_schema(spark, lake):
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    lake.create("silver.job", schema)
    full = LoadSpec(**{**SPEC.__dict__, "load_type": "FULL", "watermark_column": None})
    silver_load(lake, full, "B1", source=bronze(spark, (1, "a", at(1))), options=SilverOptions(exclude=("ROW_ID",)))
    assert lake.read("silver.job").schema == schema
    assert rows(lake.read("silver.job")) == [(None, 1, "a")]


def test_small_batches_are_broadcast_into_large_targets(spark, lake):
    spec = LoadSpec(**{**SPEC.__dict__, "watermark_column": None})
    base = spark.range(200).select(F.col("id").cast("int"), F.lit("a").alias("v"), F.lit(at(1)).alias("ingestion_timestamp"))
    silver_load(lake, spec, "B1", source=base)
    small = silver_load(lake, spec, "B2", source=bronze(spark, (1, "b", at(2)), (900, "n", at(2))))
    assert small.counts["broadcast"] and (small.counts["rows_inserted"], small.counts["rows_updated"]) == (1, 1)
    large = silver_load(lake, spec, "B3", source=base)
    assert not large.counts["broadcast"] and large.counts["rows_updated"] == 1
    assert lake.read("silver.job").count() == 201


def test_a_table_in_parts_is_rewritten_only_where_a_batch_reaches(spark, lake):
    spec = LoadSpec(**{**SPEC.__dict__, "watermark_column": None})
    plain = LoadSpec(**{**spec.__dict__, "target_object": "silver.plain"})
    options = SilverOptions(part_column="day")

    def days(*data):
        return spark.createDataFrame(list(data), "id int, v string, day date")

    def d(n):
        return dt.date(2025, 1, n) if n else None

    batches = [
        [(1, "a", d(1)), (2, "b", d(1)), (3, "c", d(2)), (4, "d", d(3)), (5, "e", None), (None, "n", d(4))],
        [(2, "b2", d(1)), (6, "f", d(5))],
        [(3, "moved", d(3)), (5, "found", d(2)), (None, "n2", d(4))],
        [(1, "a", d(1))],
    ]
    changed = []
    for number, batch in enumerate(batches):
        before = files(lake, "silver.job")
        result = silver_load(lake, spec, f"B{number}", source=days(*batch), options=options)
        other = silver_load(lake, plain, f"B{number}", source=days(*batch))
        for counter in ("rows_inserted", "rows_updated"):
            assert result.counts[counter] == other.counts[counter]
        after = files(lake, "silver.job")
        changed.append(sorted(p for p in after if before.get(p) != after[p]))
        shown = ("id", "v", "day", "record_hash", "silver_batch_id")
        assert rows(lake.read("silver.job"), *shown) == rows(lake.read("silver.plain"), *shown)
    assert changed[0] == ["20250101", "20250102", "20250103", "20250104", "none"]
    assert changed[1] == ["20250101", "20250105"]
    assert changed[2] == ["20250102", "20250103", "20250104", "none"]  # where rows are, and where theirs would go
    assert changed[3] == ["20250101"]
    parts = files(lake, "silver.plain")
    assert len(parts) == 2  # by default the batches that brought new rows
    silver_load(lake, plain, "B8", source=days((6, "g", d(5))))
    again = files(lake, "silver.plain")
    assert sum(again[p] == parts.get(p) for p in again) == 1


def files(lake, name):
    """The files of each part of a table."""
    out = {}
    for path in Path(lake.root, *name.split(".")).glob(f"{PART}=*/*.parquet"):
        out.setdefault(path.parent.name.split("=")[1], set()).add(path.name)
    return out


def test_a_merge_reads_only_the_parts_it_writes(spark, lake):
    df = spark.range(1000).withColumn("day", F.expr("date_add(date '2025-01-01', cast(id % 5 as int))"))
    lake.merge("t", df, ["id"], "B1", compare=None, part_column="day")
    before = files(lake, "t")
    one = df.filter("id = 7").withColumn("day", F.expr("date '2025-01-03'"))
    result = lake.merge("t", one, ["id"], "B2", compare=None)
    after = files(lake, "t")
    assert [p for p in after if after[p] != before[p]] == ["20250103"]
    assert (result["rows_updated"], result["rows_inserted"], lake.read("t").count()) == (1, 0, 1000)


def test_no_staging_is_left_behind(spark, lake):
    silver_load(lake, SPEC, "B1", source=bronze(spark, (1, "a", at(1)), (2, "b", at(2))))
    silver_load(lake, SPEC, "B2", source=bronze(spark, (1, "a", at(1)), (3, "c", at(3))))
    left = spark.read.option("recursiveFileLookup", True).parquet(f"{lake.root}/_staging/silver/job/rows")
    assert left.count() == 0


def test_a_full_load_may_read_the_table_it_replaces(spark, lake):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    lake.overwrite("t", df, "B1")
    lake.overwrite("t", lake.read("t").filter("id = 2").union(df.filter("id = 1")), "B2")
    assert rows(lake.read("t")) == [(1, "a"), (2, "b")]
    lake.overwrite("t", lake.read("t").filter("id > 5"), "B3")
    assert lake.read("t").count() == 0
    lake.append("t", df, "B4")
    lake.merge("t", df, ["id"], "B5", compare=None)
    lake.overwrite("t", df.filter("id = 1"), "B6")
    assert rows(lake.read("t")) == [(1, "a")]


def test_parts_by_number_and_by_text(spark, lake):
    for name in ("id", "v"):
        df = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "id int, v string")
        lake.merge(f"by_{name}", df, ["id"], "B1", compare=None, part_column=name)
        lake.merge(f"by_{name}", df.filter("id = 2").withColumn("v", F.lit("z")), ["id"], "B2", compare=None)
        assert rows(lake.read(f"by_{name}")) == [(None, None), (1, "a"), (2, "z")]
        lake.overwrite(f"by_{name}", df.filter("id = 1"), "B3")
        assert rows(lake.read(f"by_{name}")) == [(1, "a")]
        lake.overwrite(f"by_{name}", df.limit(0), "B4")
        assert lake.read(f"by_{name}").count() == 0 and lake.read(f"by_{name}").columns == ["id", "v"]


def test_gold_merges_keep_first_times_and_colliding_keys_apart(spark, lake):
    silver_spec = LoadSpec("S", "s", "SILVER", "b", "customer", "MERGE", ("customer_id",))
    spec = LoadSpec("G", "g", "GOLD", "customer", "gold.dim_customer", "MERGE", ("customer_key",))
    people = spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, 'b') AS t(customer_id, name)")
    silver_load(lake, silver_spec, "B1", source=people)
    one = F.lit("2026-01-01 00:00:00").cast("timestamp")
    two = F.lit("2026-01-02 00:00:00").cast("timestamp")
    assert gold_load(lake, spec, "B1", load_ts=one).counts["rows_inserted"] == 2
    silver_load(lake, silver_spec, "B2", source=spark.sql("SELECT 2L customer_id, 'c' name"))
    second = gold_load(lake, spec, "B2", load_ts=two)
    assert (second.counts["rows_updated"], second.counts["rows_inserted"]) == (1, 0)
    got = {r["customer_id"]: r for r in lake.read("gold.dim_customer").collect()}
    assert got[2]["name"] == "c" and got[2]["effective_from"] == dt.datetime(2026, 1, 1)
    assert got[2]["updated_timestamp"] == dt.datetime(2026, 1, 2)


def test_incremental_gold_ends_like_full_gold(spark, lake):
    silver_spec = LoadSpec("S", "s", "SILVER", "b", "customer", "MERGE", ("customer_id",))
    part = LoadSpec("GI", "g", "GOLD", "customer", "inc.dim_customer", "MERGE", ("customer_key",))
    whole = LoadSpec("GF", "g", "GOLD", "customer", "full.dim_customer", "MERGE", ("customer_key",))

    def load(number, ids, name):
        people = spark.createDataFrame([(i, name) for i in ids], "customer_id bigint, name string")
        silver_load(lake, silver_spec, f"B{number}", source=people)
        gold_load(lake, whole, f"B{number}")
        return gold_load(lake, part, f"B{number}", incremental=True).counts

    assert load(1, range(40), "a")["rows_read"] == 40
    second = load(2, [3, 50], "b")
    assert (second["rows_read"], second["rows_inserted"], second["rows_updated"], second["broadcast"]) == (41, 1, 1, False)
    third = load(3, [3, 50], "b")  # rows at the bound are read again and found unchanged
    assert (third["rows_read"], third["rows_inserted"], third["rows_updated"]) == (2, 0, 0)
    shown = ("customer_key", "customer_id", "name", "silver_batch_id", "record_hash")
    assert rows(lake.read("inc.dim_customer"), *shown) == rows(lake.read("full.dim_customer"), *shown)


def test_gold_load_refuses_repeated_keys(spark, lake):
    lake.overwrite("customer", spark.sql("SELECT * FROM VALUES (1L), (1L) AS t(customer_id)"), "B")
    spec = LoadSpec("G", "g", "GOLD", "customer", "gold.dim_customer", "MERGE", ("customer_key",))
    with pytest.raises(ValueError, match="repeats keys"):
        gold_load(lake, spec, "B")
    assert lake.find("gold.dim_customer") is None


def test_all_shipped_loads_from_empty_to_star_and_again(spark, lake):
    from strata.sources import raw

    config, rules = control.seed_config(spark, "w"), control.seed_rules(spark)
    for name, make in raw.BRONZE.items():
        stamped = make(spark, "/root/testdata/sf0.001").withColumn("ingestion_timestamp", F.lit(at(1)))
        lake.overwrite(f"w.bronze.{name}", stamped, "B0")
    silver_results = run_group(lake, config, "SILVER", "B1", rules=rules)
    gold_results = run_group(lake, config, "GOLD", "B1", gold_options={"key_algorithm": "xxhash64"})
    assert (len(silver_results), len(gold_results)) == (12, 13)
    assert lake.read("w.gold.dim_date").count() == 730
    orders = lake.read("w.gold.fact_service_order")
    vehicles = lake.read("w.gold.dim_vehicle")
    assert orders.count() == lake.read("w.bronze.service_order").count()
    assert orders.join(vehicles, "vehicle_key", "left_anti").count() == 0
    again = control.active_load(config, "PL_SILVER_SERVICE_ORDER")
    assert silver_load(lake, again, "B2").counts["rows_read"] == 0
    again = control.active_load(config, "PL_GOLD_FACT_SERVICE_ORDER")
    repeated = gold_load(lake, again, "B2", key_algorithm="xxhash64")
    assert (repeated.counts["rows_inserted"], repeated.counts["rows_updated"]) == (0, 0)


def test_group_run_stops_at_the_first_error(spark, lake):
    config = control.seed_config(spark, "w")
    with pytest.raises(ValueError, match="no table 'w.bronze.vehicle_model'"):
        run_group(lake, config, "SILVER", "B1")
    assert lake.log(RUN_LOG, control.PIPELINE_RUN_AUDIT).count() == 2


@pytest.mark.parametrize("load_type", ["MERGE", "APPEND"])
def test_a_stream_ends_like_a_batch_and_a_replay_adds_nothing(spark, lake, tmp_path, load_type):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    data = [(i, f"v{i}", at(1 + i % 3)) for i in range(30)]
    spec = LoadSpec(**{**SPEC.__dict__, "load_type": load_type})
    for part in range(3):
        bronze(spark, *data[part::3]).coalesce(1).write.mode("append").parquet(folder)

    def run(path):
        stream = file_stream(spark, folder, bronze(spark).schema, max_files=1)
        stream_silver(lake, stream, spec, path).awaitTermination()

    run(checkpoint)
    silver_load(lake, LoadSpec(**{**spec.__dict__, "target_object": "batch"}), "B", source=bronze(spark, *data), incremental=False)
    shown = ("id", "v", "record_hash")
    assert rows(lake.read("silver.job"), *shown) == rows(lake.read("batch"), *shown)
    run(checkpoint)
    bronze(spark, (99, "more", at(9))).coalesce(1).write.mode("append").parquet(folder)
    # Forget the last commit, as if the driver had died after the write but before it.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    run(checkpoint)
    assert lake.read("silver.job").count() == 31


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_a_delivery_takes_the_place_of_its_first_try(lake, spark):
    df = spark.range(3)
    for _ in range(2):
        lake.append("t", df, "B1", delivery="one")
        lake.append_log("rejected_record", control.REJECTED_RECORD, spark.createDataFrame([("B1",)], "batch_id string"), "one")
    lake.append("t", df, "B1", delivery="two")
    assert lake.read("t").count() == 6
    assert lake.log("rejected_record", control.REJECTED_RECORD).count() == 1


def test_watermark_text_means_the_same_in_another_zone(spark):
    df = bronze(spark, (1, "a", at(1)))
    high = watermark_bounds(df, "ingestion_timestamp").first()[1]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert incremental_slice(df, "ingestion_timestamp", high).count() == 0
        assert incremental_slice(df, "ingestion_timestamp", None, high).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("bound,stops", [(50.0, False), (49.0, True)])
def test_a_load_stops_only_beyond_a_rules_threshold(spark, lake, bound, stops):
    rules = [Rule("R", "r", "v <> 'bad'", FAIL_PIPELINE, threshold_value=bound)]
    options = SilverOptions(enforce_thresholds=True)
    source = bronze(spark, (1, "a", at(1)), (2, "bad", at(2)))
    if stops:
        with pytest.raises(DataQualityError):
            silver_load(lake, SPEC, "B1", source=source, rules=rules, options=options)
        assert lake.find("silver.job") is None
    else:
        counts = silver_load(lake, SPEC, "B1", source=source, rules=rules, options=options).counts
        assert (counts["rows_inserted"], counts["rows_rejected"]) == (1, 1)
    assert lake.log("rejected_record", control.REJECTED_RECORD).count() == 1


def test_a_redelivered_file_changes_nothing_whatever_the_order(spark, lake, tmp_path):
    folder, checkpoint = str(tmp_path / "files"), str(tmp_path / "checkpoint")
    batches = [[(1, "new", at(9)), (2, "b", at(8))], [(1, "old", at(1)), (3, "c", at(2))], [(1, "new", at(9)), (2, "b", at(8))]]
    spec = LoadSpec(**{**SPEC.__dict__, "sequence_column": "ingestion_timestamp", "watermark_column": None})

    def run():
        stream = file_stream(spark, folder, bronze(spark, (0, "x", at(1))).schema, max_files=1)
        once = without_redelivery(stream, "ingestion_timestamp", ["id"], "30 days")
        stream_silver(lake, once, spec, checkpoint).awaitTermination()

    for batch in batches:
        bronze(spark, *batch).coalesce(1).write.mode("append").parquet(folder)
        run()
    assert rows(lake.read("silver.job"), "id", "v") == [(1, "new"), (2, "b"), (3, "c")]
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()  # as if the driver had died after the write but before the commit
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    run()
    assert rows(lake.read("silver.job"), "id", "v") == [(1, "new"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("scope", ["business", "all"])
def test_staged_rows_have_no_digests_and_large_merges_end_like_small_ones(spark, tmp_path, monkeypatch, scope):
    staged, stage = [], Lake.stage
    monkeypatch.setattr(Lake, "stage", lambda self, name, df: staged.append((name, df.columns)) or stage(self, name, df))
    rules = [Rule("V", "Not x", "v <> 'x'", QUARANTINE)]
    options = SilverOptions(hash_scope=scope, load_ts=F.lit(at(9)))
    found = []
    for name, fits in (("small", None), ("large", False), ("parts", False)):
        if fits is not None:
            monkeypatch.setattr(lake_module, "fits_broadcast", lambda *a: False)
        own, chosen = Lake(spark, str(tmp_path / name)), SilverOptions(**{**options.__dict__, "part_column": "v" if name == "parts" else None})
        first = bronze(spark, (1, "a", at(1)), (2, "b", at(1)), (3, "x", at(1)), (None, "n", at(1)))
        silver_load(own, SPEC, "B1", source=first, rules=rules, options=chosen)
        counts = silver_load(own, SPEC, "B2", source=bronze(spark, (1, "a", at(2)), (2, "c", at(2)), (4, "d", at(2))), rules=rules, options=chosen).counts
        assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 1 if scope == "business" else 2)
        found.append(rows(own.read("silver.job")))
    assert found[0] == found[1] == found[2]
    assert staged and not any("record_hash" in columns for _, columns in staged)


def test_a_gold_load_does_not_write_its_rows_twice(spark, lake, monkeypatch):
    silver_load(lake, LoadSpec("S", "s", "SILVER", "b", "customer", "MERGE", ("customer_id",)), "B1",
                source=spark.createDataFrame([(1, "a"), (2, "b")], "customer_id bigint, name string"))
    staged, stage = [], Lake.stage
    monkeypatch.setattr(Lake, "stage", lambda self, name, df: staged.append(df.columns) or stage(self, name, df))
    spec = LoadSpec("G", "g", "GOLD", "customer", "gold.dim_customer", "MERGE", ("customer_key",))
    for batch in ("G1", "G2"):
        gold_load(lake, spec, batch)
    assert rows(lake.read("gold.dim_customer"), "customer_id", "name") == [(1, "a"), (2, "b")]
    assert not any("name" in columns for columns in staged)


def test_a_large_merge_stages_only_rows_it_writes(spark, lake, monkeypatch):
    staged, stage = {}, Lake.stage
    monkeypatch.setattr(Lake, "stage", lambda self, name, df: staged.setdefault(name, []).append(df.count()) or stage(self, name, df))
    monkeypatch.setattr(lake_module, "fits_broadcast", lambda *a: False)
    rules = [Rule("V", "Not x", "v <> 'x'", QUARANTINE)]
    silver_load(lake, SPEC, "B1", source=bronze(spark, (1, "a", at(1)), (2, "b", at(1)), (3, "c", at(1))), rules=rules)
    counts = silver_load(lake, SPEC, "B2", source=bronze(spark, (1, "a", at(2)), (2, "z", at(2)), (4, "d", at(2))), rules=rules).counts
    assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 1)
    assert staged["silver.job.decided"][0] == 2
    assert silver_load(lake, SPEC, "B3", source=bronze(spark, (1, "a", at(3))), rules=rules).counts["rows_written"] == 0
    assert rows(lake.read("silver.job"), "id", "v") == [(1, "a"), (2, "z"), (3, "c"), (4, "d")]
