"""Rules decided by another table: direct, and inside a silver load."""

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from strata.operators import quality, references
from strata.operators.quality import Rule
from strata.operators.references import missing_values, resolve_references
from strata.plans.loads import REJECT_LOG, RESULT_LOG, silver_load
from strata.sources import control
from strata.sources.control import LoadSpec


def refers(rule_id, columns, table, theirs, action=quality.QUARANTINE):
    return Rule(rule_id, rule_id, None, action, column_name=columns, reference_object=table, reference_column=theirs)


@pytest.fixture
def tables(spark):
    return {
        "colour": spark.createDataFrame([("red",), ("red",), ("blue",), (None,)], "name string"),
        "number": spark.createDataFrame([("1",), ("2",), ("x",)], "n string"),
        "pair": spark.createDataFrame([("red", 1), ("blue", 2)], "c string, n int"),
        "empty": spark.createDataFrame([], "n int"),
    }


LINES = [(1, "red", 1), (2, "green", 1), (3, None, 2), (4, "blue", 9), (5, "red", None), (6, "red", 2)]


def judged(spark, tables, rules, policy="pass"):
    df = spark.createDataFrame(LINES, "id int, colour string, n int").repartition(3)
    flagged, rules = resolve_references(df, rules, tables.__getitem__, lambda f: f)
    return quality.classify(flagged, rules, policy), rules


@pytest.mark.parametrize("broadcast", [True, False])
def test_first_failing_rule_counts_among_all_rules(spark, tables, monkeypatch, broadcast):
    monkeypatch.setattr(references, "fits_broadcast", lambda df: broadcast)
    rules = [Rule("small", "small", "id < 6", quality.DROP_RECORD), refers("c", "colour", "colour", "name"), refers("n", "n", "number", "n")]
    classified, rules = judged(spark, tables, rules)
    bad = quality.rejected_rows(classified, rules)
    assert rows(bad, "id", "_failed_rule_id") == [(2, "c"), (4, "n"), (6, "small")]
    assert rows(quality.good_rows(classified), "id") == [(1,), (3,), (5,)]
    assert not [c for c in bad.columns + quality.good_rows(classified).columns if c.startswith(quality.ORPHAN)]
    counts = quality.rule_counts(classified, rules)
    assert rows(counts, "rule_id", "evaluated_row_count", "failed_row_count") == [("c", 5, 1), ("n", 4, 1), ("small", 6, 1)]


def test_unknown_values_follow_the_null_policy(spark, tables):
    rules = [refers("c", "colour", "colour", "name"), refers("n", "n", "number", "n")]
    classified, rules = judged(spark, tables, rules, "fail")
    assert rows(quality.rejected_rows(classified, rules), "id", "_failed_rule_id") == [(2, "c"), (3, "c"), (4, "n"), (5, "n")]


def test_columns_are_looked_up_together(spark, tables):
    classified, rules = judged(spark, tables, [refers("p", "COLOUR, n", "pair", "c, n")])
    assert rows(quality.rejected_rows(classified, rules), "id") == [(2,), (4,), (6,)]


def test_warnings_only_count_and_an_empty_reference_holds_nothing(spark, tables):
    classified, rules = judged(spark, tables, [refers("w", "n", "empty", "n", quality.WARN)])
    assert quality.good_rows(classified).count() == len(LINES)
    assert rows(quality.rule_counts(classified, rules), "failed_row_count") == [(5,)]


def test_no_rows_and_wrong_columns(spark, tables):
    none = spark.createDataFrame([], "id int, colour string, n int")
    flagged, rules = resolve_references(none, [refers("c", "colour", "colour", "name")], tables.__getitem__, lambda f: f)
    assert quality.classify(flagged, rules).count() == 0
    with pytest.raises(ValueError, match="refer"):
        missing_values(none, ["id"], tables["pair"], ["c", "n"])
    with pytest.raises(ValueError):
        missing_values(none, ["nothing"], tables["pair"], ["c"])
    with pytest.raises(ValueError, match="not looked up"):
        quality.classify(none, [refers("c", "colour", "colour", "name")]).count()


def test_rows_are_not_shuffled_past_few_missing_values(spark, tables):
    df = spark.range(1000).withColumn("n", (F.col("id") % 5).cast("int"))
    flagged, rules = resolve_references(df, [refers("n", "n", "number", "n")], tables.__getitem__, lambda f: f)
    plan = quality.classify(flagged, rules)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan


def test_a_silver_load_judges_references(spark, lake):
    lake.overwrite("silver.dealer", spark.createDataFrame([(1,), (2,)], "dealer_id bigint"), "B0")
    source = spark.createDataFrame([(1, 1, "a"), (2, 3, "b"), (3, None, "c"), (3, 2, "d")], "service_order_id bigint, dealer_id bigint, remark string")
    spec = LoadSpec("PL", "orders", "SILVER", "bronze.orders", "silver.orders", control.MERGE, ("service_order_id",))
    stored = spark.createDataFrame(
        [("R1", "PL", "Dealer known", None, "REFERENTIAL", "dealer_id", None, "silver.dealer", "dealer_id", "HIGH", "QUARANTINE", 0.0, True)],
        "rule_id string, pipeline_id string, rule_name string, rule_description string, rule_type string, column_name string, "
        "rule_expression string, reference_object string, reference_column string, severity string, failure_action string, "
        "threshold_value double, is_active boolean",
    )
    result = silver_load(lake, spec, "B1", source=source, rules=control.active_rules(stored, "PL"))
    assert (result.counts["rows_rejected"], result.counts["rows_quarantined"], result.counts["rows_duplicated"]) == (1, 1, 1)
    assert rows(lake.read("silver.orders"), "service_order_id") == [(1,), (3,)]
    assert not [c for c in lake.read("silver.orders").columns if c.startswith("_")]
    reject = lake.log(REJECT_LOG, control.REJECTED_RECORD).first()
    assert reject["failed_rule_ids"] == "R1" and '"service_order_id":2' in reject["source_record"]
    assert rows(lake.log(RESULT_LOG, control.DATA_QUALITY_RESULT), "rule_id", "evaluated_row_count", "failed_row_count") == [("R1", 3, 1)]
