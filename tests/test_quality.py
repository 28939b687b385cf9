import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.quality import (
    DROP_RECORD,
    FAIL_PIPELINE,
    QUARANTINE,
    WARN,
    Rule,
    classify,
    good_rows,
    reject_records,
    rejected_rows,
    rule_counts,
    rule_results,
)
from strata.sources.control import DATA_QUALITY_RESULT, REJECTED_RECORD
from tests.conftest import rows
from tests.test_operators import FEW


def counts(df, rules, **options):
    found = rule_counts(classify(df, rules, **options), rules, **options)
    return rows(found, "rule_id", "evaluated_row_count", "failed_row_count", "passed_row_count")


def test_a_row_goes_to_the_first_blocking_rule_it_fails(spark):
    df = spark.createDataFrame([(1, 1), (2, -1), (-1, -1), (-2, 2)], "a int, b int")
    rules = [Rule("A", "a positive", "a > 0", QUARANTINE), Rule("B", "b positive", "b > 0", DROP_RECORD)]
    classified = classify(df, rules)
    assert rows(good_rows(classified)) == [(1, 1, "PASSED", None)]
    assert rows(rejected_rows(classified, rules), "a", "b", "dq_error_message", "_failed_rule_id") == [
        (-1, -1, "A: a positive", "A"),
        (-2, 2, "A: a positive", "A"),
        (2, -1, "B: b positive", "B"),
    ]
    assert counts(df, rules) == [("A", 4, 2, 2), ("B", 2, 1, 1)]


def test_warnings_are_counted_and_keep_the_row(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    for action in (WARN, None, "NOTIFY"):
        rules = [Rule("W", "a positive", "a > 0", action)]
        assert good_rows(classify(df, rules)).count() == 3
        assert counts(df, rules) == [("W", 3, 1, 2)]


def test_unknown_predicates_follow_the_policy(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    rules = [Rule("A", "a positive", "a > 0", QUARANTINE)]
    assert rows(good_rows(classify(df, rules)), "a") == [(None,), (1,)]
    assert counts(df, rules) == [("A", 3, 1, 2)]
    assert rows(good_rows(classify(df, rules, "fail")), "a") == [(1,)]
    assert counts(df, rules, null_policy="fail") == [("A", 3, 2, 1)]
    with pytest.raises(ValueError):
        classify(df, rules, "ignore")


def test_rules_after_a_stop_are_not_reached(spark):
    df = spark.createDataFrame([(1,), (-1,)], "a int")
    rules = [
        Rule("A", "small", "a < 10", QUARANTINE),
        Rule("B", "positive", "a > 0", FAIL_PIPELINE),
        Rule("C", "odd", "a % 2 = 0", WARN),
    ]
    assert counts(df, rules) == [("A", 2, 0, 2), ("B", 2, 1, 1)]
    assert [r[0] for r in counts(df.filter("a > 0"), rules)] == ["A", "B", "C"]


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(good_rows(classify(df, []))) == [(1, "PASSED", None)]
    assert rejected_rows(classify(df, []), []).count() == 0
    empty = rule_counts(classify(df.limit(0), [Rule("A", "x", "a > 0")]), [Rule("A", "x", "a > 0")]).first()
    assert (empty["evaluated_row_count"], empty["failure_percentage"], empty["rule_status"]) == (0, 0.0, "PASSED")
    with pytest.raises(ValueError):
        rule_counts(classify(df, []), [])


def test_results_have_the_stored_shape(spark):
    df = spark.createDataFrame([(1,), (-1,), (-2,), (4,)], "a int")
    rules = [Rule("A", "positive", "a > 0", QUARANTINE, "RANGE", "LOW", 5.0)]
    out = rule_results(rule_counts(classify(df, rules), rules), audit_id="X", batch_id="B", pipeline_id="P")
    assert out.columns == DATA_QUALITY_RESULT.names
    row = out.first()
    assert (row["failure_percentage"], row["threshold_value"], row["rule_status"]) == (50.0, 5.0, "FAILED")


def test_rejects_have_the_stored_shape_and_keep_the_record(spark):
    df = spark.createDataFrame([(-1, None)], "a int, b string")
    rules = [Rule("A", "positive", "a > 0", DROP_RECORD)]
    rejected = rejected_rows(classify(df.withColumn("_work", F.lit(1)), rules), rules)
    out = reject_records(rejected, audit_id="X", batch_id="B", pipeline_id="P", source_object="s", target_object="t")
    assert out.columns == REJECTED_RECORD.names
    row = out.first()
    assert json.loads(row["source_record"]) == {"a": -1, "dq_status": "FAILED", "dq_error_message": "A: positive"}
    assert (row["rejection_reason"], row["failed_rule_ids"], row["severity"]) == ("A: positive", "A", "HIGH")


def test_column_predicates(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    rules = [Rule("A", "one", F.col("a") == 1, QUARANTINE)]
    assert rows(good_rows(classify(df, rules)), "a") == [(1,)]


@FEW
@given(
    data=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.integers(-3, 3))), max_size=12),
    actions=st.lists(st.sampled_from([WARN, QUARANTINE, DROP_RECORD]), min_size=3, max_size=3),
    policy=st.sampled_from(["pass", "fail"]),
)
def test_every_row_lands_on_one_side_and_counts_match_sequential_rules(spark, data, actions, policy):
    df = spark.createDataFrame(data, "a int, b int")
    tests = [("a > 0", lambda a, b: None if a is None else a > 0), ("b < 2", lambda a, b: None if b is None else b < 2), ("a + b <> 1", lambda a, b: None if None in (a, b) else a + b != 1)]
    rules = [Rule(f"R{i}", text, text, action) for i, ((text, _), action) in enumerate(zip(tests, actions))]
    classified = classify(df, rules, policy)
    assert good_rows(classified).count() + rejected_rows(classified, rules).count() == len(data)
    left, want = list(data), []
    for rule, (_, check) in zip(rules, tests):
        failed = [r for r in left if check(*r) is False or (policy == "fail" and check(*r) is None)]
        want.append((rule.rule_id, len(left), len(failed), len(left) - len(failed)))
        if rule.failure_action in quality.BLOCKING:
            left = [r for r in left if r not in failed]
    assert counts(df, rules, null_policy=policy) == want


def test_a_threshold_is_a_percentage_that_may_fail(spark):
    df = spark.range(100)
    for bound, status in ((9.9, "FAILED"), (10.0, "PASSED"), (None, "FAILED")):
        rule = Rule("R", "r", "id >= 10", quality.FAIL_PIPELINE, threshold_value=bound)
        after = Rule("S", "s", "id < 50", quality.WARN, threshold_value=60.0)
        counts = quality.rule_counts(quality.classify(df, [rule, after]), [rule, after], thresholds=True)
        assert [(r["rule_id"], r["rule_status"]) for r in counts.collect()] == [("R", status), ("S", "PASSED")][: 1 + (status == "PASSED")]
    none = quality.rule_counts(quality.classify(df.limit(0), [rule]), [rule], thresholds=True).first()
    assert (none["rule_status"], none["failure_percentage"]) == ("PASSED", 0.0)
