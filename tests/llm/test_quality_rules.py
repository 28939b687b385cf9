"""Quality rules: counts, growing, pruning and the order of the list against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality_rules as qr
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base(text):
    words = re.findall("[^ \t-\r]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    n, r = len(words), len(repeated)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def shown(df):
    return sorted(tuple(r) for r in df.select(F.coalesce("doc_id", F.lit(-1)), *BASE).collect())


def test_query_counts_equal_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = QUERIES["op10_quality_rules"](spark, FOLDER)
    assert shown(found) == sorted((d, *base(t)) for d, t in docs.items())
    assert all(r["kept"] == (not r["base_failed"] and r["rule"] is None) for r in found.collect())


ODD = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, "a b c a b c a b"), (5, "x\nx\n\nx\ny\n y"), (6, "a # b *$ %% &|<>"), (7, "é É ß 日本  x"),
    (8, "w " * 60), (9, " ".join(f"w{i}" for i in range(49))), (10, " ".join(f"w{i}" for i in range(50))), (11, "word " * 20_000 + "end"),
    (None, "a a a a"), (12, "same"), (12, "same"), (12, "other words"), (13, "a\rb\x0bc\x0cd"),
]


def test_odd_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in ODD], "doc_id long, text string, k int, w int, lines string").repartition(3)
    want = sorted((-1 if d is None else d, *base(t)) for d, t in ODD)
    assert shown(qr.apply_rules(df, [])) == want
    kept = qr.keep_good(df, [])
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [10]
    assert qr.apply_rules(df.limit(0), []).count() == 0 and qr.keep_good(df.limit(0), []).count() == 0


def test_the_list_is_one_ordered_conditional(spark):
    cut = lambda f, above, t: qr.Condition(f, above, t)
    rules = [
        qr.Rule((cut("n_words", True, 60.0), cut("symbols_per_word", True, 0.1))),
        qr.Rule((cut("mean_word_chars", False, 3.0),)),
        qr.Rule((cut("n_words", True, 50.0),)),
    ]
    texts = {1: "ab# " * 70, 2: "abcdef " * 51, 3: "ab cd " * 40, 4: "abcdef " * 50}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in qr.apply_rules(df, rules).collect()}
    x = {d: np.array([[float(r[f]) for f in qr.FEATURES]]) for d, r in got.items()}
    for d, r in got.items():
        want = next((i for i, rule in enumerate(rules, 1) if rule.holds(x[d])[0]), None)
        assert r["rule"] == want and r["kept"] == (not r["base_failed"] and want is None)
    assert [got[d]["rule"] for d in (1, 2, 3, 4)] == [1, 3, 2, None]


def gain(p0, n0, p, n):
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def test_each_grown_condition_has_the_highest_gain():
    rng = np.random.default_rng(4)
    how = qr.Learning(steps=7, longest=3)
    for trial in range(12):
        x = rng.integers(0, 6, (60, len(qr.FEATURES))).astype(float)
        bad = (x[:, 1] > 3) & (x[:, 4] <= 2) | (rng.random(60) < 0.1)
        rule, live = qr._grow(x, bad, how), np.ones(60, bool)
        for condition in rule.conditions:
            p0, n0 = int(bad[live].sum()), int((~bad[live]).sum())
            best = max(
                gain(p0, n0, int(bad[live & c.holds(x)].sum()), int((~bad[live & c.holds(x)]).sum()))
                for j, f in enumerate(qr.FEATURES)
                for t in np.unique(np.quantile(x[live, j], np.linspace(0, 1, how.steps + 2)[1:-1], method="lower"))
                for c in (qr.Condition(f, True, float(t)), qr.Condition(f, False, float(t)))
            )
            met = live & condition.holds(x)
            assert gain(p0, n0, int(bad[met].sum()), int((~bad[met]).sum())) == pytest.approx(best)
            live = met
        assert len(rule.conditions) <= how.longest


def test_pruning_keeps_the_prefix_that_separates_best():
    rng = np.random.default_rng(5)
    conditions = tuple(qr.Condition(f, True, 2.0) for f in qr.FEATURES[:4])
    for _ in range(20):
        x, bad = rng.integers(0, 6, (40, len(qr.FEATURES))).astype(float), rng.random(40) < 0.5

        def worth(k):
            met = np.all(x[:, :k] > 2.0, axis=1)
            p, n = bad[met].sum(), (~bad[met]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        kept = len(qr._prune(qr.Rule(conditions), x, bad).conditions)
        assert worth(kept) == max(map(worth, range(1, 5)))
        assert all(worth(k) < worth(kept) for k in range(kept + 1, 5))


def test_rules_cover_what_earlier_ones_leave_and_learning_repeats(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("at", "on", "ing", "er")]
    rows, labels = [], []
    for d in range(600):
        kind = d % 3
        text = [rng.choice(words) for _ in range(rng.randrange(60, 120))]
        if kind == 1:
            text = [w + "#" for w in text]
        rows.append((d, ("\n" if kind == 2 and d % 2 else " ").join(text)))
        labels.append((d, 0 if kind == 1 or (kind == 2 and d % 2) else 1))
    labels += [(None, 0), (3, None), (5, 9), (10_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rules = qr.learn_rules(docs, known)
    assert rules == qr.learn_rules(docs.repartition(2), known.repartition(3)) and len(rules) >= 2
    got = {r["doc_id"]: r["kept"] for r in qr.apply_rules(docs, rules).collect()}
    right = sum(got[d] == bool(y) for d, y in labels[:600])
    assert right >= 0.98 * 600
    for some in (known.limit(0), known.filter("quality = 0"), known.filter("quality = 1")):
        assert qr.learn_rules(docs, some) == []
    assert qr.learn_rules(docs.limit(0), known) == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    rule = qr.Rule((qr.Condition("n_words", True, 1.0),))
    for found in (qr.apply_rules(df, [rule]), qr.keep_good(df, [rule])):
        assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
