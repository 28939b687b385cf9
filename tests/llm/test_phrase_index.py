"""The positional index against SQL and brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import phrase_index
from tests.llm import oracle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, tests, size=13):
    windows = {}
    for item, text in tests.items():
        w = words(text)
        for s in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + size]), set()).add(item)
    out = {}
    for d, text in docs.items():
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    hit.update(range(s, s + n))
                    items |= found
        ids = ",".join(sorted(map(str, items)))
        out[d] = (len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def frames(spark, docs, tests):
    return (
        spark.createDataFrame([(k, v, "x") for k, v in docs.items()], "doc_id long, text string, term string").repartition(3),
        spark.createDataFrame([(k, v, 1) for k, v in tests.items()], "item_id long, text string, at int"),
    )


def test_query_equals_its_sql(spark):
    assert oracle.difference(spark, "/root/testdata/sf0.001", "op6_phrase_index") is None


def test_short_items_overlaps_case_and_odd_rows(spark):
    rng = random.Random(2)
    tests = {i: " ".join(f"t{rng.randrange(40)}" for _ in range(rng.randrange(1, 30))) for i in range(25)}
    tests |= {50: "Éa ÉCOLE d'Été", 51: None, 52: "", 53: "...", 54: "the the the", 55: "solo"}
    tests[56] = tests[3]
    docs = {}
    for d in range(80):
        text = [rng.choice(["the", "of", f"t{rng.randrange(40)}"]) for _ in range(rng.randrange(0, 120))]
        for item in rng.sample(sorted(tests), rng.randrange(0, 3)):
            text.append((tests[item] or "").upper() if item < 50 else tests[item] or "")
        docs[d] = ", ".join(text)
    docs |= {200: None, 201: "", 202: "!!", 203: " the THE the the ", 204: "Éa ÉCOLE d'été Éa ÉCOLE d'Été", 205: "x" * 90000 + " solo"}
    got = phrase_index.contamination(*frames(spark, docs, tests)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(docs, tests)


def test_empty_tables_null_ids_repeated_rows(spark):
    docs, tests = frames(spark, {1: "a b"}, {1: "a b"})
    assert phrase_index.contamination(docs.limit(0), tests).count() == 0
    (row,) = phrase_index.contamination(docs, tests.limit(0)).collect()
    assert tuple(row)[1:4] == (2, 0, 0) and not row["contaminated"]
    odd = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    got = phrase_index.contamination(odd, tests.unionByName(tests.withColumn("item_id", F.lit(None).cast("long"))))
    assert sorted((r["doc_id"] or 0, r["n_hit"], r["n_items"]) for r in got.collect()) == [(0, 0, 0), (1, 2, 1), (1, 2, 1)]
    assert phrase_index.without_contaminated(docs, tests).count() == 0


def test_texts_of_one_key_are_not_read_as_one(spark):
    words = [f"w{i}" for i in range(13)]
    rows = [(1, " ".join(words[:7])), (1, "x " * 7 + " ".join(words[7:])), (1, "w1 w2 w3"), (2, " ".join(words)), (2, "clean text")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, k int, _gone int").repartition(3)
    tests = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in phrase_index.contamination(docs, tests).collect())
    assert got == [(1, 3, 0, False), (1, 7, 0, False), (1, 13, 0, False), (2, 2, 0, False), (2, 13, 13, True)]
    assert sorted(r["doc_id"] for r in phrase_index.without_contaminated(docs, tests).collect()) == [1, 1, 1]


def test_proximity_lets_words_move(spark):
    docs = {1: "p alpha q beta gamma r", 2: "alpha beta gamma", 3: "alpha x x x x x beta gamma"}
    docs, tests = frames(spark, docs, {7: "alpha beta gamma"})
    index = phrase_index.build_index(docs.toDF("k", "t", "x"), tests.toDF("k", "t", "x"))
    near = lambda slop: {r["k"] for r in phrase_index.proximity_matches(index, slop).collect()}
    assert near(0) == {2} and near(1) == {1, 2} and near(5) == {1, 2, 3}


def test_no_python_in_the_plan(spark):
    docs, tests = frames(spark, {1: "a b"}, {1: "a b"})
    plan = phrase_index.contamination(docs, tests)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
