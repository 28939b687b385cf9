"""Repeated passages against brute force."""

import random
from collections import defaultdict

from strata.llm import suffix_dedup
from strata.llm.queries import QUERIES
from tests.llm import brute


def spans(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append((r["start"], r["n_words"]))
    return {d: sorted(v) for d, v in out.items()}


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op3_suffix_dedup"](spark, folder)
    twice, later = brute.repeated_spans(docs, 50)
    assert twice and spans(got.filter("kind = 'repeated'")) == twice
    assert spans(got.filter("kind = 'later'")) == later


def test_passages_of_all_lengths_and_odd_rows(spark):
    rng = random.Random(11)
    docs = {}
    shared = [f"s{i}" for i in range(120)]
    for d in range(60):
        text = [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 200))]
        for _ in range(rng.randrange(0, 3)):
            n, at, to = rng.randrange(45, 90), rng.randrange(0, 60), rng.randrange(0, len(text))
            text[to:to] = shared[at : at + n]
        docs[d] = rng.choice([" ", "\n "]).join(text)
    docs[100] = docs[101] = "Ä b  " * 100  # a text that repeats itself
    docs |= {102: None, 103: "", 104: "a b", 105: " ".join(shared[:50]), 106: " ".join(shared[:49])}
    rows = [(k, v, "x") for k, v in docs.items()] + [(None, docs[100], "x"), (100, docs[100], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(7)
    twice, later = suffix_dedup.repeated_passages(df)
    want = brute.repeated_spans({k: v for k, v in docs.items()}, 50)
    assert (spans(twice), spans(later)) == want
    cut = suffix_dedup.without_repeats(df)
    assert cut.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in cut.collect()]
    assert len(got) == len(rows)
    for d, text in got:
        if d not in want[1]:
            assert text == docs.get(100 if d is None else d)
            continue
        left = [w for i, w in enumerate(brute.words(docs[d])) if not any(a <= i < a + n for a, n in want[1][d])]
        assert brute.words(text) == left


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    twice, later = suffix_dedup.repeated_passages(df)
    assert twice.count() == later.count() == suffix_dedup.without_repeats(df).count() == 0


def test_every_passage_keeps_one_shared_minimiser():
    import numpy as np

    rng = np.random.default_rng(1)
    passage = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    kept = []
    for _ in range(40):
        text = np.concatenate(
            [rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64), passage, rng.integers(0, 1 << 63, 9, dtype=np.uint64)]
        )
        start = np.flatnonzero(text == passage[0])[0]
        places, first, last = suffix_dedup._owned_starts(text, 50)
        owner = [p for p, a, b in zip(places, first, last) if a <= start <= b]
        assert len(owner) == 1
        kept.append(owner[0] - start)
    assert len(set(kept)) == 1
