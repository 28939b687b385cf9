"""Near-duplicates against brute force."""

import random

import numpy as np
import pytest

from strata.llm import minhash
from strata.llm.components import connected
from strata.llm.queries import QUERIES
from tests.llm import brute

SCHEMA = "doc_id long, text string, buckets string"


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert result(QUERIES["op7_circulant_minhash"](spark, folder)) == brute.near_duplicate_components(docs)


def test_chains_stars_copies_and_odd_rows(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    docs, doc_id = {}, 0
    for _ in range(60):  # a star: two edits each, so copies are mostly linked over the base only
        copy = list(base)
        for at in rng.sample(range(200), 2):
            copy[at] = f"x{rng.randrange(10**6)}"
        docs[doc_id] = " ".join(copy)
        doc_id += 1
    docs[doc_id] = " ".join(base)
    chain = list(base)[::-1]
    for i in range(12):  # a chain: each differs from the one before in one word
        chain[i * 12] = f"y{i}"
        docs[100 + i] = " ".join(chain)
    docs |= {200: "A  b\tC d e", 201: "a B c\nd E", 202: "one two", 203: "ONE two", 204: "one", 205: "", 206: None, 207: " \n"}
    docs |= {300 + i: "the same text of six words" for i in range(30)}
    rows = [(k, v, "clash") for k, v in docs.items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(minhash.near_duplicates(df)) == brute.near_duplicate_components(docs)
    kept = minhash.keep_one(df)
    assert kept.columns == ["doc_id", "text", "buckets"]
    want = {k for k, v in brute.near_duplicate_components(docs).items() if v[2]}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_empty_table_null_keys_and_repeated_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d e f", ""), (1, "a b c d e f", ""), (1, "a b c d e f", ""), (2, "a b c d e f", "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)
    ]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    one, two = np.unique(pool[:2000]), np.unique(pool[500:2500])
    signature = minhash.signatures([one, two], 2000)
    assert abs((signature[0] == signature[1]).mean() - 1500 / 2500) < 0.04


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_paths(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(900, 901), (901, 902), (902, 900)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected(edges).collect()}
    assert roots == {i: 0 for i in range(n + 1)} | {900: 900, 901: 900, 902: 900}


def test_a_key_at_two_texts_links_what_each_of_them_resembles(spark):
    a, b, c = ([f"{x}{i}" for i in range(100)] for x in "abc")
    edit = [*a[:50], "changed", *a[51:]]
    rows = [(1, b), (1, a), (5, edit), (7, [*b, "more"]), (9, c), (3, [*c, "more"]), (3, ["quite", "other"]), (4, ["quite", "other"])]
    df = spark.createDataFrame([(k, " ".join(w), "") for k, w in rows], SCHEMA).repartition(4)
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()}
    assert got == {
        (1, 96): (1, True), (5, 96): (1, False), (7, 97): (1, False),
        (9, 96): (3, False), (3, 97): (3, True), (3, 1): (3, True), (4, 1): (3, False),
    }
    assert sorted(r["doc_id"] for r in minhash.keep_one(df.withColumnRenamed("buckets", "_gone")).collect()) == [1, 1, 3, 3]
