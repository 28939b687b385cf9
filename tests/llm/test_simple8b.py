"""Simple-8b: exact round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import simple8b
from strata.llm.queries import QUERIES
from tests.llm.test_packing import WORD_BPE, ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 1) | st.integers(0, 70000), max_size=2600))
def test_values_come_back(values):
    array = np.array(values, np.uint64)
    words, offsets = simple8b.encode(array)
    assert (simple8b.decode(words, offsets, len(array)) == array).all()


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_small_values_take_few_words_and_blocks_decode_alone(n):
    values = np.arange(n, dtype=np.uint64) % np.uint64(2)
    words, offsets = simple8b.encode(values)
    assert len(words) == sum(-(-min(1024, n - b) // 60) for b in range(0, n, 1024))
    for b, at in enumerate(offsets):
        size = min(1024, n - 1024 * b)
        alone = simple8b.decode(words[at:], np.zeros(1, np.int64), size)
        assert (alone == values[1024 * b : 1024 * b + size]).all()


def wanted(docs):
    out, start = {}, 0
    for d in sorted(docs):
        found = np.array([*ids(WORD_BPE, docs[d]), 2], "<u4")
        out[d] = (start, len(found), zlib.crc32(found.tobytes()))
        start += len(found)
    return out


def test_query_gives_the_ids_of_whole_texts(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_simple8b"](spark, folder).collect()}
    assert got == wanted(docs)


def test_odd_rows_and_many_chunks(spark, monkeypatch):
    docs = {i: f"Text {i} <|endoftext|> Ünï" * (i % 7) for i in range(-20, 60)} | {70: None, 71: "", 72: "word " * 30000}
    df = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id long, text string, start int")
    got = {r["doc_id"]: tuple(r)[1:] for r in simple8b.round_trip(df.repartition(5), WORD_BPE).collect()}
    assert got == wanted(docs)
    assert simple8b.round_trip(df.limit(0), WORD_BPE).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (None, None)], "doc_id long, text string")
    rows = sorted(((r["start"], r["doc_id"], r["n_tokens"]) for r in simple8b.round_trip(odd, WORD_BPE).collect()))
    assert [r[1] for r in rows] == [None, None, 1, 1] and sorted(r[2] for r in rows[:2]) == [1, 2]
    assert [r[0] for r in rows] == [0, rows[0][2], 3, 5]
