"""Packing and tokenizing: exact round trips."""

import functools
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import packing
from strata.llm.common import tokenizer_file
from strata.llm.queries import QUERIES
from strata.llm.tokens import WordMemo

BYTE_BPE, WORD_BPE = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
ODD = [
    "", " ", "  a", "a  b", "a \n b", "\n\nx y\t z ", "it's we'll 'S 's x", "naïve Über ΑΣ ΑΣ Ω", "a᠎ b ᠎c",
    "<|endoftext|> <|startoftext|>a", "b <|endoftext|> c<|endoftext|>d <|ENDOFTEXT|>", "<|endoftext|>", "X <|EndOfText|> Y", "x\x1cy \x85 z", "1234 5,6.7 €", "é e ́a", "日本語 テキスト", "a" * 3000, " 　 b", "﻿a b",
]


@functools.cache
def whole(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids(path, text):
    return whole(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path, space", [(BYTE_BPE, "leads"), (WORD_BPE, "dropped")])
def test_memo_gives_the_ids_of_whole_texts(path, space, monkeypatch):
    from strata.llm import tokens

    monkeypatch.setattr(tokens, "MEMO_WORDS", 20)
    rng = random.Random(4)
    bits = ["a", "b'", "'s", " ", "  ", "\n", "\t", "é", "Don't", "x ", "12", "!?", "\r\n", " ", "ab cd"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(400)] + [None]
    got = WordMemo(path, space).encode(texts, group=7)
    for text, found in zip(texts, got):
        assert np.frombuffer(found, "<u4").tolist() == ids(path, text), repr(text)


@pytest.mark.parametrize("path, space", [(BYTE_BPE, "leads"), (WORD_BPE, "dropped")])
@pytest.mark.parametrize("block, near", [(2_000_000, 200), (30, 0)])
def test_pieces_cut_by_hand_give_the_ids_of_whole_texts(path, space, block, near, monkeypatch):
    from strata.llm import tokens

    monkeypatch.setattr(tokens, "BLOCK", block)
    monkeypatch.setattr(tokens, "NEAR", near)
    rng = random.Random(9)
    every = [chr(c) for c in range(256)]
    texts = [a + c + b for a in ("a", " ", "'", "") for c in every for b in ("a", " x", "'s", "\n", "")]
    bits = list(" '  \n\ts\xa0\x85tredmlvLE1².|") + ["the ", "it's", " 'x ", "\0", "’", "Σ", "́", "<|endoftext|>"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(50))) for _ in range(1000)]
    found = WordMemo(path, space).encode(texts)
    for text, got, want in zip(texts, found, whole(path).encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, repr(text)


@pytest.mark.parametrize("path, space", [(BYTE_BPE, "leads"), (WORD_BPE, "dropped")])
def test_the_library_meets_each_piece_once_whatever_stands_beside_it(path, space, monkeypatch):
    import tokenizers

    class Counting:
        met = 0

        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        @classmethod
        def from_file(cls, path):
            return cls(whole(path))

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch(self, texts, **more):
            Counting.met += sum(map(len, texts))
            return self.tokenizer.encode_batch(texts, **more)

        def encode_batch_fast(self, texts, **more):
            Counting.met += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **more)

    words = ["".join(p) for p in itertools.product("abcde", repeat=4)]
    marks = [".", ",", "!?", "...", "\n", " (", ") ", "|"]
    texts = [(m + " ").join(words) for m in marks]
    texts.append(" ".join([*words, "is “odd” here", *words]))
    wanted = [ids(path, t) for t in texts]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    found = WordMemo(path, space).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == wanted
    assert Counting.met < 2.5 * sum(len(w) + 1 for w in words)  # 8 times, if marks made other words


def held(rows, docs, capacity):
    """Checks that the pieces are the documents' ids and lie gapless in sequences; their number."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, text in docs.items():
        want = np.array([*ids(BYTE_BPE, text), 2], "<u4")
        found = sorted(by_doc.pop(d), key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        assert [r["length"] for r in found] == packing.cut_lengths(len(want), capacity)
        start = 0
        for r in found:
            assert r["start"] == start
            assert r["ids_crc32"] == zlib.crc32(want[start : start + r["length"]].tobytes())
            start += r["length"]
    assert not by_doc
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), sum(r["length"] for r in rows)


def test_query_packs_whole_documents_tightly(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n, total = held(QUERIES["op9_residual_packing"](spark, folder).collect(), docs, 1024)
    assert n <= 1.05 * total / 1024 + 1


def test_levels_merge_underfull_bins(spark):
    rng = random.Random(8)
    docs = {d: " ".join(["word"] * rng.randrange(0, 90)) for d in range(800)} | {900: None, 901: ""}
    df = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id long, text string, bin int").repartition(70)
    rows = packing.pack(df, BYTE_BPE, capacity=64).collect()
    n, total = held(rows, docs, 64)
    assert n <= 1.01 * total / 64 + 1


def test_null_and_repeated_keys_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), BYTE_BPE).count() == 0
    rows = packing.pack(spark.createDataFrame([(None, "a"), (None, None), (1, "b"), (1, "b")], schema), BYTE_BPE).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (0, 2), (1, 2), (1, 2)]
    assert len({r["sequence_id"] for r in rows}) == 1


def bins_one_by_one(loads, capacity):
    """Best fit, an item at a time: the loads of the bins."""
    bins = []
    for size in sorted(loads, reverse=True):
        at = max((i for i, load in enumerate(bins) if load + size <= capacity), key=bins.__getitem__, default=None)
        if at is None:
            bins.append(size)
        else:
            bins[at] += size
    return sorted(bins)


def test_best_fit_on_counts_is_that_of_the_items():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.randrange(4, 60)
        loads = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 150))]
        counts = {size: loads.count(size) for size in set(loads)}
        runs = packing.best_fit(counts, capacity)
        assert sorted(load for n, load, _ in runs for _ in range(n)) == bins_one_by_one(loads, capacity)
        ranks = defaultdict(list)
        for n, load, held in runs:
            assert load == sum(size * each for size, _, each, _ in held)
            for size, first, each, _ in held:
                ranks[size] += range(first, first + n * each)
        assert {size: sorted(found) for size, found in ranks.items()} == {size: list(range(n)) for size, n in counts.items()}


def test_hot_lengths_of_tasks_all_meet(spark):
    """12,000 underfull bins of one task, and 12,000 pieces of another that fill them."""
    df = spark.range(0, 24_000, 1, 2).selectExpr("id doc_id", "IF(id < 12000, 'word word word word', 'word word') text")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    n, total = held(packing.pack(df, BYTE_BPE, capacity=8).collect(), docs, 8)
    assert total == 8 * 12_000 and n == 12_000
