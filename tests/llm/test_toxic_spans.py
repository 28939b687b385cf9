"""The random field against sums over all labellings, a difference quotient and held-out labels."""

import itertools
import random
import zlib

import numpy as np
import pytest

from strata.llm import toxic_spans as ts
from strata.llm.queries import QUERIES


def all_labellings(score, pairs):
    """Marginals and expected pairs of one chain by summing over every labelling."""
    n = len(score)
    total, toxic, both = 0.0, np.zeros(n), np.zeros(4)
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(s for s, v in zip(score, y) if v) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
        total += w
        toxic += w * np.array(y)
        for a, b in zip(y, y[1:]):
            both[2 * a + b] += w
    return toxic / total, both / total


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_marginals_equal_sums_over_all_labellings(block, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK", block)
    rng = np.random.default_rng(block)
    sizes = [1, 7, 2, 1, 9, 4, 3]
    score = rng.normal(0, 3, sum(sizes))
    pairs = rng.normal(0, 2, (2, 2))
    begins = np.zeros(len(score), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    got = ts.marginals(score, begins, -0.5, pairs)
    want = np.concatenate([all_labellings(c - 0.5, pairs)[0] for c in np.split(score, np.cumsum(sizes)[:-1])])
    assert np.allclose(got, want, atol=1e-9)
    assert len(ts.marginals(np.zeros(0), np.zeros(0, bool), 0.0, pairs)) == 0


def test_long_chains_stay_finite():
    score = np.concatenate([np.full(50_000, -40.0), [25.0], np.full(50_000, -40.0)])
    begins = np.zeros(len(score), bool)
    begins[0] = True
    got = ts.marginals(score, begins, 0.0, np.array([[1.0, -2.0], [-2.0, 1.0]]))
    assert np.isfinite(got).all() and got.argmax() == 50_000 and got[50_000] > 0.99


def test_short_chains_equal_sums_over_all_labellings():
    rng = np.random.default_rng(3)
    score, pairs = rng.normal(0, 2, (5, 6)), rng.normal(0, 1, (2, 2))
    mask = np.zeros((5, 6))
    for i, n in enumerate((6, 1, 3, 5, 2)):
        mask[i, :n] = 1
    got, both = ts._chain_marginals(score, pairs, mask)
    want = [all_labellings(score[i, : int(mask[i].sum())], pairs) for i in range(5)]
    for i, (marginal, _) in enumerate(want):
        assert np.allclose(got[i, : len(marginal)], marginal)
    assert np.allclose(both, sum(b for _, b in want))


WORDS = "the of a cat dog house tree walks runs sees green blue old new river stone".split()


def corpus(n, seed, bad=("zorkel", "zorkeling", "zorkelst", "blighter")):
    """Texts of which a third holds one to three offending words; with labels and their places."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.33
        if toxic:
            for i in rng.sample(range(len(words)), rng.randint(1, 3)):
                words[i] = rng.choice(bad).upper() if rng.random() < 0.2 else rng.choice(bad)
        out.append((" ".join(words) + ".", int(toxic), {i for i, w in enumerate(words) if w.lower() in bad}))
    return out


def test_fitted_field_finds_the_planted_words():
    train, held = corpus(400, 1), corpus(200, 2, ("zorkelment", "zorkel", "blighter"))
    model = ts.fit([t for t, _, _ in train], [y for _, y, _ in train])
    score, spans = ts.Scorer(model).score([t for t, _, _ in held])
    assert [int(s >= 0.5) for s in score] == [y for _, y, _ in held]
    for (text, _, bad), found in zip(held, spans):
        words = text.rstrip(".").split()
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        covered = {i for i in range(len(words)) for a, b, _ in found if a <= starts[i] and starts[i] + len(words[i]) <= b}
        assert covered == bad


def test_copies_and_single_long_texts_are_no_evidence():
    clean = [(t, 0) for t, y, _ in corpus(300, 5) if not y]
    copies = [("a strange gnarfle stood by the river", 1)] * 40 + [("xyzzy " + " xyzzy ".join(WORDS * 20), 1)]
    sample = ts._Sample([t for t, _ in clean + copies], [y for _, y in clean + copies])
    assert not sample.tokens().any()
    model = ts.fit([t for t, _ in clean + copies], [y for _, y in clean + copies])
    assert ts.Scorer(model).score(["gnarfle", None])[0].tolist() == [0.0, 0.0]


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op11_crf_toxicity"](spark, folder).collect()}
    assert got.keys() == {r[0] for r in docs.select("doc_id").collect()}
    held = [(labels[d], r["predicted"]) for d, r in got.items() if d in labels and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    hit = sum(y and p for y, p in held)
    assert hit >= 0.8 * sum(y for y, _ in held) and sum(p and not y for y, p in held) <= 0.005 * len(held)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, r in got.items():
        for s in r["spans"]:
            assert ts._WORD.match(texts[d].lower()[s["start"] : s["stop"]]), (d, s)


def test_odd_rows(spark):
    train = corpus(400, 7)
    rows = [(i, t) for i, (t, _, _) in enumerate(train)]
    odd = [(1000, None), (1001, ""), (1002, "12 !? ..."), (1003, "the dog " * 40_000 + "zorkel"), (1003, "the dog"), (None, "zorkel"),
           (1004, "İİİ zorkel"), (1005, "zorkel"), (1005, "zorkel")]
    labels = [(i, y) for i, (_, y, _) in enumerate(train)] + [(0, None), (None, 1), (1, 7), (99_999, 1), (2, 1), (2, 0)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + odd], "doc_id long, text string, k int, t int, toxic int").repartition(3)
    known = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, toxic int, k int")
    got = ts.toxicity(docs, known).collect()
    assert len(got) == len(rows) + len(odd)
    at = {}
    for r in got:
        at.setdefault(r["doc_id"], []).append(r)
    none = [at[i][0]["score"] for i in (1000, 1001, 1002)]
    assert none[0] == none[1] == none[2] < 0.5 and not any(at[i][0]["spans"] for i in (1000, 1001, 1002))
    assert sorted(r["predicted"] for r in at[1003]) == [0, 1] and [r["predicted"] for r in at[1005]] == [1, 1]
    assert at[None][0]["held_out"] and at[None][0]["predicted"] == 1
    span = at[1004][0]["spans"][0]
    assert (span["start"], span["stop"]) == (4, 10)
    for some in (known.limit(0), known.filter("toxic = 0"), known.filter("toxic = 1")):
        assert {r["score"] for r in ts.toxicity(docs, some).collect()} == {0.0}
    assert ts.toxicity(docs.limit(0), known).count() == 0
