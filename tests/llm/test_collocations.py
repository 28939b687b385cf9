"""Collocations against SQL over the whole table and against brute force on odd rows."""

import re
from collections import Counter

import pytest

from strata.llm import collocations as co
from tests.llm.oracle import difference

SCHEMA = "text string, lang string, h1 int, n int, kind int"


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, folder):
    assert difference(spark, f"/root/testdata/{folder}", "op12_debruijn_collocations") is None


def pieces(rows):
    low = {c: c + 32 for c in range(65, 91)}
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            yield lang or "und" if lang is not None else "und", [w for w in re.split("[ \t]+", piece) if w]


def counts(rows):
    f, n = Counter(), Counter()
    for lang, w in pieces(rows):
        n[lang] += len(w)
        f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, min_count, cover=50, top=2000):
    f, n = counts(rows)
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < min_count:
            continue
        longer = [c for (la, q), c in f.items() if la == lang and len(p) < len(q) and c >= min_count and p in (q[:2], q[1:])]
        if any(100 * c >= cover * a for c in longer):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), " ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i, phrase, -a, le, ri, n[lang], -s)
        for lang, ps in found.items()
        for i, (s, a, _, phrase, le, ri) in enumerate(sorted(ps)[:top], 1)
    }


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


def found(df, **more):
    return {tuple(r) for r in co.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


ODD = [
    (None, "en"), ("", "en"), ("...", "en"), ("solo", None), ("a b", None), ("A b,a B", "und"), ("x\ty  z q é É", "en"),
    ("one two three four five six", "en"), ("one two three four five six", "en"), ("zero one two three four five six seven", "en"),
    ("round and round and round and", "en"), ("a a a a a a a a", "de"), ("a b a b a b a b a b", "de"), ("日本 語 日本 語", "ja"),
    ("end one\ntwo three. four", "en"), ("the cat " * 3000, "fr"),
]


@pytest.mark.parametrize("min_count,cover", [(1, 50), (2, 50), (3, 100), (2, 10)])
def test_odd_rows_equal_brute_force(spark, min_count, cover):
    assert found(frame(spark, ODD), min_count=min_count, cover_percent=cover) == brute(ODD, min_count, cover)


def test_small_batches_and_partitions_equal_brute_force(spark, monkeypatch):
    words = "the of cat dog sat on mat ran".split()
    rows = [(" ".join(words[(i * j + j // 3) % 8] for j in range(i % 17)) + "." + "b c d e f " * (i % 3), "ab"[i % 2]) for i in range(90)]
    monkeypatch.setattr(co, "FLUSH_WORDS", 20)
    monkeypatch.setattr(co, "MERGE_ROWS", 7)
    monkeypatch.setattr(co, "OUT_ROWS", 5)
    assert found(frame(spark, rows, 4), min_count=3) == brute(rows, 3)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_runs_of_sorted_grams_are_summed_across_batches(size, monkeypatch):
    """The one pass over sorted grams gives each gram's and node's whole sum, wherever batches end."""
    import pyarrow as pa

    monkeypatch.setattr(co, "MERGE_ROWS", size)
    rows = [(1 + i % 3, (i // 3) % 4, (i // 5) % 3 if (i // 3) % 4 else 0, i % 4) for i in range(200)]
    rows = sorted((a, b, c, n) for a, b, c, n in rows)
    data = [{"h1": a, "h2": b, "h3": c, "n": n, "lang": None if b else "en", "word": None if b else f"w{a}"} for a, b, c, n in rows]
    batches = [pa.RecordBatch.from_pylist(data[i : i + size], pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("h3", pa.int64()), ("n", pa.int64()), ("lang", pa.string()), ("word", pa.string())])) for i in range(0, len(data), size)]
    got = Counter()
    kinds = Counter()
    for batch in co._flows(4)(iter(batches)):
        for r in batch.to_pylist():
            got[r["kind"], r["h1"], r["h2"], r["h3"]] += r["n"]
            kinds[r["kind"], r["h1"], r["h2"], r["h3"]] += 1
    want = Counter()
    for a, b, c, n in rows:
        if b == 0:
            want["word", a, 0, 0] += n
            continue
        want["flow", a, 0, 0] += n
        want["node", a, b, 0] += n
        if c:
            want["edge", a, b, c] += n
    assert +got == Counter({k: n for k, n in want.items() if n >= 4 or k[0] in ("flow", "word")})
    assert all(n == 1 for k, n in kinds.items() if k[0] in ("edge", "node"))


def test_unary_paths_are_the_longer_phrases(spark):
    rows = [("p q r s t u v w x", "en")] * 4 + [("so p q", "en"), ("a b c d. z b c d", "de"), ("a b c d", "de"), ("k l m k l m k l m k l m k l m", "fr")]
    graph = co.flows(frame(spark, rows), 1)
    paths = co.unary_paths(graph)
    got = {tuple(r) for r in co.path_phrases(graph, paths).collect()}
    assert ("en", "p q r s t u v w x", 4) in got and not any(lang == "de" for lang, _, _ in got)
    f, _ = counts(rows)
    for lang, phrase, n in got:
        w = phrase.split(" ")
        assert len(w) >= 4 and {f[lang, tuple(w[i : i + 3])] for i in range(len(w) - 2)} == {n}
        assert {f[lang, tuple(w[i : i + 2])] for i in range(1, len(w) - 2)} == {n}


def test_no_rows(spark):
    assert co.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert co.collocations(frame(spark, [("", "en"), (None, None)])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 123_456_789_012_345, 223_456_789_012_346, 987_654_321_098_765
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(co._score("a", "l", "r")).first()
    assert row[0] == 10**6 * a * a // (left * right)
