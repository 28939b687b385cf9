"""Divergences against SQL over the whole table and against brute force on odd rows."""

import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import source_divergence as sd
from tests.llm.oracle import difference


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, folder):
    assert difference(spark, f"/root/testdata/{folder}", "op13_source_divergence") is None


def brute(rows, min_docs=10, top=10):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    low = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", term.findall((text or "").translate(low))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t in df if df[t] >= min_docs]
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b, t):
            p, q = share(a, t), share(b, t)
            return (p - q) ** 2 // (p + q)

        for s in count:
            pairs = [(sum(f(count[s], count[o], t) for t in kept), o) for o in count if o != s]
            terms = [(f(count[s], whole, t), t) for t in kept if count[s][t] and share(count[s], t) > share(whole, t)]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, i, v, r) for r, (v, i) in enumerate(ranked, 1)}
    return out


def found(df, **more):
    return {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in sd.divergences(df, **more).collect()}


SCHEMA = "text string, lang string, source string, n int, term int, shard int"
ODD = [
    (None, "en", "a"), ("", "en", "b"), ("12 34", "en", "c"), (None, None, None), ("solo", "xx", "only"), ("é É ß Aa", "", "z"),
    ("the the THE cat's cat", "en", "a"), ("the dog\x7fran", "en", "b"), ("word " * 30000 + "the", "en", "a"), ("日本語 the", "en", "日"),
]


@pytest.mark.parametrize("min_docs,shard", [(1, 2), (2, 1), (3, 8192), (50, 8192)])
def test_odd_rows_equal_brute_force(spark, min_docs, shard):
    rows = ODD + [ODD[6]] * 5 + [("tie one two", "en", s) for s in "xyz"]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    assert found(df, min_docs=min_docs, terms_per_shard=shard) == brute(rows, min_docs)


def test_no_rows(spark):
    assert sd.divergences(spark.createDataFrame([], SCHEMA)).count() == 0


def test_partial_counts_are_merged_and_handed_on(spark, monkeypatch):
    monkeypatch.setattr(sd, "MERGE_ROWS", 3)
    monkeypatch.setattr(sd, "SLICE_BYTES", 10)
    rows = [(f"w{'abcdef'[i % 6] * (i % 4 + 1)} the", "en", "st"[i % 2]) for i in range(60)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"t": t, "lang": la, "source": s} for t, la, s in rows])
    got = Counter()
    for part in sd._partial_counts(iter([batch, batch])):
        for r in part.to_pylist():
            got[(r["source"], r["term"])] += r["n"]
    want = Counter((s, w) for t, _, s in rows * 2 for w in re.findall("[a-z]+", t))
    assert +got == want


def test_shares_are_exact_beyond_64_bits():
    count = np.array([0, 2, 10**12 + 7, 8 * 10**15], np.int64)
    total = np.array([9 * 10**15], np.int64)
    assert sd.scaled_share(count, total).tolist() == [1 + 10**9 * int(c) // int(total[0]) for c in count]


def test_many_sources_use_blocks(spark, monkeypatch):
    rows = [(f"common {'xyz'[i % 3]}{chr(97 + i % 26)}", "en", f"s{i % 9}") for i in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(sd, "CELLS", 20)
    assert found(df, min_docs=2) == brute(rows, 2)
