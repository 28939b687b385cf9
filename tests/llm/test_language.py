"""Rank-order profiles against brute force and held-out labels."""

import zlib
from collections import Counter

import regex

from strata.llm import language
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def grams(text):
    out = Counter()
    for word in regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            out.update(g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g != " ")
    return out


def profile(counts):
    """Rank of each n-gram; ties in the order of the packed code points."""
    def number(g):
        v = 0
        for c in g:
            v = (v << 21) | ord(c)
        return v

    # Between words one blank serves both, so the blank pairs are counted as in the text.
    best = sorted(counts, key=lambda g: (-counts[g], number(g)))[: language.PROFILE]
    return {g: i for i, g in enumerate(best)}


def brute(rows):
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in rows}
    counts = {}
    for d, text, lang in rows:
        if not held[d] and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: profile(c) for lang, c in counts.items()}
    out = {}
    for d, text, _ in rows:
        if not regex.search(r"\p{L}", text or "") or not profiles:
            out[d] = (held[d], "und", 0.0)
            continue
        mine = profile(grams(text))
        far = {
            lang: sum(abs(p[g] - i) if g in p else language.PROFILE for g, i in mine.items()) / (language.PROFILE * len(mine))
            for lang, p in profiles.items()
        }
        best = min(sorted(far), key=far.get)
        out[d] = (held[d], best, 1 - far[best])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for d, (held, lang, score) in want.items():
        assert got[d][:2] == (held, lang) and abs(got[d][2] - score) < 1e-9, d


def test_query_equals_brute_force_and_labels(spark):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op1_rank_order_language"](spark, FOLDER).collect()}
    same(got, brute(rows))
    labels = {d: lang for d, _, lang in rows}
    held = [d for d in got if got[d][0]]
    assert sum(got[d][1] == labels[d] for d in held) >= 0.9 * len(held)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "fr"), (4, "the cat and the dog", "en"), (5, "le chat et le chien", "fr")]
    rows += [(i, "the end of the day " * i, "en") for i in range(6, 20)] + [(i, "la fin du jour " * i, "fr") for i in range(20, 40)]
    rows += [(50, "ничего", None), (51, "the " * 50000, None), (52, "²½", None), (53, "日本語", "ja")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in language.identify(df).collect()}
    same(got, brute(rows))
    assert language.identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.identify(df.filter("lang IS NULL")).collect()} == {"und"}
