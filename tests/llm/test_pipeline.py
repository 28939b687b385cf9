"""The pipeline's stages, each on what the one before kept, against brute force."""

import corpus_pipeline
from strata.llm import quality_rules
from strata.llm.common import table, written
from tests.llm import brute
from tests.llm.test_packing import held
from tests.llm.test_phrase_index import brute as contaminated

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_each_stage(spark):
    docs = table(spark, FOLDER, "documents")
    kept, whole = [docs], texts(docs)
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], FOLDER), "test-stage"))
    assert all(df.columns == docs.columns for df in kept[:-1])
    all_, good, single, cut, clean = map(texts, kept[:-1])

    rules = quality_rules.learn_rules(docs, table(spark, FOLDER, "labels"))
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, rules).collect()}
    assert good == {d: t for d, t in whole.items() if verdicts[d]}
    for d, t in whole.items():
        n, _, _, _, repeated = brute.repeat_statistics(t)
        assert not verdicts[d] or n >= 50 and 100 * repeated <= 50 * n

    roots = brute.near_duplicate_components(good, 80)
    assert single == {d: t for d, t in good.items() if roots[d][2]}

    _, later = brute.repeated_spans(single, 50)
    assert cut.keys() == single.keys() and later
    for d, t in single.items():
        spans = later.get(d, [])
        left = [w for i, w in enumerate(brute.words(t)) if not any(a <= i < a + n for a, n in spans)]
        assert brute.words(cut[d]) == left and (spans or cut[d] == t)

    items = {r["item_id"]: r["text"] for r in table(spark, FOLDER, "benchmark").collect()}
    found = contaminated(cut, items)
    assert clean == {d: t for d, t in cut.items() if not found[d][4]}
    assert all(r["n_chars"] == len(r["text"]) for r in kept[-2].collect())

    n, total = held(kept[-1].collect(), clean, 1024)
    assert n <= 1.05 * total / 1024 + 1
