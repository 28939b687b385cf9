"""Delta-maintained totals against SQL, and idempotent commits."""

from strata.llm import token_rollup
from tests.llm import oracle


def test_query_equals_its_sql(spark):
    assert oracle.difference(spark, "/root/testdata/sf0.001", "op2_token_rollup") is None


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_inserts_deletes_revisions_and_replays(spark, tmp_path):
    image = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"
    frame = lambda rows: spark.createDataFrame(rows, f"before {image}, after {image}, n_docs long")
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "t"))
    assert totals(rollup) == {}
    rollup.commit("a", frame([(None, ("s", "en", "v1", 10), 0), (None, ("s", "en", "v1", 5), 0), (None, (None, None, "v1", None), 0)]))
    want = {("s", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0)}
    assert totals(rollup) == want
    moved = frame([(("s", "en", "v1", 5), ("s", "fr", "v1", 7), 0), (("s", "en", "v1", 10), None, 0), (None, None, 0)])
    rollup.commit("b", moved)
    rollup.commit("b", moved)
    want = {("s", "fr", "v1"): (1, 7), (None, None, "v1"): (1, 0)}
    assert totals(rollup) == want
    rollup.commit("c", frame([]))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.compact("x").collect()} == totals(rollup) == want


def test_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, source string, lang string, before string"
    rows = [(1, "a b\na b\nc", None, "en", ""), (2, None, "s", None, ""), (3, "", "s", "en", ""), (4, "a b\na b\nc", "s", "en", ""), (None, "", "s", "en", "")]
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "t"))
    for batch_id, changes in token_rollup.corpus_changes(spark.createDataFrame(rows, schema)).items():
        rollup.commit(batch_id, changes)
    assert {k: v for k, v in totals(rollup).items() if k[2] == "words-1"} == {
        (None, "en", "words-1"): (1, 3), ("s", None, "words-1"): (1, 0), ("s", "en", "words-1"): (2, 0)
    }
