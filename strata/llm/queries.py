"""Each operator as a query over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    collocations,
    html_cut,
    kd_shards,
    language,
    minhash,
    packing,
    phrase_index,
    quality_rules,
    simple8b,
    source_divergence,
    suffix_dedup,
    token_rollup,
    toxic_spans,
)
from strata.llm.common import table, tokenizer_file
from strata.sources.folders import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading all documents, deleting copies and revising counts; one batch twice."""
    rollup = token_rollup.TokenRollup(spark, shared_folder(spark, "token-rollup"))
    batches = token_rollup.corpus_changes(table(spark, sf_dir, "documents"))
    for batch_id, changes in batches.items():
        rollup.commit(batch_id, changes)
    rollup.commit("3-revise", batches["3-revise"])  # a replay
    return rollup.totals()


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of each document that stand elsewhere too, and those of them that stand earlier."""
    spans, later = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return spans.withColumn("kind", F.lit("repeated")).unionByName(later.withColumn("kind", F.lit("later")))


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kd_shards.kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_cut.extract(table(spark, sf_dir, "pages"))


def op9_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op11_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_spans.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_debruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergences(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_rank_order_language": op1_rank_order_language,
    "op2_token_rollup": op2_token_rollup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_simple8b": op4_simple8b,
    "op5_kd_shards": op5_kd_shards,
    "op6_phrase_index": op6_phrase_index,
    "op7_circulant_minhash": op7_circulant_minhash,
    "op8_html_cut": op8_html_cut,
    "op9_residual_packing": op9_residual_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_crf_toxicity": op11_crf_toxicity,
    "op12_debruijn_collocations": op12_debruijn_collocations,
    "op13_source_divergence": op13_source_divergence,
}

# DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_token_rollup": r"""
WITH docs AS (
    SELECT doc_id, source, lang, coalesce(text, '') AS text,
        text IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY text) AS is_copy
    FROM documents),
lines AS (
    SELECT doc_id, source, lang, list_aggregate(list_transform(
        list_filter(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10))))),
            lambda x: list_position(string_split(text, chr(10)), x[1]) = x[2] + 1), lambda x: x[1]),
        'string_agg', chr(10)) AS text
    FROM docs WHERE NOT coalesce(is_copy, false)),
counted AS (
    SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM lines
    UNION ALL
    SELECT source, lang, 'marks-1',
        len(regexp_extract_all(text, '[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]')) FROM lines)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY source, lang, tokenizer
""",
    "op6_phrase_index": r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
b AS (
    SELECT item_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE item_id IS NOT NULL),
starts AS (
    SELECT item_id, w, least(len(w), 13) AS k, unnest(range(greatest(len(w) - 13, 0) + 1)) AS s
    FROM b WHERE len(w) > 0),
test AS (SELECT DISTINCT item_id, k, array_to_string(w[s + 1 : s + k], ' ') AS g FROM starts),
sizes AS (SELECT DISTINCT k FROM test),
places AS (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS s FROM d, sizes WHERE len(w) >= k),
train AS (SELECT doc_id, k, s, array_to_string(w[s + 1 : s + k], ' ') AS g FROM places),
met AS (SELECT doc_id, item_id, s, k FROM train JOIN test USING (k, g)),
covered AS (SELECT doc_id, unnest(range(s, s + k)) AS p FROM met),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM covered GROUP BY doc_id),
items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM met GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op12_debruijn_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM documents),
sizes AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(len(w))) AS s FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[s + 1 : s + k], ' ') AS phrase, w[s + 1 : s + k] AS words
    FROM starts, (VALUES (1), (2), (3)) AS lengths(k) WHERE s + k <= len(w)),
f AS (SELECT lang, k, phrase, any_value(words) AS words, count(*) AS a FROM grams GROUP BY lang, k, phrase),
halves AS (
    SELECT lang, k, phrase, a, cut, array_to_string(words[1 : cut], ' ') AS le,
        array_to_string(words[cut + 1 : k], ' ') AS ri
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k >= 2 AND a >= 10)),
cuts AS (
    SELECT h.lang, h.k, h.phrase, h.a, cut, x.a AS l, y.a AS r,
        (CAST(1000000 AS HUGEINT) * h.a * h.a) // (CAST(x.a AS HUGEINT) * y.a) AS score
    FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.le JOIN f y ON y.lang = h.lang AND y.phrase = h.ri),
low AS (
    SELECT lang, k, phrase, a, arg_min(l, (score, cut)) AS l, arg_min(r, (score, cut)) AS r, min(score) AS score
    FROM cuts GROUP BY lang, k, phrase, a),
covering AS (
    SELECT lang, array_to_string(words[1 : 2], ' ') AS phrase, a FROM f WHERE k = 3 AND a >= 10
    UNION ALL
    SELECT lang, array_to_string(words[2 : 3], ' '), a FROM f WHERE k = 3 AND a >= 10),
most AS (SELECT lang, phrase, max(a) AS most FROM covering GROUP BY lang, phrase),
ranked AS (
    SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
    FROM low LEFT JOIN most ON low.k = 2 AND most.lang = low.lang AND most.phrase = low.phrase
    WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
""",
    "op13_source_divergence": r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
w AS (
    SELECT id, lang, source,
        unnest(list_filter(string_split_regex(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
    FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
total AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
    FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
whole AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
whole_total AS (SELECT lang, sum(n) AS total FROM whole GROUP BY lang),
share AS (
    SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n,
        CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2)) // (total + 2 * v) AS BIGINT) AS p
    FROM total t JOIN kept k USING (lang) JOIN v USING (lang)
        LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
lang_share AS (
    SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (total + 2 * v) AS BIGINT) AS q
    FROM whole JOIN whole_total USING (lang) JOIN v USING (lang)),
summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
    FROM share JOIN lang_share USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
