"""Divergence of the sources of a language from each other and from the whole (operator 13).

Partial counts are made by Arrow's own functions inside the tasks: ascii_lower,
split_pattern_regex, dictionary_encode and hash group_by, merged over a task's batches while they
are few. Spark sums them per (lang, source, term), keeps the terms of a language that stand in
enough of its documents, and writes them; shards of some thousand terms of one language then give
partial divergences, which are summed. Nothing passes through the driver.

All numbers are integers. A term's share is scaled by long division in three steps of 1000, so that
no product passes 64 bits while a source has fewer than 9 * 10^15 terms.

Null text, lang and source are ''. A text without a term (empty, null, digits only) still makes its
(lang, source) group occur. Repeated rows are documents of their own. Ties are broken by the item's
UTF-8 bytes. An empty table has no rows. Extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked, written

NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE_STEPS, SCALE_STEP = 3, 1000  # shares are scaled by 1000^3
SLICE_BYTES = 2 << 20  # texts counted at a time
MERGE_ROWS = 250_000  # partial counts a task holds before it hands them on
TERMS_PER_SHARD = 8192
CELLS = 1 << 18  # numbers of a dense block of a shard
COUNTS = "lang string, source string, term string, n long, d long"
FOUND = "lang string, source string, part string, item string, value long"


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Whole rows, about SLICE_BYTES of text at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _counted(rows: pa.RecordBatch) -> pa.Table:
    """Per (lang, source, term) of some rows: occurrences and documents; a null term per group."""
    split = pc.split_pattern_regex(pc.ascii_lower(rows.column("t")), NOT_TERM)
    terms = pc.list_flatten(split)
    of = pc.list_parent_indices(split)
    full = pc.not_equal(terms, "")
    coded = terms.filter(full).dictionary_encode()
    pairs = pa.table({"row": of.filter(full).cast(pa.int64()), "code": coded.indices})
    each = pairs.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    groups = pa.table({"lang": rows.column("lang"), "source": rows.column("source")})
    found = groups.take(each["row"]).append_column("code", each["code"]).append_column("n", each["count_all"])
    summed = found.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    term = coded.dictionary.take(summed["code"].combine_chunks()).cast(pa.string())
    counts = pa.table([summed["lang"], summed["source"], term, summed["n_sum"], summed["count_all"]], names=["lang", "source", "term", "n", "d"])
    seen = groups.group_by(["lang", "source"], use_threads=False).aggregate([])
    nothing = pa.array(np.zeros(len(seen), np.int64))
    return pa.concat_tables([counts, pa.table([seen["lang"], seen["source"], pa.nulls(len(seen), pa.string()), nothing, nothing], names=counts.column_names)])


def _merged(parts: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("d", "sum")])
    return whole.rename_columns(["lang", "source", "term", "n", "d"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        for rows in _text_slices(batch):
            held.append(_counted(rows))
            size += held[-1].num_rows
            if size > 2 * MERGE_ROWS:
                held = [_merged(held)]
                size = held[0].num_rows
                if size > MERGE_ROWS:
                    yield from held.pop().to_batches(max_chunksize=50_000)
                    size = 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per (lang, source, term): occurrences ``n`` and documents ``d``; a null term of 0 per group.

    Partitioned by (lang, term), to which a hot source or language is no obstacle: a term has at
    most one partial row per source and flush of a task.
    """
    rows = picked(docs, {"t": text, "lang": lang, "source": source})
    rows = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("t", "lang", "source")))
    partial = rows.mapInArrow(_partial_counts, COUNTS)
    # Rows that only say that a group occurs are dealt out by their source.
    dealt = partial.repartition("lang", F.coalesce("term", "source"))
    return dealt.groupBy("lang", F.coalesce("term", "source").alias("_deal"), "source", "term").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d")
    ).drop("_deal")


def scaled_share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * count / total), exactly."""
    whole = np.zeros(np.broadcast(count, total).shape, np.int64)
    rest = np.broadcast_to(count, whole.shape).astype(np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        whole = whole * SCALE_STEP + rest // total
        rest = rest % total
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(top: int):
    """Partial divergences of one shard of a language's terms."""

    def run(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        names = groups["source"].to_pylist()
        n_terms = groups["v"][0].as_py() if names else 0
        totals = groups["total"].to_numpy().astype(np.int64) + 2 * n_terms
        whole = int(groups["lang_total"][0].as_py()) + 2 * n_terms if names else 0
        pair = np.zeros((len(names), len(names)), np.int64)
        out: list[tuple[str, str, str, str, int]] = []
        if terms.num_rows:
            coded = terms["term"].combine_chunks().dictionary_encode()
            words, code = coded.dictionary, coded.indices.to_numpy()
            at = pc.index_in(terms["source"].combine_chunks(), pa.array(names, pa.string())).to_numpy()
            n = terms["n"].to_numpy().astype(np.int64)
            order = np.argsort(code, kind="stable")
            code, at, n = code[order], at[order], n[order]
            step = max(1, CELLS // len(names))
            best: list[list[tuple[int, int]]] = [[] for _ in names]
            for lo in range(0, len(words), step):
                a, b = np.searchsorted(code, [lo, lo + step])
                width = min(step, len(words) - lo)
                count = np.zeros((len(names), width), np.int64)
                count[at[a:b], code[a:b] - lo] = n[a:b]
                p = scaled_share(count + 2, totals[:, None])
                q = scaled_share(count.sum(axis=0) + 2, np.int64(whole))
                for g in range(len(names)):
                    pair[g, g + 1 :] += divergence(p[g], p[g + 1 :]).sum(axis=1)
                    above = np.flatnonzero((count[g] > 0) & (p[g] > q))
                    value = divergence(p[g][above], q[above])
                    if len(above) > top:  # all that reach the value of the one at rank ``top``
                        kept = value >= np.partition(value, -top)[-top]
                        above, value = above[kept], value[kept]
                    best[g] += zip(value.tolist(), (above + lo).tolist())
            texts = words.to_pylist()
            for g, found in enumerate(best):
                ranked = sorted((-v, texts[i].encode("utf-8", "surrogatepass"), i) for v, i in found)[:top]
                out += [(lang, names[g], "term", texts[i], -v) for v, _, i in ranked]
        pair += pair.T
        for g, name in enumerate(names):
            out += [(lang, name, "pair", other, int(pair[g, o])) for o, other in enumerate(names) if o != g]
        columns = list(zip(*out)) if out else [[]] * 5
        types = [pa.string()] * 4 + [pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "source", "part", "item", "value"])

    return run


def divergences(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 10,
    top: int = 10,
    terms_per_shard: int = TERMS_PER_SHARD,
) -> DataFrame:
    """Rows of ``lang, source, part, item, value, rank``.

    Part "pair": the divergence of each source from each other one of its language, all ranks.
    Part "term": the ``top`` terms that a source uses more than its language, by how much they add.
    Only terms in at least ``min_docs`` documents of the language count; a language that has none
    gives its pairs the value 0. A shard's memory grows with its terms and with the square of a
    language's sources, as the result does.
    """
    in_lang = Window.partitionBy("lang", "term")
    counts = term_counts(docs, text, lang, source)
    kept = counts.withColumn("df", F.sum("d").over(in_lang)).filter(F.col("term").isNull() | (F.col("df") >= min_docs))
    kept = written(kept.select("lang", "source", "term", "n"), "term-counts")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = kept.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(
        F.count("*").alias("v")
    )
    per_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(vocabulary, "lang", "left")
    per_lang = per_lang.select("lang", "lang_total", F.coalesce("v", F.lit(0)).alias("v")).withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("v") / terms_per_shard)).cast("int")
    )
    per_lang = written(per_lang, "lang-totals")
    terms = kept.filter("term IS NOT NULL").join(per_lang.select("lang", "shards"), "lang")
    terms = terms.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term", "n")
    each = groups.join(per_lang, "lang").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    each = picked(each, {c: c for c in ("lang", "shard", "source", "total", "lang_total", "v")})
    parts = terms.groupBy("lang", "shard").cogroup(each.groupBy("lang", "shard")).applyInArrow(_shard(top), FOUND)
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = summed.withColumn("rank", F.row_number().over(best))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
