"""Phrases of two and three words that stand together more than their parts do (operator 12).

Weighted de Bruijn graph: nodes are pairs of words, the edge (a, b) -> (b, c) is the phrase a b c
with the number of its occurrences. Only the longest grams are counted from the texts, one for each
word: the three words from it on, or what is left of its piece where the piece ends sooner (the
correction at piece ends). A shorter phrase's count is the flow out of its node: the sum over all
grams that begin with it. Nodes that one edge enters and one leaves, with all of their flow, are
compacted: the edges on both sides belong to one unary path, a longer phrase of the same count.

Texts are read in numpy inside the tasks. A word is known by a 64-bit hash of itself and its
language until the phrases that are returned get their words back; two of a language's words share
one with a chance of 2^-64 a pair. Grams are counted in a task's large batches before the one
shuffle, by their first two words, which then holds a pair's distinct grams of each batch, in the
order of their words, so that repeated ones compress; sorted within the partitions they are summed in one pass of bounded memory.

Null text is empty, null lang is "und". Texts and pieces without a word give nothing. Repeated rows
count each. An empty table has no rows. Extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked, written
from strata.llm.words import LOWER, byte_slices, mix, words_of

UNKNOWN = "und"
FLUSH_WORDS = 2_000_000  # words a task counts before it hands their grams on
MERGE_ROWS = 500_000  # sorted grams summed at a time
OUT_ROWS = 100_000

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[9, 32]] = True

GRAMS = "h1 long, h2 long, h3 long, n long, lang string, word string"
FLOWS = "kind string, h1 long, h2 long, h3 long, n long, lang string, word string"
EDGE = ["h1", "h2", "h3"]


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The lower-cased bytes of some words as one column."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[at]]))


class _Grams:
    """The grams of some words, not counted yet, and the words themselves."""

    def __init__(self) -> None:
        self.grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.words: list[tuple[np.ndarray, pa.StringArray, pa.StringArray]] = []
        self.n: dict[str, int] = {}
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: pa.StringArray, marks: np.ndarray) -> None:
        words = words_of(0, data, offsets, _SEPARATOR)
        if not len(words.hashes):
            return
        text = np.repeat(np.arange(len(langs)), np.diff(words.first))
        h = np.maximum(mix(words.hashes ^ marks[text]), np.uint64(1)).view(np.int64)
        piece = np.cumsum(_BREAK[data])[words.starts] + text
        inner = piece[1:] == piece[:-1]
        h2, h3 = np.zeros_like(h), np.zeros_like(h)
        h2[:-1][inner] = h[1:][inner]
        longer = inner[1:] & inner[:-1]
        h3[:-2][longer] = h[2:][longer]
        self.grams.append((h, h2, h3))
        distinct, first = np.unique(h, return_index=True)
        self.words.append((distinct, _strings(data, words.starts[first], words.ends[first]), langs.take(pa.array(text[first]))))
        for lang, n in zip(langs.to_pylist(), np.diff(words.first).tolist()):
            self.n[lang] = self.n.get(lang, 0) + n
        self.size += len(h)

    def counted(self) -> Iterator[pa.RecordBatch]:
        """Distinct grams with their counts; one row for each word; one for each language."""
        h1, h2, h3 = (np.concatenate(c) for c in zip(*self.grams))
        long = h2 != 0
        ends = np.sort(h1[~long])
        a, b, c = h1[long], h2[long], h3[long]
        # Sorted by the first word, then the second: the shuffle's compression finds both repeated.
        high, low = np.uint64(32), np.uint64(48)
        key = (mix(a.view(np.uint64)) >> high << high) | (mix(b.view(np.uint64)) >> low << np.uint64(16)) | (mix(c.view(np.uint64)) >> low)
        order = np.argsort(key)
        a, b, c = a[order], b[order], c[order]
        first = np.ones(len(a), bool)  # equal keys of different grams at most split a count
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(first)
        n = np.diff(np.append(at, len(a)))
        for lo in range(0, len(at), OUT_ROWS):
            part = at[lo : lo + OUT_ROWS]
            blank = pa.nulls(len(part), pa.string())
            yield pa.record_batch([pa.array(x) for x in (a[part], b[part], c[part], n[lo : lo + OUT_ROWS])] + [blank, blank], names=[*EDGE, "n", "lang", "word"])
        known = np.concatenate([w for w, _, _ in self.words])
        texts, langs = (pa.concat_arrays([x[i] for x in self.words]) for i in (1, 2))
        word, first_at = np.unique(known, return_index=True)
        n = np.searchsorted(ends, word, side="right") - np.searchsorted(ends, word)
        for lo in range(0, len(word), OUT_ROWS):
            part = first_at[lo : lo + OUT_ROWS]
            none = np.zeros(len(part), np.int64)
            yield pa.record_batch(
                [pa.array(x) for x in (word[lo : lo + OUT_ROWS], none, none, n[lo : lo + OUT_ROWS].astype(np.int64))]
                + [langs.take(pa.array(part)), texts.take(pa.array(part))],
                names=[*EDGE, "n", "lang", "word"],
            )
        names = list(self.n)
        none = np.zeros(len(names), np.int64)
        yield pa.record_batch(
            [pa.array(x) for x in (none, _marks(names).view(np.int64), none, np.array(list(self.n.values()), np.int64))]
            + [pa.array(names, pa.string()), pa.nulls(len(names), pa.string())],
            names=[*EDGE, "n", "lang", "word"],
        )


def _marks(langs: list[str]) -> np.ndarray:
    """A 64-bit hash of each language's name, never 0."""
    return np.array([int.from_bytes(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest()) | 1 for x in langs], np.uint64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Grams()
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        marks = _marks(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        for lo, data, offsets in byte_slices(batch.column("t")):
            hi = lo + len(offsets) - 1
            held.add(data, offsets, batch.column("lang").slice(lo, hi - lo), marks[lo:hi])
            if held.size >= FLUSH_WORDS:
                yield from held.counted()
                held = _Grams()
    if held.size:
        yield from held.counted()


def _table(kind: str, n: np.ndarray, h: list[np.ndarray], lang: pa.Array | None = None, word: pa.Array | None = None) -> pa.RecordBatch:
    none = np.zeros(len(n), np.int64)
    blank = pa.nulls(len(n), pa.string())
    columns = [pa.array(x) for x in (*h, *[none] * (3 - len(h)), n)]
    return pa.record_batch(
        [pa.array([kind] * len(n)), *columns, blank if lang is None else lang, blank if word is None else word],
        names=["kind", *EDGE, "n", "lang", "word"],
    )


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows begins."""
    first = np.ones(len(columns[0]), bool)
    first[1:] = False
    for c in columns:
        first[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(first)


def _flows(min_count: int):
    """Sums of grams sorted by their words: edges, nodes, partial flows of words, words, sizes."""

    def summed(rows: pa.Table, last: bool, pair: tuple[int, int, int] | None):
        """What the rows give, the open last gram, and the open last node with its flow."""
        h1, h2, h3, n = (rows[c].to_numpy() for c in (*EDGE, "n"))
        at = _runs(h1, h2, h3)
        n = np.add.reduceat(n, at) if len(at) else n
        rest = None
        if not last:
            rest = rows.slice(int(at[-1]), 1).set_column(3, "n", pa.array(n[-1:]))
            at, n = at[:-1], n[:-1]
        h1, h2, h3 = h1[at], h2[at], h3[at]
        out = []
        edge = (h3 != 0) & (n >= min_count)
        out.append(_table("edge", n[edge], [h1[edge], h2[edge], h3[edge]]))
        size = h1 == 0
        strings = rows.select(["lang", "word"]).take(pa.array(at[size | (h2 == 0)])).combine_chunks()
        lang, word = (strings[c].combine_chunks() if len(strings) else pa.array([], pa.string()) for c in ("lang", "word"))
        whole = pa.array(size[size | (h2 == 0)])
        out.append(_table("size", n[size], [], lang.filter(whole)))
        single = ~size & (h2 == 0)
        out.append(_table("word", n[single], [h1[single]], lang.filter(pc.invert(whole)), word.filter(pc.invert(whole))))
        h1, h2, n = h1[~size], h2[~size], n[~size]
        two = h2 != 0
        flow_at = _runs(h1[two]) if two.any() else np.zeros(0, np.int64)
        if len(flow_at):
            out.append(_table("flow", np.add.reduceat(n[two], flow_at), [h1[two][flow_at]]))
        a, b, f = h1[two], h2[two], n[two]
        if pair is not None:
            a, b, f = np.append(pair[0], a), np.append(pair[1], b), np.append(pair[2], f)
        at = _runs(a, b) if len(a) else np.zeros(0, np.int64)
        f = np.add.reduceat(f, at) if len(at) else f
        a, b = a[at], b[at]
        pair = None
        if len(a) and not last:
            pair = (a[-1], b[-1], f[-1])
            a, b, f = a[:-1], b[:-1], f[:-1]
        node = f >= min_count
        out.append(_table("node", f[node], [a[node], b[node]]))
        return [t for t in out if t.num_rows], rest, pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, pair, schema = 0, None, None
        for batch in batches:
            schema = batch.schema
            held.append(batch)
            size += batch.num_rows
            if size >= MERGE_ROWS:
                out, rest, pair = summed(pa.Table.from_batches(held), False, pair)
                yield from out
                held, size = rest.to_batches(), 1
        if schema is not None:
            yield from summed(pa.Table.from_batches(held, schema), True, pair)[0]

    return run


def flows(docs: DataFrame, min_count: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """The graph, written: edges and nodes of at least ``min_count``, flows of words, words, sizes.

    ``kind`` tells which: "edge" (h1, h2, h3), "node" (h1, h2), "flow" and "word" (h1; their ``n``
    have to be summed, a word's row has its string) and "size" (words of a language, to be summed).
    """
    rows = picked(docs, {"t": text, "lang": lang})
    rows = rows.select(F.coalesce(F.col("t").cast("string"), F.lit("")).alias("t"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    grams = rows.mapInArrow(_count_grams, GRAMS).repartition("h1", "h2").sortWithinPartitions(*EDGE)
    return written(grams.mapInArrow(_flows(min_count), FLOWS), "phrase-graph")


def _named(df: DataFrame, *columns: str) -> DataFrame:
    """Fresh columns, ``theirs`` or ``theirs>own``, so that a table can be joined with itself."""
    return picked(df, {c.split(">")[-1]: c.split(">")[0] for c in columns})


def unary_paths(graph: DataFrame) -> DataFrame:
    """Edges (h1, h2, h3) of unary paths with the path's first edge (g1, g2, g3) and their place ``at``.

    An edge follows another if both have all the flow of the node between them. Places are found by
    doubling: each round an edge takes over its predecessor's pointer, so a path of m edges needs
    log2 m rounds. A ring of unary nodes has no first edge; its edges are left out.
    """
    edges, nodes = graph.filter("kind = 'edge'"), graph.filter("kind = 'node'")
    before = _named(edges, "h1>p1", "h2>h1", "h3>h2", "n")
    after = _named(edges, "h1", "h2", "h3", "n")
    whole = _named(nodes, "h1", "h2", "n")
    linked = after.join(whole, ["h1", "h2", "n"]).join(before, ["h1", "h2", "n"])
    pointers = linked.select(*EDGE, F.col("p1").alias("g1"), F.col("h1").alias("g2"), F.col("h2").alias("g3"), F.lit(1).cast("long").alias("at"))
    pointers = written(pointers, "path-pointers")
    size = pointers.count()
    length = 1
    while length <= size:  # no path is longer than all of its edges
        onward = _named(pointers, "h1>g1", "h2>g2", "h3>g3", "g1>n1", "g2>n2", "g3>n3", "at>more")
        met = pointers.join(onward, ["g1", "g2", "g3"], "left")
        moved = met.select(
            *EDGE,
            *(F.coalesce(f"n{i}", f"g{i}").alias(f"g{i}") for i in (1, 2, 3)),
            (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"),
            F.col("more").isNotNull().alias("moves"),
        )
        moved = written(moved, "path-pointers")
        pointers = moved.drop("moves")
        if moved.filter("moves").isEmpty():
            break
        length *= 2
    inside = _named(pointers, "h1>g1", "h2>g2", "h3>g3")
    return pointers.join(inside, ["g1", "g2", "g3"], "left_anti")  # what still points into a ring


def path_phrases(graph: DataFrame, paths: DataFrame) -> DataFrame:
    """The compacted paths as phrases of four words and more: ``lang``, ``phrase``, ``n``.

    A phrase's words are gathered by its first edge: as many as a repeated passage has.
    """
    heads = _named(paths, "g1>h1", "g2>h2", "g3>h3").distinct()
    steps = paths.select("g1", "g2", "g3", (F.col("at") + 2).alias("at"), F.col("h3").alias("h"))
    for i in (1, 2, 3):
        steps = steps.unionByName(heads.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("h3").alias("g3"), F.lit(i - 1).cast("long").alias("at"), F.col(f"h{i}").alias("h")))
    words = graph.filter("kind = 'word'").select(F.col("h1").alias("h"), "lang", "word")
    spelled = steps.join(words, "h").groupBy("g1", "g2", "g3", "lang").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    weights = _named(graph.filter("kind = 'edge'"), "h1>g1", "h2>g2", "h3>g3", "n")
    return spelled.join(weights, ["g1", "g2", "g3"]).select("lang", F.array_join("w.word", " ").alias("phrase"), "n")


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(10^6 a a / (l r)) with 38 digits: exact while a phrase occurs fewer than 10^15 times."""
    whole = "decimal(18, 0)"
    return F.expr(f"(CAST({a} AS {whole}) * CAST({a} AS {whole}) * 1000000BD) div (CAST({left} AS {whole}) * CAST({right} AS {whole}))").cast("long")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10, cover_percent: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase that occurs ``a`` times, in parts of ``l`` and ``r`` at its lowest-scoring cut, scores
    10^6 a^2 / (l r), rounded down. Pairs inside a phrase of three words that has at least
    ``cover_percent`` of their occurrences are dropped; those inside a unary path without a look.
    """
    graph = flows(docs, min_count, text, lang)
    paths = unary_paths(graph)
    edges = graph.filter("kind = 'edge'")
    nodes = graph.filter("kind = 'node'")
    once = graph.filter("kind IN ('flow', 'word')").groupBy("h1").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    spelled = _named(graph.filter("kind = 'word'"), "h1", "lang", "word")
    words = written(once.join(spelled, "h1").select("h1", "f", "lang", "word"), "phrase-words")

    inner = _named(paths, "h1", "h2").distinct()  # the node before a linked edge has all its flow in one
    covering = _named(edges, "h1", "h2", "n>most").unionByName(_named(edges, "h2>h1", "h3>h2", "n>most"))
    covering = covering.groupBy("h1", "h2").agg(F.max("most").alias("most"))
    pairs = nodes.join(inner, ["h1", "h2"], "left_anti").join(covering, ["h1", "h2"], "left")
    pairs = pairs.filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("n") * cover_percent))
    first, second, third = (_named(words, f"h1>h{i}", f"f>f{i}", f"word>w{i}", *(["lang"] if i == 1 else [])) for i in (1, 2, 3))
    two = pairs.select("h1", "h2", F.col("n").alias("a")).join(first, "h1").join(second, "h2")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.struct(_score("a", "f1", "f2").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f2").alias("r")).alias("cut"))
    three = edges.select(*EDGE, F.col("n").alias("a"))
    three = three.join(_named(nodes, "h1", "h2", "n>f12"), ["h1", "h2"]).join(_named(nodes, "h1>h2", "h2>h3", "n>f23"), ["h2", "h3"])
    three = three.join(first, "h1").join(second, "h2").join(third, "h3")
    cuts = [
        F.struct(_score("a", le, ri).alias("score"), F.lit(k).alias("k"), F.col(le).alias("l"), F.col(ri).alias("r"))
        for k, le, ri in ((1, "f1", "f23"), (2, "f12", "f3"))
    ]
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(*cuts).alias("cut"))
    sizes = graph.filter("kind = 'size'").groupBy("lang").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    found = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    found = found.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return found.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
