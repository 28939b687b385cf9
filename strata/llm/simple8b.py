"""Token ids in files, Simple-8b coded (operator 4).

A 64-bit word holds a 4-bit selector and 60 bits of values of one width; selector 0 is the escape:
the next word is one whole value. Words are chosen greedily, most values first. A chunk is a
self-contained run of whole documents: header, key and length of each document, the offset of
each block of BLOCK_IDS ids in the words, then the words. Blocks start on a word of their own, so
they decode independently, all words of one selector at once.

Chunks are rows of Parquet files (any Hadoop store, committed by Spark's writer), in ascending key
order: ``shard`` numbers the files' tasks, ``first_id`` counts the ids before the chunk in its shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import picked
from strata.llm.tokens import tokenizer
from strata.sources.folders import shared_folder

# How many values a word holds and their width in bits, for the selectors 1 to 14.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

MAGIC = b"S8B1"
HEADER = struct.Struct("<4sIQQI")  # magic, documents, ids, words, blocks
BLOCK_IDS = 1024
CHUNK_IDS = 1 << 19  # a chunk is closed once it has so many ids
KEY = np.dtype([("key", "<i8"), ("known", "u1"), ("n", "<i8")])
FILE = "shard int, chunk int, first_id long, n_docs int, n_ids long, payload binary"


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values (unsigned, 64 bits) and the word each block starts at.

    Step j finds where the j-th word of every block that has one starts; then all words of one
    selector are filled together.
    """
    n = len(values)
    blocks = -(-n // BLOCK_IDS)
    grid = np.zeros((blocks, BLOCK_IDS), dtype=np.uint64)
    grid.reshape(-1)[:n] = values
    sizes = np.full(blocks, BLOCK_IDS)
    if n:
        sizes[-1] = n - BLOCK_IDS * (blocks - 1)
    choice = _choices(grid)
    # The places words start at, for all blocks at once.
    counts = np.array((1, *COUNTS))
    place, rows = np.zeros(blocks, dtype=np.int64), np.arange(blocks)
    owners, starts = [], []
    while len(rows):
        here = place[rows]
        owners.append(rows)
        starts.append(here)
        place[rows] = here + counts[choice[rows, here]]
        rows = rows[place[rows] < sizes[rows]]
    if not owners:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner, start = np.concatenate(owners), np.concatenate(starts)
    order = np.argsort(owner, kind="stable")
    owner, start = owner[order], start[order]
    selectors = choice[owner, start]
    # An escape takes two words; at: where each word goes.
    takes = np.where(selectors == 0, 2, 1)
    at = np.cumsum(takes) - takes
    words = np.zeros(int(takes.sum()), dtype=np.uint64)
    padded = np.concatenate([grid, np.zeros((blocks, max(COUNTS)), dtype=np.uint64)], axis=1)
    for selector in np.unique(selectors):
        mine = np.flatnonzero(selectors == selector)
        row, first, to = owner[mine], start[mine], at[mine]
        if not selector:
            words[to + 1] = grid[row, first]
            continue
        value = np.full(len(mine), selector, dtype=np.uint64) << np.uint64(60)
        for j in range(COUNTS[selector - 1]):
            value |= padded[row, first + j] << np.uint64(WIDTHS[selector - 1] * j)
        words[to] = value
    return words, at[np.searchsorted(owner, np.arange(blocks))]


def _choices(grid: np.ndarray) -> np.ndarray:
    """For each place the selector that holds the most values from there on; 0 is an escape.

    Past a block's end everything fits. Values are ranked by the narrowest width that holds them,
    and the greatest rank among c consecutive ones comes from two overlapping shorter runs.
    """
    limits = np.array([1 << w for w in WIDTHS], dtype=np.uint64)
    ranks = np.zeros((len(grid), BLOCK_IDS + max(COUNTS)), dtype=np.uint8)
    ranks[:, :BLOCK_IDS] = np.searchsorted(limits, grid.reshape(-1), side="right").reshape(grid.shape)
    choice = np.zeros(grid.shape, dtype=np.uint8)
    greatest, known = {1: ranks}, 1
    for selector in range(len(COUNTS), 0, -1):
        count = COUNTS[selector - 1]
        if count > known:
            part = min(c for c in greatest if 2 * c >= count)
            longer = ranks.copy()
            step = count - part
            longer[:, : -step or None] = np.maximum(greatest[part][:, : -step or None], greatest[part][:, step:])
            greatest[count], known = longer, count
        choice[greatest[count][:, :BLOCK_IDS] < selector] = selector
    return choice


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values again.

    Only the places of the selectors are found step by step, for all blocks at once, and only if
    there are escapes; the values of each selector come out of all its words together.
    """
    selectors = (words >> np.uint64(60)).astype(np.int64)
    real = np.ones(len(words), dtype=bool)
    if len(words) and not selectors.all():  # a raw word follows each escape
        ends = np.append(offsets[1:], len(words))
        at = offsets.copy()
        real[:] = False
        while len(at):
            real[at] = True
            at = at + 1 + (selectors[at] == 0)
            going = at < ends
            at, ends = at[going], ends[going]
    places = np.flatnonzero(real)
    used = selectors[places]
    held = np.array((1, *COUNTS))[used]
    block = np.searchsorted(offsets, places, side="right") - 1
    ends = np.cumsum(held)
    before = ends - held
    start_of_block = before[np.searchsorted(places, offsets)] if len(offsets) else before
    target = before - start_of_block[block] + block * BLOCK_IDS
    out = np.zeros(len(offsets) * BLOCK_IDS + max(COUNTS), dtype=np.uint64)
    limit = np.minimum((block + 1) * BLOCK_IDS, n)
    for selector in np.unique(used):
        mine = used == selector
        to, upto = target[mine], limit[mine]
        if not selector:
            out[to] = words[places[mine] + 1]
            continue
        width = np.uint64(WIDTHS[selector - 1])
        mask = (np.uint64(1) << width) - np.uint64(1)
        source = words[places[mine]]
        for j in range(COUNTS[selector - 1]):
            inside = to + j < upto
            out[to[inside] + j] = (source[inside] >> (width * np.uint64(j))) & mask
    return out[:n]


def to_chunk(keys: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    words, offsets = encode(ids.astype(np.uint64))
    index = np.zeros(len(keys), KEY)
    index["key"], index["n"] = [k or 0 for k in keys], sizes
    index["known"] = [k is not None for k in keys]
    head = HEADER.pack(MAGIC, len(keys), len(ids), len(words), len(offsets))
    return b"".join([head, index.tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def from_chunk(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The documents (KEY records) and all their ids."""
    magic, docs, n, words, blocks = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b chunk")
    at = HEADER.size
    index = np.frombuffer(payload, KEY, docs, at)
    at += index.nbytes
    offsets = np.frombuffer(payload, "<u4", blocks, at).astype(np.int64)
    return index, decode(np.frombuffer(payload, "<u8", words, at + 4 * blocks), offsets, n)


def _chunks(path: str, space: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, before = TaskContext.get().partitionId(), 0, 0
        word_memo = tokenizer(path, space)
        keys: list[int | None] = []
        held: list[bytes] = []
        waiting = 0

        def closed() -> pa.RecordBatch:
            nonlocal chunk, before, keys, held, waiting
            ids = np.frombuffer(b"".join(held), "<u4")
            payload = to_chunk(keys, [len(h) // 4 for h in held], ids)
            row = [shard], [chunk], [before], [len(keys)], [len(ids)], [payload]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()
            names = ["shard", "chunk", "first_id", "n_docs", "n_ids", "payload"]
            chunk, before = chunk + 1, before + len(ids)
            keys, held, waiting = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids = word_memo.encode(batch.column(1).slice(at, 1024).to_pylist())
                for key, found in zip(batch.column(0).slice(at, 1024).to_pylist(), ids):
                    keys.append(key)
                    held.append(found + end)
                    waiting += len(found) // 4 + 1
                    if waiting >= CHUNK_IDS:
                        yield closed()
        if keys:
            yield closed()

    return run


def write_ids(
    docs: DataFrame,
    folder: str,
    path: str,
    space: str = "dropped",
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Writes the ids of all texts, each with ``end_id`` after it, in ascending key order.

    Rows with a null key come first, rows that repeat a key stand together in the order of their
    texts' hashes; a null or empty text is its end id alone. One shuffle, of the texts, by ranges
    of the key.
    """
    texts = picked(docs, {"k": key, "t": text})
    order = [F.asc_nulls_first("k"), F.xxhash64("t").asc()]
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(_chunks(path, space, end_id), FILE).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks of a folder with ``start``: the ids of all chunks before.

    Only the totals of the shards are summed in one place, a row for each written task.
    """
    files = spark.read.schema(FILE).parquet(folder)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return files.join(bases, "shard").withColumn("start", F.col("base") + F.col("first_id")).drop("base")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            index, ids = from_chunk(payload.as_py())
            ends = np.cumsum(index["n"])
            data = memoryview(ids.astype("<u4")).cast("B")
            crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), index["n"].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(index["key"], mask=index["known"] == 0),
                    pa.array(start + ends - index["n"]),
                    pa.array(index["n"]),
                    pa.array(crcs, pa.int64()),
                ],
                names=["k", "start", "n_tokens", "ids_crc32"],
            )


def document_summaries(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of read chunks: ``key``, ``start``, ``n_tokens`` and ``ids_crc32``, by decoding."""
    found = files.select("start", "payload").mapInArrow(
        _summaries, "k long, start long, n_tokens long, ids_crc32 long"
    )
    return found.withColumnRenamed("k", key)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of ``docs`` to the shared folder and reads them back."""
    folder = shared_folder(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path, key=key, text=text)
    return document_summaries(read_ids(docs.sparkSession, folder), key)
