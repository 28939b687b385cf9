"""Best-fit packing of token sequences by hierarchical residual packing (operator 9).

Every task's pieces are packed by best fit, and the bins that are nearly full are closed. The
pieces of the underfull bins go on to the next level, where those of FAN tasks meet and are packed
again, until one group is left; its bins are all closed. What goes on is never cut short: packing
looks at how many pieces there are of each length, so a group's plan is small however many pieces
it places, and the pieces find their places by length and rank in a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import picked, written
from strata.llm.tokens import tokenizer

CAPACITY = 1024
END_ID = 2
NEARLY_FULL = 0.995  # share of the capacity from which a bin is closed at once
FAN = 8  # tasks whose underfull bins meet at the next level
CHUNK = 256  # ranks that a join key spans: so many pieces have one key at most

PIECES = "k long, piece int, start long, length long, crc long, part int, rank long"
# Where the pieces of ``child`` of one length and of ranks in [low, high) go. Rank r is number
# r - origin of a run of bins that take ``each`` pieces of the length: in closed ones it's placed,
# in open ones it has rank ``after`` + r - origin at the next level.
PLAN = (
    "part int, child int, length long, low long, high long, origin long, each long, "
    "open boolean, bin long, offset long, after long"
)


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a sequence of n ids: whole capacities, the first may be shorter."""
    if n <= capacity:
        return [n]
    head = n % capacity
    return [head] * (head > 0) + [capacity] * (n // capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, list[tuple[int, int, int, int]]]]:
    """Best fit of ``counts[size]`` items of each size, largest first: each goes to the fullest bin
    that still takes it.

    Gives runs of equal bins: their number, their load, and what they hold: (size, rank of the
    run's first item of that size, items a bin, offset). Bins of one free space are filled together:
    the fullest bin that takes an item is the one that has just taken its like, while there's room.
    ``mask`` has a bit for each free space that some bin has.
    """
    by_space: dict[int, list[tuple[int, list[tuple[int, int, int, int]]]]] = {}
    mask = 0

    def put(space: int, n: int, held: list[tuple[int, int, int, int]]) -> None:
        nonlocal mask
        by_space.setdefault(space, []).append((n, held))
        mask |= 1 << space

    for size in sorted(counts, reverse=True):
        first, left = 0, counts[size]
        while left:
            fitting = mask >> size
            if fitting:
                space = size + (fitting & -fitting).bit_length() - 1
                n, held = by_space[space].pop()
                if not by_space[space]:
                    mask &= ~(1 << space)
            else:
                space, n, held = capacity, left, []
            each = min(space // size, left)
            taken = min(n, left // each)
            if taken < n and held:
                put(space, n - taken, [(s, f + taken * e, e, o) for s, f, e, o in held])
            put(space - each * size, taken, [*held, (size, first, each, capacity - space)])
            first += taken * each
            left -= taken * each
    return [(n, capacity - space, held) for space, runs in by_space.items() for n, held in runs]


def _plan(level: int, capacity: int, last: bool):
    """The places of a group's pieces, from the counts of its children."""
    names = [field.split()[0] for field in PLAN.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(field.split()[0], kinds[field.split()[1]]) for field in PLAN.split(", ")])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        counts: dict[int, int] = {}
        children: dict[int, list[tuple[int, int, int]]] = {}
        for row in sorted(rows.select(["child", "length", "n"]).to_pylist(), key=lambda r: r["child"]):
            base = counts.get(row["length"], 0)
            counts[row["length"]] = base + row["n"]
            children.setdefault(row["length"], []).append((row["child"], base, base + row["n"]))
        out = []
        following = (level << 56) | (part << 32)
        going: dict[int, int] = {}
        for n, load, held in best_fit(counts, capacity):
            is_open = not last and load < NEARLY_FULL * capacity
            for length, first, each, offset in held:
                after = going.get(length, 0)
                for child, base, end in children[length]:
                    low, high = max(first, base) - base, min(first + n * each, end) - base
                    if low < high:
                        out.append((part, child, length, low, high, first - base, each, is_open, following, offset, after))
                if is_open:
                    going[length] = after + n * each
            following += n
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names=names)

    return run


def _pieces(path: str, space: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path, space).encode
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                keys = batch.column(0).slice(at, 1024)
                rows, columns = [], ([], [], [], [], [])
                for i, ids in enumerate(encode(batch.column(1).slice(at, 1024).to_pylist())):
                    ids += end
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        rows.append(i)
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        for column, value in zip(columns, (piece, start, length, crc, seen[length])):
                            column.append(value)
                        seen[length] += 1
                        start += length
                piece, start, length, crc, rank = columns
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array([part] * len(rows), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    names=["k", "piece", "start", "length", "crc", "part", "rank"],
                )

    return run


def _placed(items: DataFrame, plan: DataFrame) -> DataFrame:
    """The pieces that are still open with their place in the level's plan; placed ones as they are."""
    chunk = F.explode(F.sequence(F.expr(f"low div {CHUNK}"), F.expr(f"(high - 1) div {CHUNK}")))
    plan = plan.select(*(F.col(c).alias(f"p_{c}") for c in plan.columns), chunk.alias("p_chunk"))
    # A placed piece looks for length -1, which no plan has.
    wanted = F.when(F.col("open"), F.col("length")).otherwise(F.lit(-1))
    here = (
        (F.col("part") == F.col("p_child"))
        & (F.col("wanted") == F.col("p_length"))
        & (F.col("chunk") == F.col("p_chunk"))
        & (F.col("rank") >= F.col("p_low"))
        & (F.col("rank") < F.col("p_high"))
    )
    items = items.withColumns({"wanted": wanted, "chunk": F.expr(f"rank div {CHUNK}")})
    joined = items.join(plan, here, "left").withColumn("number", F.col("rank") - F.col("p_origin"))
    return joined.select(
        "k", "piece", "start", "length", "crc",
        F.coalesce("p_part", "part").alias("part"),
        F.coalesce(F.when(F.col("p_open"), F.col("p_after") + F.col("number")), "rank").alias("rank"),
        F.coalesce("p_open", "open").alias("open"),
        F.coalesce(F.expr("p_bin + number div p_each"), "bin").alias("bin"),
        F.coalesce(F.expr("p_offset + number % p_each * length"), "offset").alias("offset"),
    )


def pack(
    docs: DataFrame,
    path: str,
    space: str = "leads",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece of each row's ids: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset``.

    ``path`` is a tokenizers file, ``space`` how it treats spaces (see ``tokens``). A null or empty
    text is its end id alone. Only sequences longer than ``capacity`` are cut. Rows that repeat a
    key, and rows with a null key, are packed like others. Numbers of sequences have gaps.
    """
    texts = picked(docs, {"k": key, "t": text})
    pieces = written(texts.mapInArrow(_pieces(path, space, end_id, capacity), PIECES), "pieces")
    none = F.lit(None).cast("long")
    placed = pieces.withColumns({"open": F.lit(True), "bin": none, "offset": none})
    left = pieces.groupBy(F.col("part").alias("child"), "length").agg(F.count("*").alias("n"))
    parts = (pieces.agg(F.max("part")).first()[0] or 0) + 1
    level, group = 0, F.col("child")
    while True:
        run = _plan(level, capacity, last=parts == 1)
        plan = written(left.groupBy(group.cast("int").alias("group")).applyInArrow(run, PLAN), f"plan-{level}")
        placed = _placed(placed, plan)
        if parts == 1:
            break
        n = F.sum(F.col("high") - F.col("low")).alias("n")
        left = plan.filter("open").groupBy(F.col("part").alias("child"), "length").agg(n)
        level, parts, group = level + 1, -(-parts // FAN), F.floor(F.col("child") / FAN)
    return placed.select(
        F.col("k").alias(key), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("bin").alias("sequence_id"), "offset",
    )
