"""Shards by k-d tree partitioning (operator 5).

A node of the tree stands for some of the shards. It is split at the weighted quantile, along its
widest metadata dimension, that gives either half the bytes of its share of the shards. The cuts
are found exactly on the cluster: per level, histograms of the bytes over ever finer ranges of the
sort key; only bins reach the driver, BINS a node at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked, written

STEPS = 20  # bits of a coordinate
KEY_BITS = 63
BIN_BITS = 12
TOLERANCE = 0.001  # of a shard's bytes: a cut this near its target is taken


@dataclass
class Node:
    """Shards first .. first + shards - 1, and the search for its cut."""

    first: int
    shards: int
    dimension: int = 0
    target: float = 0.0
    below: float = 0.0  # bytes left of the range in question
    prefix: int = 0  # the range's leading bits
    cut: int | None = None


def _scaled(column: str, low, high):
    width = F.when(high > low, (high - low).cast("double"))
    share = (F.col(column).cast("double") - low.cast("double")) / width
    return F.coalesce(F.floor(share * ((1 << STEPS) - 1)), F.lit(0)).cast("long")


def _coordinates(rows: DataFrame, numbers: list[str], names: list[str]) -> DataFrame:
    """Adds ``at``: each dimension scaled to 0 .. 2^STEPS - 1 over the whole table; null is 0.

    Names are placed by their hash, so that equal ones stay together.
    """
    both = [x for c in numbers for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    ends = rows.agg(*both).first() if numbers else None
    parts = [_scaled(c, F.lit(ends[f"lo_{c}"]), F.lit(ends[f"hi_{c}"])) for c in numbers if ends[f"hi_{c}"] is not None]
    parts += [F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << STEPS))) for c in names]
    return rows.withColumn("at", F.array(*(p.cast("long") for p in parts or [F.lit(0)])))


def _with_nodes(rows: DataFrame, levels: list[list[Node]]) -> DataFrame:
    """Moves ``node``, the first shard of the row's node, down the levels.

    A level's cuts are a row for each split node, fewer than the shards: broadcast.
    """
    spark = rows.sparkSession
    out = rows
    for nodes in levels:
        cuts = [(n.first, n.dimension, n.cut, n.first + n.shards // 2) for n in nodes if n.shards > 1]
        table = spark.createDataFrame(cuts, "node int, dimension int, cut long, right int")
        out = out.join(F.broadcast(table), "node", "left")
        right = F.col("cut").isNotNull() & (_sort_key() >= F.col("cut"))
        out = out.withColumn("node", F.when(right, F.col("right")).otherwise(F.col("node"))).drop(*table.columns[1:])
    return out


def _sort_key():
    """The coordinate along the node's dimension; ties in the order of the tie bits."""
    tie = KEY_BITS - STEPS
    return F.shiftleft(F.get("at", F.col("dimension")), tie).bitwiseOR(F.col("tie"))


def _split(rows: DataFrame, levels: list[list[Node]], nodes: list[Node]) -> None:
    """Finds the cut of each node."""
    spark = rows.sparkSession
    here = _with_nodes(rows, levels)
    n_dims = rows.select(F.size("at")).first()
    widths = [(F.max(F.col("at")[d]) - F.min(F.col("at")[d])).alias(f"w{d}") for d in range(n_dims[0] if n_dims else 0)]
    found = {r["node"]: r for r in here.groupBy("node").agg(F.sum("size").alias("bytes"), *widths).collect()}
    for node in nodes:
        row = found.get(node.first)
        if row is None:
            node.cut = 0
            continue
        wide = [row[f"w{d}"] for d in range(len(widths))]
        node.dimension = wide.index(max(wide))
        node.target = row["bytes"] * (node.shards // 2) / node.shards
    shift = KEY_BITS
    while open_ := [n for n in nodes if n.cut is None]:
        bits = min(BIN_BITS, shift)
        shift -= bits
        asked = [(n.first, n.dimension, n.prefix) for n in open_]
        table = spark.createDataFrame(asked, "node int, dimension int, prefix long")
        keyed = here.join(F.broadcast(table), "node").withColumn("key", _sort_key())
        inside = keyed.filter(F.shiftright("key", shift + bits) == F.col("prefix"))
        bins = inside.groupBy("node", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("bytes"))
        by_node: dict[int, list] = {}
        for row in bins.collect():  # 2^BIN_BITS rows a node at most
            by_node.setdefault(row["node"], []).append((row["bin"], row["bytes"]))
        for node in open_:
            for number, weight in sorted(by_node[node.first]):
                if node.below + weight >= node.target:
                    break
                node.below += weight
            node.prefix = number
            after = node.below + weight
            near = min(node.target - node.below, after - node.target)
            if shift == 0 or near <= TOLERANCE * node.target / max(node.shards // 2, 1):
                upper = after - node.target < node.target - node.below
                node.cut = (number + upper) << shift


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """Turns ``node``, 0 in all rows, into ``shard``, for rows with ``size``, ``at`` and ``tie``.

    ``rows`` should be a written table: it is read often, and a stored node is a key to join on.
    """
    levels: list[list[Node]] = []
    nodes = [Node(0, shards)]
    while splitting := [n for n in nodes if n.shards > 1]:
        _split(rows, levels, splitting)
        levels.append(splitting)
        nodes = [
            half
            for n in splitting
            for half in (Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2))
        ]
    return _with_nodes(rows, levels).withColumnRenamed("node", "shard")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless in each shard by (key, text hash).

    Rows are sorted by shard over all tasks and numbered in their task; a shard's rows in one task
    are consecutive, so their count and first number, a row for each task and shard, give the rest.
    """
    order = ["shard", "k", "tie"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = sorted_.withColumn("id", F.monotonically_increasing_id())
    sorted_ = sorted_.withColumn("part", F.shiftright("id", 33)).drop("at")
    sorted_ = written(sorted_, "sharded")
    parts = sorted_.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # At most a row for each written task and one more for each shard.
    numbered = sorted_.join(F.broadcast(parts), ["shard", "part"])
    return numbered.withColumn("slot", F.col("id") - F.col("first_id") + F.col("before"))


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    numbers: tuple[str, ...] = ("doc_id", "n_chars"),
    names: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the text's UTF-8 bytes plus 8. Give the number of ``shards``, or ``target_bytes`` to
    split until shards have about so many. Dimensions are the columns ``numbers`` and ``names``;
    nulls stand at the low end. Rows that agree in a dimension are ordered by text, then key, so
    equal texts are cut apart only where a cut falls among them. Repeated rows with one key and
    text can't be cut apart. An empty table gives an empty result; with fewer rows than shards
    some shards are empty.
    """
    columns = {"k": key, "t": text} | {f"d{i}": c for i, c in enumerate((*numbers, *names))}
    number_columns = [f"d{i}" for i in range(len(numbers))]
    name_columns = [f"d{i}" for i in range(len(numbers), len(columns) - 2)]
    filled = F.coalesce("t", F.lit(""))
    low = KEY_BITS - STEPS - 22
    tie = F.shiftleft(F.pmod(F.xxhash64("t"), F.lit(1 << 22)), low).bitwiseOR(F.pmod(F.xxhash64("k"), F.lit(1 << low)))
    rows = picked(docs, columns).select(
        "k",
        (F.octet_length(filled) + 8).cast("long").alias("size"),
        F.crc32(filled).alias("text_crc32"),
        tie.alias("tie"),
        *number_columns,
        *name_columns,
    )
    rows = written(rows, "metadata")
    placed = _coordinates(rows, number_columns, name_columns).drop(*number_columns, *name_columns)
    placed = written(placed.withColumn("node", F.lit(0)), "placed")
    if shards is None:
        total = placed.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    out = _numbered(assign(placed, shards))
    return out.select(F.col("k").alias(key), "size", "text_crc32", "shard", "slot")
