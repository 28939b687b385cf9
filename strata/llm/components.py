"""Connected components of a table of links, each named by its smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """Per node that has a link: ``node`` and ``root``, the smallest node it is connected with.

    ``edges`` has the columns ``a`` and ``b``; nulls, loops and repeats don't count. Large-star and
    small-star rounds turn each component into a star: every round joins each link with the
    smallest neighbour of one end, written once; the number of rounds grows with the logarithm of
    the component's size. A hub's links are a skewed join side that Spark can split.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        # Large star: neighbours greater than the node point to the node's smallest neighbour.
        both = _both_ways(edges)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edges = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = written(edges, "links-large")
        # Small star: the node and its smaller neighbours point to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a")
        edges = (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges = written(edges, "links-small")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
