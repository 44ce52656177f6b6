"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import discard, merged, written

_ROUNDS = 60


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Each round moves every link once towards smaller nodes, over joins by node whose
    hot keys Spark splits, writes what remains to the shared folder and deletes the round before. Nothing of
    the graph reaches the driver but a count and a checksum per round. The number
    of rounds grows with the logarithm of a component's size.
    """
    now, place = written(_ordered(links), name)
    seen = _mark(now)
    for _ in range(_ROUNDS):
        before = place
        now, place = written(_small_star(_large_star(now)), name)
        discard(now.sparkSession, before)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"links still move after {_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(merged(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(merged(least), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
