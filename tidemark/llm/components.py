"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.where("v > u").join(smallest, "u")
    return _oriented(joined.select(F.col("v").alias("a"), F.least("u", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(smallest, "hi")
    return _oriented(
        joined.select(F.col("lo").alias("a"), F.col("m").alias("b")).unionByName(
            smallest.select(F.col("hi").alias("a"), F.col("m").alias("b"))
        )
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node in ``edges`` (a long, b long); root is the smallest node reachable.

    Each round is two joins of the links with one minimum per node; the number of rounds grows
    with the logarithm of the longest chain. Every round is written to the shared folder, so a
    lost executor repeats one round at most. Loops and repeated links are ignored; no links give
    no rows.
    """
    edges = cut_lineage(_oriented(edges))
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    roots = edges.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
