"""Which nodes of an edge table hang together.

Star contraction: in each round all neighbours of a node, itself included, are hung on the
smallest of them, first the larger neighbours, then the smaller ones, until the edges no
longer change (a number of rounds that grows with the logarithm of the longest chain).
Rounds are written out, so plans stay short and a lost executor repeats one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import staged


def _hang_larger(edges: DataFrame) -> DataFrame:
    """Edges (hi, lo): every larger neighbour of a node goes to its smallest neighbour."""
    around = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).unionByName(
        edges.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
    )
    low = around.groupBy("x").agg(F.min("y").alias("low")).select("x", F.least("x", "low").alias("low"))
    return around.join(low, "x").filter("y > x").select(F.col("y").alias("hi"), F.col("low").alias("lo"))


def _hang_smaller(edges: DataFrame) -> DataFrame:
    """Edges (hi, lo): every smaller neighbour of a node, and the node, go to the smallest."""
    low = edges.groupBy("hi").agg(F.min("lo").alias("low"))
    moved = edges.join(low, "hi").filter("lo <> low").select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
    return moved.unionByName(low.select("hi", F.col("low").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the nodes of edges (a, b) and the smallest node each hangs together with."""
    now = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "edges"
    )
    before = None
    while True:
        now = staged(_hang_smaller(_hang_larger(now)), "edges")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(
        F.col("hi").alias("node"), F.col("lo").alias("component")
    ).unionByName(roots.select("node", F.col("node").alias("component")))
