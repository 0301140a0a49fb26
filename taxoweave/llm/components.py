"""Connected components of an edge table by large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): every node's
larger, then smaller neighbours are linked to its smallest one until nothing changes.
Each round writes its edges to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .shared import written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (a, b) with a > b."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of `edges` (a, b: long) with the smallest node it
    is connected to, itself included.  Nulls and loops: an edge with a null is dropped;
    a node with only a loop is its own component."""
    edges = edges.select(
        F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")
    ).filter("a IS NOT NULL AND b IS NOT NULL")
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    loops, now = edges.filter("a = b").select("a"), edges.filter("a <> b")
    seen = None
    for _ in range(max_rounds):
        # a number and a checksum of the edges, taken while they are written
        after = Observation()
        now = written(
            _stars(_stars(now, True), False).observe(
                after, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")
            ),
            "edges"
        )
        if after.get == seen:
            break
        seen = after.get
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).unionByName(
        loops.select(F.col("a").alias("node"), F.col("a").alias("component"))
    ).groupBy("node").agg(F.min("component").alias("component"))
