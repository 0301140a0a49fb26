"""An index of vectors by their angles to pivots, which rules out pairs of blocks exactly.

Angles obey the triangle inequality, so the angles of a block's vectors to a pivot, and those of
another block's, say how near two vectors of these blocks can be: never nearer than the gap
between the two ranges, for any pivot.  Blocks whose gap is wider than the angle asked for never
meet.  Vectors are dealt to the nearest pivot, within it to shells by angle, and shells with many
rows (copies of one vector, say) are cut by a hash, so that no block is larger than wanted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import staged

#: Pivots at most, rows they are chosen from, shells of a pivot, blocks of a side at most.
PIVOTS, SAMPLE, SHELLS, BLOCKS = 64, 8192, 8, 1 << 15
#: Added to an angle bound for rounding.
SLACK = 1e-6


def unit(values: list) -> np.ndarray:
    """Rows of length 1; vectors of length 0 stay so."""
    m = np.array([np.asarray(v, np.float64) for v in values], np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True) if len(m) else np.zeros((0, 1))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def choose_pivots(vectors: DataFrame, rows: int, block: int, key: str) -> np.ndarray:
    """Directions of a hash sample of at most `SAMPLE` vectors, moved to the middles of those nearest."""
    share = max(1, rows // SAMPLE)
    some = vectors.filter(F.pmod(F.xxhash64(key), F.lit(share)) == 0).select("v").limit(SAMPLE).toArrow()
    m = unit(some.column(0).to_pylist())
    m = np.unique(m[np.linalg.norm(m, axis=1) > 0], axis=0) if len(m) else m
    n = min(PIVOTS, max(2, rows // (2 * block)), len(m))
    if not n:
        return np.zeros((0, 0))
    chosen, apart = [0], np.full(len(m), np.inf)
    while len(chosen) < n:  # each next one farthest from those before
        apart = np.minimum(apart, 1 - m @ m[chosen[-1]])
        chosen.append(int(apart.argmax()))
    pivots = m[chosen]
    for _ in range(5):
        near = (m @ pivots.T).argmax(axis=1)
        sums = np.stack([m[near == i].sum(axis=0) if (near == i).any() else p for i, p in enumerate(pivots)])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), pivots)
    return pivots


@dataclass(frozen=True)
class Side:
    rows: DataFrame  # key, v, block
    blocks: DataFrame  # block, low, high: ranges of the angles to each pivot


def index_side(vectors: DataFrame, key: str, pivots: np.ndarray, rows: int, block: int) -> Side:
    """Vectors (key, v) in blocks of about `block` rows; vectors of length 0 are in none."""
    block = max(block, -(-rows // BLOCKS))
    kind = vectors.schema[key].dataType.simpleString()

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = angles(unit(list(batch.v)), pivots)
            some = batch.v.map(lambda v: bool(np.any(np.asarray(v, float)))).to_numpy(bool)
            near = a.argmin(axis=1) if len(a) else np.zeros(0, int)
            out = pd.DataFrame({key: batch[key], "v": batch.v, "pivot": near, "angle": a[np.arange(len(a)), near]})
            yield out[some]

    placed = staged(
        vectors.select(key, "v").mapInPandas(dealt, f"{key} {kind}, v array<double>, pivot int, angle double"), "placed"
    )
    steps = F.array(*(F.lit((i + 1) / SHELLS) for i in range(SHELLS - 1)))
    edges = placed.groupBy("pivot").agg(F.percentile_approx("angle", steps, 1000).alias("edges"))
    shell = F.size(F.filter("edges", lambda e: e < F.col("angle")))
    shelled = placed.join(edges, "pivot").select(key, "v", "pivot", shell.alias("shell"))
    parts = shelled.groupBy("pivot", "shell").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    name = F.concat_ws("-", "pivot", "shell", F.pmod(F.xxhash64(key), F.col("parts")))
    held = staged(shelled.join(parts, ["pivot", "shell"]).select(key, "v", name.alias("block")), "blocks")

    def ranges(pdf: pd.DataFrame) -> pd.DataFrame:
        a = angles(unit(list(pdf.v)), pivots)
        return pd.DataFrame({"block": [pdf.block.iloc[0]], "low": [a.min(axis=0)], "high": [a.max(axis=0)]})

    return Side(
        held,
        staged(held.groupBy("block").applyInPandas(ranges, "block string, low array<double>, high array<double>"), "ranges")
    )


def meetings(left: Side, right: Side, widest: float, same: bool = False) -> DataFrame:
    """(block, other): blocks of the left and of the right that may hold two vectors within the angle
    `widest`; each pair once if both sides are the `same`.  The right's ranges go to the tasks: there are
    `BLOCKS` of them, of `PIVOTS` numbers, at most."""
    known = right.blocks.toArrow()
    names = np.array(known.column("block").to_pylist(), object)
    low, high = (np.array(known.column(c).to_pylist(), float) for c in ("low", "high"))
    sent = left.blocks.sparkSession.sparkContext.broadcast((names, low, high))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, low, high = sent.value
        for batch in batches:
            for block, lo, hi in zip(batch.block, batch.low, batch.high, strict=True):
                if not len(names):
                    continue
                gap = np.maximum(low - hi, lo - high).max(axis=1)
                near = (gap <= widest + SLACK) & ((names >= block) if same else True)
                yield pd.DataFrame({"block": block, "other": names[near]})

    return staged(left.blocks.mapInPandas(run, "block string, other string"), "meetings")


@dataclass(frozen=True)
class Plan:
    left: Side
    right: Side
    pairs: DataFrame

    def share(self) -> float:
        """Of all pairs of blocks, those that meet."""
        n, m = self.left.blocks.count(), self.right.blocks.count()
        possible = n * (n + 1) // 2 if self.left is self.right else n * m
        return self.pairs.count() / possible if possible else 0.0


def plan(left: DataFrame, right: DataFrame | None, least: float, block: int, keys: tuple[str, str]) -> Plan | None:
    """How vectors with a cosine of `least` (above 0) or more find each other; None where a side is empty.
    Without `right`, the left meets itself."""
    rows = left.count()
    others = rows if right is None else right.count()
    pivots = choose_pivots(left if right is None else right, others, block, keys[1])
    if not len(pivots) or not rows:
        return None
    one = index_side(left, keys[0], pivots, rows, block)
    other = one if right is None else index_side(right, keys[1], pivots, others, block)
    return Plan(one, other, meetings(one, other, float(np.arccos(min(1.0, least))), right is None))
