"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a sparse vector x over the terms that the queries ask for, with the whole-number
weights x = (10^9 * tf) div (1000 * tf + 20 * m), m growing with its length; a query is the
vector w of its terms' rarity.  The score, their inner product, is a whole number.

Tasks take the vectors in shards of `SHARD` rows and grow a ball tree over each.  A ball holds
documents within a radius r of their centroid c, both measured with every term scaled by
sqrt(w).  With a = w / sqrt(w) on those of the query's terms that the ball has, no document of
the ball scores more than <a, c> + |a| * r (Cauchy-Schwarz).  Every query walks the tree best-first, from the ball with the
largest bound on, and stops where the bound is below the score of its `k`-th document so far;
a ball is split only when a query comes to it, so what no query can need is never built.  Bounds are
in floating point, rounded up by more than all rounding errors together (`SLACK`); the documents of
a leaf are scored in 64-bit whole numbers.  So the result is exact, but for equal 64-bit hashes
of different terms.

Queries are taken in blocks of at most `BLOCK_ITEMS` rows and about `BLOCK_TERMS` terms; only a
block's terms go to driver and workers.  A task gives at most k documents a query.  Before all rows, a
hash sample of about `SAMPLE` rows is searched: its k-th scores are lower bounds that prune from
the first ball on (they only prune: every row is searched).

Defined cases: null and empty texts, of documents or queries, have no terms and are in no result;
very long texts are taken whole; repeated documents are ranked one by one; repeated queries
are queries of their own, so their rows repeat; equal scores are ranked by id, null ids last; rows
that are equal in both are ranked in any order; an empty table of either kind gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import word_hashes
from .shared import quoted, small_batches, written

#: Bytes of terms: digits, ASCII letters and all beyond ASCII.
TERM = np.zeros(256, bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True
#: Rows and terms of a block of queries.
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 16
#: Documents of a tree, and of a leaf.
SHARD, LEAF = 8192, 12
#: Rows of the sample that gives the first lower bounds.
SAMPLE = 1 << 15
#: Share by which a bound is raised: sums of up to 2^17 positive terms err by 2^-35 of their size at most.
SLACK = 1e-9

VECTORS = "doc_id {ids}, n long, at array<int>, tf array<int>"


@dataclass(frozen=True)
class Block:
    """A block of queries: query i asks the terms terms[at[offsets[i]:offsets[i + 1]]]."""

    names: list[int]
    terms: np.ndarray  # sorted hashes
    at: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, list[int]]]) -> Block:
        flat = np.array([t for _, ts in rows for t in ts], np.int64).view(np.uint64)
        terms, at = np.unique(flat, return_inverse=True)
        return Block([q for q, _ in rows], terms, at, np.cumsum([0] + [len(ts) for _, ts in rows]))


def term_hashes(rows: DataFrame, text: str) -> DataFrame:
    """(q, terms): the distinct term hashes of each row that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, off in word_hashes(batch.column(1), TERM):
                found = [np.unique(hashes[off[i] : off[i + 1]]).view(np.int64) for i in range(last - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(found, pa.list_(pa.int64()))], ["q", "terms"]
                )

    return rows.select("q", quoted(text)).mapInArrow(run, "q long, terms array<long>").filter("size(terms) > 0")


def vectors(docs: DataFrame, terms: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, at, tf): number of terms of each text, places in `terms` (sorted hashes) of those it
    holds, and how often it holds them.  Texts without terms have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, off in word_hashes(batch.column(1), TERM):
                row = np.repeat(np.arange(last - first), np.diff(off))
                place = np.searchsorted(terms, hashes)
                place[place == len(terms)] = 0
                known = terms[place] == hashes
                pair, times = np.unique(row[known] * len(terms) + place[known], return_counts=True)
                begin = np.searchsorted(pair, np.arange(last - first + 1) * len(terms)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(begin, pa.array(v.astype(np.int32))) for v in (pair % len(terms), times)]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(off)), *lists], ["doc_id", "n", "at", "tf"]
                )
                yield out.filter(pa.array(np.diff(off) > 0))

    ids = docs.schema[doc_id].dataType.simpleString()
    return docs.select(quoted(doc_id), quoted(text)).mapInArrow(run, VECTORS.format(ids=ids))


@dataclass(frozen=True)
class Weights:
    """What all documents together say: their number, their terms, each asked term's weight."""

    n_docs: int
    n_terms: int
    rarity: np.ndarray

    @staticmethod
    def of(found: DataFrame, size: int) -> Weights:
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        rarity = np.full(size, math.floor(1000 * math.log(2 * n_docs + 2)), np.int64)
        for r in found.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # `size` rows at most
            rarity[r.at] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
        return Weights(n_docs, n_terms, rarity)

    def entries(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Ball:
    """Rows of a shard, the bound of each query, and, once a query has come here, its two parts
    or, in a leaf, the rows' weights."""

    def __init__(self, shard: Shard, rows: np.ndarray):
        self.rows, self.parts, self.table = rows, None, None
        where, row = shard.entries_of(rows)
        at, y = shard.at[where], shard.scaled[where]
        self.centre = np.bincount(at, y, minlength=len(shard.scale)) / len(rows)
        own = shard.square[rows]
        far = own - 2 * np.bincount(row, y * self.centre[at], minlength=len(rows)) + self.centre @ self.centre
        self.far = np.maximum(far, 0)
        radius = math.sqrt(max(float(far.max()), 0) + SLACK * float(own.max() + self.centre @ self.centre))
        q = shard.search
        middle = self.centre[q.block.at]
        reach = np.add.reduceat(q.root * middle, q.block.offsets[:-1])
        length = np.sqrt(np.add.reduceat(np.where(middle > 0, q.asked, 0), q.block.offsets[:-1]))
        self.bound = (reach + length * radius) * (1 + SLACK) + 1e-3


class Shard:
    """A ball tree over some vectors, grown where queries come."""

    def __init__(self, search: Search, ids: list, n: np.ndarray, at: np.ndarray, tf: np.ndarray, lengths: np.ndarray):
        self.search, self.ids, self.at = search, ids, at
        self.begin = np.concatenate(([0], np.cumsum(lengths)))
        self.x = search.weights.entries(tf.astype(np.int64), np.repeat(n, lengths))
        self.scale = np.sqrt(search.weights.rarity.astype(float))
        self.scaled = self.x * self.scale[at]
        self.square = np.bincount(np.repeat(np.arange(len(ids)), lengths), self.scaled**2, minlength=len(ids))
        self.top = Ball(self, np.arange(len(ids)))
        self.scored = 0

    def entries_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of the rows, and for each the place of its row in `rows`."""
        size = self.begin[rows + 1] - self.begin[rows]
        row = np.repeat(np.arange(len(rows)), size)
        return np.arange(len(row)) + (self.begin[rows] - np.concatenate(([0], np.cumsum(size)[:-1])))[row], row

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.scale))
        a, b = self.begin[row], self.begin[row + 1]
        out[self.at[a:b]] = self.scaled[a:b]
        return out

    def open(self, ball: Ball) -> list[Ball] | None:
        """The two parts of a ball; None for a leaf."""
        if ball.parts is None and ball.table is None:
            ball.parts = self._split(ball) if len(ball.rows) > LEAF else None
            ball.table = self._table(ball) if ball.parts is None else None
            ball.centre = ball.far = None
        return ball.parts

    def _split(self, ball: Ball) -> list[Ball] | None:
        """By nearness to two documents that are far apart; in the middle if that is uneven."""
        where, row = self.entries_of(ball.rows)
        y, at = self.scaled[where], self.at[where]
        onto = lambda v: np.bincount(row, y * v[at], minlength=len(ball.rows))
        one = self.dense(ball.rows[int(ball.far.argmax())])
        apart = self.square[ball.rows] - 2 * onto(one)
        other = self.dense(ball.rows[int(apart.argmax())])
        along = onto(one - other)
        side = along > (one @ one - other @ other) / 2
        if not len(side) // 16 < side.sum() < len(side) - len(side) // 16:
            side = along > np.median(along)
        if not side.any():  # as good as equal
            return None
        return [Ball(self, ball.rows[side]), Ball(self, ball.rows[~side])]

    def _table(self, ball: Ball) -> tuple[np.ndarray, np.ndarray]:
        """(column of each asked term, weights of the leaf's rows by column); column 0 is empty."""
        where, row = self.entries_of(ball.rows)
        held, column = np.unique(self.at[where], return_inverse=True)
        place = np.zeros(len(self.scale), np.int32)
        place[held] = np.arange(1, len(held) + 1)
        table = np.zeros((len(held) + 1, len(ball.rows)), np.int64)
        table[column + 1, row] = self.x[where]
        return place, table

    def walk(self, i: int) -> None:
        """Query i, best-first."""
        q = self.search
        a, b = q.block.offsets[i], q.block.offsets[i + 1]
        at, w = q.block.at[a:b], q.asked[a:b]
        waiting, number = [(-self.top.bound[i], 0, self.top)], 0
        while waiting:
            bound, _, ball = heapq.heappop(waiting)
            if -bound < q.least(i):
                break
            parts = self.open(ball)
            if parts is None:
                place, table = ball.table
                self.scored += len(ball.rows)
                q.take(i, w @ table[place[at]], ball.rows, self.ids)
            else:
                for part in parts:
                    number += 1
                    heapq.heappush(waiting, (-part.bound[i], number, part))


class Search:
    """The best documents so far of each query of a block."""

    def __init__(self, block: Block, weights: Weights, k: int, floor: np.ndarray | None = None):
        self.block, self.weights, self.k = block, weights, k
        self.asked = weights.rarity[block.at]
        self.root = np.sqrt(self.asked.astype(float))
        self.floor = np.ones(len(block.names), np.int64) if floor is None else np.maximum(floor, 1)
        self.best: list[list[tuple]] = [[] for _ in block.names]  # heaps of (score, -id, id)
        self.rows = self.scored = 0

    def least(self, i: int) -> int:
        """A score below this is of no use to query i."""
        heap = self.best[i]
        return max(int(self.floor[i]), heap[0][0]) if len(heap) == self.k else int(self.floor[i])

    def take(self, i: int, scores: np.ndarray, rows: np.ndarray, ids: list) -> None:
        heap = self.best[i]
        for j in np.flatnonzero(scores >= self.least(i)):
            d = ids[rows[j]]
            new = (int(scores[j]), -d if d is not None else -(1 << 64), d)
            if len(heap) < self.k:
                heapq.heappush(heap, new)
            elif new > heap[0]:
                heapq.heapreplace(heap, new)

    def add(self, batches: Iterator[pa.RecordBatch]) -> None:
        """Searches all vectors of the batches, a shard at a time."""
        held, count = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, SHARD):
                held.append(batch.slice(lo, SHARD))
                count += held[-1].num_rows
                if count >= SHARD:
                    self._search(held)
                    held, count = [], 0
        if count:
            self._search(held)

    def _search(self, held: list[pa.RecordBatch]) -> None:
        at = [b.column(2) for b in held]
        flat = lambda lists: np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])
        shard = Shard(
            self, [d for b in held for d in b.column(0).to_pylist()],
            np.concatenate([b.column(1).to_numpy() for b in held]), flat(at), flat([b.column(3) for b in held]),
            np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in at])
        )
        for i in range(len(self.block.names)):
            shard.walk(i)
        self.rows += len(shard.ids)
        self.scored += shard.scored


def _best(
    found: DataFrame, rows: int, block: Block, weights: Weights, k: int, floor: np.ndarray | None
) -> DataFrame:
    """(q, doc_id, score) of about `rows` vectors: at most k documents a query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block, weights, k, floor)
        search.add(batches)
        for name, heap in zip(block.names, search.best, strict=True):
            if heap:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(heap), pa.int64()), pa.array([d for _, _, d in heap], ids),
                        pa.array([s for s, _, _ in heap], pa.int64())
                    ],
                    ["q", "doc_id", "score"]
                )

    kind = found.schema["doc_id"].dataType.simpleString()
    # a shard costs far more than its bytes tell, so the number of tasks follows the rows
    dealt = found.filter("size(at) > 0").repartition(-(-rows // (2 * SHARD)) or 1, F.xxhash64("doc_id", "n", "at"))
    ids = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}[kind]
    return dealt.mapInArrow(run, f"q long, doc_id {kind}, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, queries: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k documents of whole-number ids with the highest scores
    above 0 for each row of `queries`."""
    small_batches(docs.sparkSession)
    numbered = written(
        queries.select(
            F.monotonically_increasing_id().alias("q"), quoted(item_id).alias("item_id"), quoted(item_text).alias("body")
        ),
        "queries"
    )
    asked = written(term_hashes(numbered, "body"), "asked")
    rows, terms = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    parts = max(1, -(-rows // BLOCK_ITEMS), -(-terms // BLOCK_TERMS))
    found = []
    for part in range(parts):
        mine = asked.filter(F.pmod(F.xxhash64("q"), F.lit(parts)) == part).orderBy("q").collect()  # bounded by the block
        if mine:
            found.append(_searched(docs, Block.of([(r.q, r.terms) for r in mine]), k, doc_id, text))
    if not found:
        kind = docs.schema[doc_id].dataType.simpleString()
        return numbered.limit(0).selectExpr("item_id", "1 AS rank", f"CAST(NULL AS {kind}) AS doc_id", "0L AS score")
    best = reduce(DataFrame.unionByName, found)
    return best.join(numbered.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def _searched(docs: DataFrame, block: Block, k: int, doc_id: str, text: str) -> DataFrame:
    held = written(vectors(docs, block.terms, doc_id, text), "vectors")
    weights = Weights.of(held, len(block.terms))
    floor = None
    if weights.n_docs > 2 * SAMPLE:
        some = held.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(weights.n_docs // SAMPLE)) == 0)
        least = {
            r.q: r.score for r in _ranked(_best(some, SAMPLE, block, weights, k, None), k).filter(F.col("rank") == k).collect()
        }
        floor = np.array([least.get(q, 1) for q in block.names], np.int64)
    return _ranked(_best(held, weights.n_docs, block, weights, k, floor), k)
