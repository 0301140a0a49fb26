"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Tokens are maximal runs of letters and digits (all bytes beyond ASCII are letters) or of other
visible characters, with their case.  Token types share `BUCKETS` hashed places.  In random indexing
(Kanerva, Kristofersson and Holst 2000) every place has a fixed sparse vector of a few +1 and -1; the
word vector of a place is the sum of the sparse vectors of the tokens beside its occurrences, at most
`WINDOW` apart, over all texts.  Spark adds these whole-number sums by blocks of places, so their size
(BUCKETS x SIZE) does not grow with the corpus.  What a word's neighbours have in common with all
words' neighbours is then taken off, and vectors are brought to length 1.

A text is pooled to the mean and the spread of its words' vectors, frequent words counting less,
and the logarithm of its number of tokens.  A network of two layers, trained by gradient steps on a
hash sample of at most `max_train` distinct labelled texts of each class (documented bound;
copies count as often as they occur), gives a log-odds; a fifth of the sample, kept apart, chooses
the temperature by which it is divided, so scores are calibrated probabilities.

Defined cases: null and empty texts have no tokens and are scored by that; very long texts are taken
whole (in pieces of 1 MB, at whose ends a token is cut); rows whose label is neither 0 nor 1 are not
learned from; repeated rows train with their count and are scored one by one; with labels
of one class, or none (empty tables included), every text gets that class's share, smoothed (0.5
where there are no labels); columns named like the added one keep their names, the added one gets
underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import _POW, _UNPOW, CHUNK, mix, string_buffers
from .shared import fresh, quoted, small_batches

#: Places of token types, numbers of a word vector, entries of a sparse vector that are not 0.
BUCKETS, SIZE, ENTRIES = 1 << 14, 64, 4
#: Tokens at most so far apart are neighbours.
WINDOW = 2
#: Places whose sums travel together, and tokens whose neighbours are added at once.
ROWS, FLUSH = 64, 1 << 20
#: Share of all tokens from which on a word counts less than half.
COMMON = 1e-3
HIDDEN = 32

#: 0: space and control characters, 1: letters and digits, 2: other visible characters.
KIND = np.full(256, 2, np.uint8)
KIND[:33] = KIND[127] = 0
KIND[0x30:0x3A] = KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:] = 1


def sparse_vectors(buckets: int = BUCKETS, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the entries of each bucket's sparse vector: equal on every machine."""
    seed = np.arange(1, buckets + 1, dtype=np.uint64)[:, None] * np.uint64(ENTRIES) + np.arange(ENTRIES, dtype=np.uint64)
    drawn = mix(mix(seed) + np.uint64(1))
    return (drawn % np.uint64(size)).astype(np.int64), np.where((drawn >> np.uint64(40)) & np.uint64(1), 1, -1)


def token_buckets(texts: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of each token, in order, for a few whole texts or a piece of a long one at a time."""
    off, data = string_buffers(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, "right")) - 1)
        for a in range(int(off[lo]), int(off[hi]), CHUNK):
            b = min(int(off[hi]), a + CHUNK)
            piece = data[a:b]
            kind = KIND[piece]
            begins = np.ones(b - a, bool)
            begins[1:] = kind[1:] != kind[:-1]
            inner = off[lo:hi]
            begins[inner[(inner >= a) & (inner < b)] - a] = True
            start = np.flatnonzero(begins)
            end = np.append(start[1:], b - a)
            visible = kind[start] > 0
            start, end = start[visible], end[visible]
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * _POW[: b - a], out=total[1:])
            hashes = mix((total[end] - total[start]) * _UNPOW[start] + (end - start).astype(np.uint64))
            yield np.searchsorted(off, a + start, "right") - 1, (hashes % np.uint64(buckets)).astype(np.int64)
        lo = hi


def neighbour_sums(row: np.ndarray, bucket: np.ndarray, buckets: int, size: int) -> np.ndarray:
    """The sums of the sparse vectors of the neighbours of each bucket's tokens."""
    place, sign = sparse_vectors(buckets, size)
    out = np.zeros(buckets * size)
    for apart in range(1, WINDOW + 1):
        together = row[apart:] == row[:-apart]
        left, right = bucket[:-apart][together], bucket[apart:][together]
        for at, beside in ((left, right), (right, left)):
            for e in range(ENTRIES):
                out += np.bincount(at * size + place[beside, e], sign[beside, e], minlength=buckets * size)
    return out.reshape(buckets, size)


@dataclass(frozen=True)
class WordVectors:
    vectors: np.ndarray  # buckets x size, of length 1 or 0
    weight: np.ndarray

    def pooled(self, texts: pa.Array) -> np.ndarray:
        """One row a text: mean and spread of its word vectors, logarithm of 1 + its tokens."""
        m, size = len(texts), self.vectors.shape[1]
        total, square, mass, count = np.zeros((m, size)), np.zeros((m, size)), np.zeros(m), np.zeros(m)
        for row, bucket in token_buckets(texts, len(self.weight)):
            if not len(row):
                continue
            begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            at, w = row[begin], self.weight[bucket]
            v = self.vectors[bucket]
            part = v * w[:, None]
            total[at] += np.add.reduceat(part, begin)
            part *= v
            square[at] += np.add.reduceat(part, begin)
            mass[at] += np.add.reduceat(w, begin)
            count[at] += np.diff(np.append(begin, len(row)))
        mass = np.maximum(mass, 1e-12)[:, None]
        mean = total / mass
        return np.concatenate((mean, np.sqrt(np.maximum(square / mass - mean**2, 0)), np.log1p(count)[:, None]), axis=1)


def word_vectors(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, size: int = SIZE) -> WordVectors:
    """Random-indexing vectors from all rows of `docs`."""
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, count, next_row = np.zeros((buckets, size + 1)), [], 0, 0

        def flush() -> None:
            row, bucket = (np.concatenate(x) for x in zip(*held, strict=True))
            total[:, :size] += neighbour_sums(row, bucket, buckets, size)
            total[:, size] += np.bincount(bucket, minlength=buckets)

        for batch in batches:
            for row, bucket in token_buckets(batch.column(0), buckets):
                held.append((row + next_row, bucket))
                count += len(row)
                if count >= FLUSH:  # pieces of a text that are added apart are no neighbours
                    flush()
                    held, count = [], 0
            next_row += batch.num_rows
        if count:
            flush()
        blocks = total.reshape(-1, ROWS * (size + 1))
        some = np.flatnonzero(np.abs(blocks).sum(axis=1))
        if len(some):
            yield pa.RecordBatch.from_pydict(
                {"block": some.astype(np.int32), "sums": [blocks[i].astype(np.int64) for i in some]}
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            table = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            for i, v in zip(batch.column(0).to_pylist(), table, strict=True):
                sums[i] = sums[i] + v if i in sums else v.copy()
        for i, v in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()), "sums": [v]})

    kind = "block int, sums array<long>"
    parts = docs.select(quoted(text)).mapInArrow(counted, kind).repartition(32, "block")
    table = np.zeros((buckets // ROWS, ROWS * (size + 1)))
    for r in parts.mapInArrow(added, kind).collect():  # buckets / ROWS rows
        table[r.block] = r.sums
    table = table.reshape(buckets, size + 1)
    n = table[:, size]
    all_ = max(n.sum(), 1.0)
    mean = table[:, :size] / np.maximum(n, 1)[:, None] - table[:, :size].sum(axis=0) / all_
    length = np.linalg.norm(mean, axis=1, keepdims=True)
    vectors = np.where((length > 1e-9) & (n[:, None] > 0), mean / np.maximum(length, 1e-9), 0.0)
    return WordVectors(vectors.astype(np.float32), COMMON / (COMMON + n / all_))


@dataclass
class Network:
    """Standardised inputs, a hidden layer (tanh), one log-odds."""

    middle: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.layers
        hidden = np.tanh(x @ w1 + b1)
        return hidden, hidden @ w2 + b2[0]

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float) -> list[np.ndarray]:
        """Of the weighted mean cross entropy, with `decay` on the weights."""
        w1, _, w2, _ = self.layers
        hidden, z = self.forward(x)
        dz = weight * (sigmoid(z) - y) / weight.sum()
        back = np.outer(dz, w2) * (1 - hidden**2)
        return [x.T @ back + decay * w1, back.sum(axis=0), hidden.T @ dz + decay * w2, np.array([dz.sum()])]

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        return self.forward((features - self.middle) / self.spread)[1]

    def probability(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(self.log_odds(features) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def cross_entropy(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum())


def best_temperature(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the log-odds with the least cross entropy, by golden section over its logarithm."""
    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    at = lambda t: cross_entropy(z / np.exp(t), y, weight)
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if at(a) <= at(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train_network(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = HIDDEN, epochs: int = 40, rate: float = 3e-3,
    decay: float = 1e-4, seed: int = 11
) -> Network:
    """Trains on four fifths of the rows, in a drawn order; the rest chooses the temperature."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    kept, rows = order[: len(y) // 5], order[len(y) // 5 :]
    middle = x[rows].mean(axis=0)
    spread = np.maximum(x[rows].std(axis=0), 1e-6)
    start = [
        rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
        rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)
    ]
    net = Network(middle, spread, start)
    inputs = (x - middle) / spread
    first, second, step = [np.zeros_like(p) for p in start], [np.zeros_like(p) for p in start], 0
    for _ in range(epochs):
        turn = rng.permutation(rows)
        for a in range(0, len(turn), 256):
            some = turn[a : a + 256]
            step += 1
            for p, g, m, v in zip(
                net.layers, net.gradients(inputs[some], y[some], weight[some], decay), first, second, strict=True
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if len(set(y[kept])) == 2:
        net.temperature = best_temperature(net.log_odds(x[kept]), y[kept], weight[kept])
    return net


@dataclass(frozen=True)
class QualityModel:
    words: WordVectors
    network: Network | None
    share: float  # of good texts among the labelled

    def probability(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        return self.network.probability(self.words.pooled(texts))


def fit(
    words: WordVectors, labelled: DataFrame, text: str = "text", label: str = "quality", max_train: int = 20_000
) -> QualityModel:
    """Trains the network on rows of `labelled` whose label is 0 or 1."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(
        F.coalesce(quoted(text), F.lit("")).alias("text"), quoted(label).cast("int").alias("y")
    ).filter("y IN (0, 1)")
    n = {0: 0, 1: 0} | {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    share = (n[1] + 0.5) / (n[0] + n[1] + 1)
    if not n[0] or not n[1]:
        return QualityModel(words, None, share)
    # equal texts have one hash: the sample is of distinct texts, with the number of their copies
    drawn = (F.xxhash64("text", "y").bitwiseAND((1 << 63) - 1) / float(1 << 63)).alias("drawn")
    limit = F.when(F.col("y") == 1, F.lit(max_train / n[1])).otherwise(max_train / n[0])
    texts = rows.select("text", "y", drawn).filter(F.col("drawn") < limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = words.pooled(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
                ["y", "drawn", "x"]
            )

    distinct = texts.mapInArrow(run, "y int, drawn double, x array<float>").groupBy("y", "drawn").agg(
        F.first("x").alias("x"), F.count(F.lit(1)).cast("double").alias("copies")
    )
    y, x, weight = [], [], []
    for value in (0, 1):
        taken = distinct.filter(F.col("y") == value).orderBy("drawn").limit(max_train).toArrow()
        if not len(taken):
            return QualityModel(words, None, share)
        copies = taken.column("copies").to_numpy()
        y.append(np.full(len(taken), float(value)))
        x.append(taken.column("x").combine_chunks().flatten().to_numpy().reshape(len(taken), -1).astype(float))
        weight.append(copies * n[value] / copies.sum())
    y, x, weight = np.concatenate(y), np.concatenate(x), np.concatenate(weight)
    return QualityModel(words, train_network(x, y, weight / weight.mean()), share)


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Adds quality_score: the probability of label 1."""
    small_batches(docs.sparkSession)
    (name,) = fresh(docs, "quality_score")

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.probability(texts))

    return docs.withColumn(name, run(F.coalesce(quoted(text), F.lit(""))))
