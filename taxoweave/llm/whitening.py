"""Whitening of vectors along their leading principal components.

The components are eigenvectors of the covariance of the distinct vectors, found by a block
Jacobi-Davidson iteration (Sleijpen and van der Vorst 1996) that never forms the matrix: the
only thing asked of the data is the product of the centred covariance with a few vectors at a
time, one Spark job in which tasks send d x b sums.  Each round takes Ritz pairs from the
subspace, locks the leading ones whose residual has reached double precision, and widens the
subspace by approximate solutions of the projected correction equations, which an inner MINRES
finds for all open pairs in step, so that one job serves them all.  The subspace is restarted
from its best Ritz vectors when it is full.

Vectors are taken in fixed point: an entry c becomes floor(scale * c) + offset, a whole number.
Sums are whole numbers too; a vector is centred by the whole part of the mean first, which is
exact, and then by the rest, so entries lose no digits to a large offset.

Defined cases: null and empty vectors, and vectors that hold a null, a NaN or an infinity, have
no rows; nor have vectors of another length than most (of equally many lengths the longest);
repeated vectors count once in the covariance and each have their rows; null ids are kept; where
an eigenvalue is repeated any basis of its space is taken; directions without variance (relative
to the first, below rounding) are no components, so one distinct vector, or an empty table, gives
no rows; entries of 2^40 or more in fixed point are an error; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import quoted, small_batches, written

EPS = float(np.finfo(float).eps)
#: Entries in fixed point are below this.
LIMIT = 1 << 40
#: Products of a correction equation's MINRES in a round.
INNER = 8


@dataclass(frozen=True)
class Centre:
    """The mean of n whole-number vectors with sums `sums`: `whole` + `rest`."""

    n: int
    sums: list[int]
    whole: np.ndarray
    rest: np.ndarray
    reach: int  # no entry is farther from `whole`

    @staticmethod
    def of(n: int, sums: list[int], low: list[int], high: list[int]) -> Centre:
        whole = [s // n for s in sums]
        rest = np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)])
        reach = max((max(h - w, w - lo) for w, lo, h in zip(whole, low, high, strict=True)), default=0)
        return Centre(n, sums, np.array(whole, np.int64), rest, reach)

    def whole_part(self, lists: pa.ListArray) -> np.ndarray:
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(self.whole)) - self.whole

    def __call__(self, lists: pa.ListArray) -> np.ndarray:
        """The vectors less the mean, one a row."""
        return self.whole_part(lists) - self.rest

    @property
    def narrow(self) -> bool:
        """Whether every deviation fits into 64 bits."""
        return len(self.whole) * (self.n * (self.reach + 1)) ** 2 < 1 << 63

    def deviation(self, lists: pa.ListArray) -> pa.Array:
        """Exact sums over the dimensions of (n * x - sums)^2."""
        kind = np.int64 if self.narrow else object
        left = np.array([s - self.n * int(w) for s, w in zip(self.sums, self.whole, strict=True)], kind)
        apart = self.whole_part(lists).astype(kind) * self.n - left
        total = (apart * apart).sum(axis=1)
        if self.narrow:
            return pa.array(total)
        return pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0))


@dataclass(frozen=True)
class WhiteningModel:
    centre: Centre
    components: np.ndarray  # d x k
    values: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def project(self, lists: pa.ListArray) -> np.ndarray:
        return self.centre(lists) @ self.components / np.sqrt(self.values)


def fixed_point(rows: DataFrame, vector: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> Column:
    """The vector in whole numbers; null for one that is not used."""
    v = quoted(vector)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    return F.when(usable, F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long") + offset))


def points(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", **kind) -> DataFrame:
    """(vec_id, x) of the rows whose vector is used."""
    out = rows.select(quoted(vec_id).alias("vec_id"), fixed_point(rows, vector, **kind).alias("x")).filter("x IS NOT NULL")
    most = out.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return out.filter(F.size("x") == (most.d if most else 0))


def _summed(rows: DataFrame, partial: Callable[[Iterator[pa.Array]], np.ndarray]) -> np.ndarray:
    """The sum over all tasks of `partial` of their vectors.  Values are added by slot in Spark,
    so the driver gets one array however many tasks there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = partial(b.column(0) for b in batches if b.num_rows)
        if out is not None:
            yield pa.RecordBatch.from_pydict({"slot": np.arange(len(out), dtype=np.int32), "v": out})

    added = rows.mapInArrow(run, "slot int, v double").groupBy("slot").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(len(added))
    for r in added:
        total[r.slot] = r.v
    return total


def centre_of(fitted: DataFrame) -> Centre | None:
    """Count, sums and ranges of the vectors `x` of `fitted`, exact."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if np.abs(x).max() >= LIMIT:
                raise ValueError("an entry in fixed point is 2^40 or more")
            s = x.sum(axis=0).astype(object)
            n += len(x)
            total = s if total is None else total + s
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            d = len(low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)),
                    pa.array([Decimal(s) for s in total], pa.decimal128(28, 0)), pa.array(low), pa.array(high)
                ],
                ["i", "n", "s", "low", "high"]
            )

    found = fitted.mapInArrow(partial, "i int, n long, s decimal(28,0), low long, high long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")
    ).orderBy("i").collect()
    if not found:
        return None
    return Centre.of(found[0].n, [int(r.s) for r in found], [r.low for r in found], [r.high for r in found])


def minres(
    apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float
) -> np.ndarray:
    """Least-residual solutions of symmetric systems, one a column, in step: `apply` takes all columns."""
    norm = lambda a: np.sqrt((a * a).sum(axis=0))
    safe = lambda a: np.where(a == 0, 1.0, a)
    beta = norm(right)
    first, v, before = beta.copy(), right / safe(beta), np.zeros_like(right)
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, cos, cos_before, sin, sin_before = beta.copy(), 1.0, 1.0, 0.0, 0.0
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * before
        following = norm(image)
        delta = cos * alpha - cos_before * sin * beta
        r1 = np.sqrt(delta**2 + following**2)
        r2, r3 = sin * alpha + cos_before * cos * beta, sin_before * beta
        open_ = r1 > 0
        w, w_before = np.where(open_, (v - r3 * w_before - r2 * w) / safe(r1), 0.0), w
        cos_before, cos, sin_before, sin = cos, delta / safe(r1), sin, following / safe(r1)
        x = x + np.where(open_, cos * eta * w, 0.0)
        eta = -sin * eta
        before, v, beta = v, image / safe(following), following
        if (np.abs(eta) <= tolerance * first).all():
            break
    return x


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the orthonormal columns `against`."""
    kept = []
    for column in block.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            for q in ([against] if against.shape[1] else []) + ([np.stack(kept, axis=1)] if kept else []):
                column = column - q @ (q.T @ column)
        left = np.linalg.norm(column)
        if size and left > 1e-8 * size:
            column = column / left
            for q in ([against] if against.shape[1] else []) + ([np.stack(kept, axis=1)] if kept else []):
                column = column - q @ (q.T @ column)
            kept.append(column / np.linalg.norm(column))
    return np.stack(kept, axis=1) if kept else np.zeros((len(block), 0))


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], d: int, k: int, spare: int = 4, widest: int | None = None,
    rounds: int = 200, seed: int = 13
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the k largest eigenpairs of a symmetric operator of
    size d that is known only by its `product` with a block of columns."""
    k = min(d, k)
    widest = min(d, widest or 4 * (k + spare))
    rng = np.random.default_rng(seed)
    locked, values, norms = np.zeros((d, 0)), np.zeros(0), np.zeros(0)
    basis = _orthonormal(rng.standard_normal((d, min(d, k + spare))), locked)
    image = product(basis)
    best = np.inf
    for turn in range(rounds):
        small = basis.T @ image
        theta, turned = np.linalg.eigh((small + small.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned  # Ritz vectors, the largest first
        want = min(k - len(values), len(theta))
        residual = image[:, :want] - basis[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.sqrt((residual**2).sum(axis=0))
        scale = max(float(np.max(np.abs(values), initial=0)), float(np.max(np.abs(theta), initial=0)))
        whole = locked.shape[1] + basis.shape[1] == d  # nothing is outside: only rounding is left
        done = size <= (64 * d if whole else 4 * d) * EPS * scale
        ready = int(np.argmin(done)) if not done.all() else want
        if ready:
            locked = np.concatenate((locked, basis[:, :ready]), axis=1)
            values, norms = np.append(values, theta[:ready]), np.append(norms, size[:ready])
            basis, image, theta = basis[:, ready:], image[:, ready:], theta[ready:]
            residual, size = residual[:, ready:], size[ready:]
            want, best = want - ready, np.inf
        if len(values) == k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], norms[order]
        if whole:  # products of combined columns have lost digits: take them anew
            if size.max() >= best:
                raise ArithmeticError(f"residuals stay at {size.max()} of {scale}")
            best = size.max()
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        if basis.shape[1] + locked.shape[1] + want > widest + locked.shape[1]:
            keep = min(basis.shape[1], want + spare)
            basis, image = basis[:, :keep], image[:, :keep]
        near = np.concatenate((locked, basis[:, :want]), axis=1)
        off = lambda a, q=near: a - q @ (q.T @ a)
        shift = theta[:want]
        step = minres(
            lambda z, f=off, s=shift: f(product(f(z)) - f(z) * s), off(-residual), INNER, 0.5 ** (turn + 1)
        )
        added = _orthonormal(step, np.concatenate((locked, basis), axis=1))
        if not added.shape[1]:  # corrections tell nothing new: look elsewhere
            added = _orthonormal(rng.standard_normal((d, want)), np.concatenate((locked, basis), axis=1))
        added = added[:, : d - locked.shape[1] - basis.shape[1]]
        basis, image = np.concatenate((basis, added), axis=1), np.concatenate((image, product(added)), axis=1)
    raise ArithmeticError(f"no convergence in {rounds} rounds")


def fit(used: DataFrame, k: int = 16) -> WhiteningModel | None:
    """Components of the distinct vectors `x` of `used` (as `points` gives them); None where there are none."""
    small_batches(used.sparkSession, rows=4096)
    fitted = written(used.select("x").distinct(), "vectors")
    centre = centre_of(fitted)
    if centre is None:
        return None
    d, n = len(centre.whole), centre.n

    def product(block: np.ndarray) -> np.ndarray:
        def partial(lists: Iterator[pa.Array]) -> np.ndarray | None:
            out = None
            for x in lists:
                y = centre(x)
                part = y.T @ (y @ block)
                out = part if out is None else out + part
            return None if out is None else out.reshape(-1)

        return _summed(fitted, partial).reshape(block.shape) / n

    def spread(lists: Iterator[pa.Array]) -> np.ndarray:
        return np.array([sum(float((centre(x) ** 2).sum()) for x in lists)])

    trace = float(_summed(fitted, spread)[0]) / n
    if not trace:
        return None
    values, vectors, norms = jacobi_davidson(product, d, k)
    real = values > d * EPS * values[0]
    values, vectors, norms = values[real], vectors[:, real], norms[real]

    def squares(lists: Iterator[pa.Array]) -> np.ndarray | None:
        out = None
        for x in lists:
            z = centre(x) @ vectors / np.sqrt(values)
            out = z.T @ z if out is None else out + z.T @ z
        return None if out is None else out.reshape(-1)

    covariance = _summed(fitted, squares).reshape(len(values), len(values)) / n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return WhiteningModel(centre, vectors, values, trace, error, norms)


def transform(used: DataFrame, model: WhiteningModel | None) -> DataFrame:
    """One row for each row of `used` and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error.  `deviation` is a bigint where all fit, else a decimal."""
    small_batches(used.sparkSession, rows=4096)
    kind = "decimal(38,0)" if model and not model.centre.narrow else "bigint"
    ids = used.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {ids}, component int, n long, deviation {kind}, whitened double, explained double, identity_error double"
    )
    if model is None:
        return used.sparkSession.createDataFrame([], schema)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, lists = batch.num_rows, batch.column(1)
            if not m:
                continue
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.centre.n)), model.centre.deviation(lists).take(each),
                    pa.array(model.project(lists).reshape(-1)), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error))
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            )

    return used.select("vec_id", "x").mapInArrow(run, schema)
