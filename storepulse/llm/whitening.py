"""Whitened principal components by Chebyshev-filtered subspace iteration (operator 11).

An entry c of a vector becomes the long x = floor(64 c) + 1,000,000.  V is the
covariance of the x-vectors (divisor n, centred before multiplying).  It is
never formed: all that the iteration knows of it are products V Q with a block
Q of a few columns, each one pass over the vectors in which every task sums
Xc'(Xc Q) of its rows; the sums of the tasks are added in two levels, so what
reaches the driver is about the root of the number of tasks times the size of
the block.

1. ``LANCZOS`` steps from one vector bound the spectrum.
2. A block of k + ``GUARD`` columns goes through a Chebyshev polynomial of V (a
   three-term recurrence, one pass for each degree) that stays within 1 on the
   unwanted part of the spectrum and grows fast above it; then QR, and
   Rayleigh-Ritz on the block.  The least Ritz value of the block is the new
   edge of the unwanted part.
3. This repeats until certified: all k residuals |V q - e q| are within
   ``TOLERANCE`` of the largest eigenvalue, and ``PROBES`` fresh random vectors
   that pass the same polynomial have nothing left outside the block that an
   eigenvalue above the k-th would have put there.  A Gaussian vector has less
   than d of a given direction with a probability under 0.8 d, so the
   probability of a missed component is known; it has to be under ``MISS``.  The
   probes go with the block and cost no pass.

Where the spectrum has no edge behind the block (many equal eigenvalues) the
block is doubled, at most to ``MOST_BLOCK`` columns or all dimensions; an
error says so if that does not help either.  What the driver holds is the block
(dimensions x columns).

Defined results: rows whose vector is null, empty, holds null or non-finite
entries, or entries of 2**46 or more in size take no part, nor do rows whose
vector has another length than most (ties: the shorter); repeated rows count as
often as they occur, and so do repeated and null ids.  Components whose
eigenvalue is under 1e-13 of the trace don't exist (equal rows, fewer rows than
components, constant dimensions), so there may be fewer than asked for, or none:
then, and for an empty table, the result is empty.  Equal eigenvalues: any basis
of their space.  ``deviation`` is exact, and null where it is beyond a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import map_arrow, without

SHIFT = 1_000_000
SCALE = 64
COMPONENTS = 32
GUARD = 16
MOST_BLOCK = 1024
DEGREE = 12
LANCZOS = 8
PROBES = 3
TOLERANCE = 2e-13
MISS = 1e-9
ROUNDS = 60
#: Rounds of one width before the block is doubled.
PATIENCE = 12
#: The polynomial's value at the largest eigenvalue over that at the k-th, at most: rounding errors grow by it.
MOST_SPREAD = 1e8
ZERO = 1e-13
SEED = 11
BLOCK_BYTES = 4 << 20
#: Up to so many tasks, their sums go straight to the driver.
FEW_TASKS = 64


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of x, by dimension
    centre: np.ndarray  # mean of x - SHIFT
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors in columns
    trace: float
    identity_error: float
    residual: float  # the largest, over the largest eigenvalue
    miss: float  # probability that a component is missed
    passes: int


class _Passes:
    """Sums over all vectors of a function of blocks of their entries less SHIFT."""

    def __init__(self, entries: DataFrame, dims: int):
        self.entries, self.dims, self.done = entries, dims, 0
        self.tasks = entries.rdd.getNumPartitions()

    def sum(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple, dtype: type) -> np.ndarray:
        buckets = math.isqrt(self.tasks) + 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, dtype)
            for batch in batches:
                for u in _blocks(batch.column(0)):
                    total += of(u)
            yield _row(TaskContext.get().partitionId() % buckets, total)

        def merged(group: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_row(0, _added(group["total"].to_pylist(), shape, dtype))])

        sums = self.entries.mapInArrow(partial, "bucket int, total binary")
        if self.tasks > FEW_TASKS:
            sums = sums.groupBy("bucket").applyInArrow(merged, "bucket int, total binary")
        self.done += 1
        return _added([r["total"] for r in sums.select("total").collect()], shape, dtype)


def _row(bucket: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["bucket", "total"])


def _added(parts: list[bytes], shape: tuple, dtype: type) -> np.ndarray:
    total = np.zeros(shape, dtype)
    for p in parts:
        total += np.frombuffer(p, dtype).reshape(shape)
    return total


def _blocks(column: pa.Array) -> Iterator[np.ndarray]:
    """floor(64 c) of a column of vectors of one length, some rows at a time, as longs."""
    if not len(column):
        return
    flat = column.flatten().to_numpy(zero_copy_only=False)
    dims = flat.size // len(column)
    step = max(1, BLOCK_BYTES // (8 * dims))
    for lo in range(0, len(column), step):
        c = flat[lo * dims:(lo + step) * dims].astype(np.float64)
        yield np.floor(SCALE * c).astype(np.int64).reshape(-1, dims)


def _usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    vec = F.col(vec_col)
    fits = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0 ** 46))
    return vectors.where(F.coalesce((F.size(vec) > 0) & fits, F.lit(False)))


def _edges(product: Callable[[np.ndarray], np.ndarray], dims: int, share: float, rng: np.random.Generator) -> tuple[float, float, float]:
    """(lower bound, value that about ``share`` of the spectrum lies above, upper bound) by Lanczos steps."""
    q = rng.normal(size=dims)
    q /= np.linalg.norm(q)
    basis, diagonal, beside = [q], [], []
    for _ in range(min(LANCZOS, dims)):
        w = product(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        for _ in range(2):
            for b in basis:
                w = w - (w @ b) * b
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            beside[-1] = 0.0
            break
        basis.append(w / beside[-1])
    tri = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    ritz, s = np.linalg.eigh(tri)
    off = beside[-1] * np.abs(s[-1])
    above = np.cumsum((s[0] ** 2)[::-1])[::-1]  # share of the spectrum at or above each
    return max(0.0, float(ritz[0] - off[0])), float(ritz[above >= share - 1e-9][-1]), float(ritz[-1] + off[-1])


def _growth(degree: int, t: float) -> float:
    """Logarithm of the Chebyshev polynomial's value at t >= 1."""
    return float(np.logaddexp(degree * math.acosh(t), -degree * math.acosh(t)) - math.log(2))


@dataclass
class _Filter:
    """The polynomial that damps [low, edge], scaled to 1 at ``top``."""

    low: float
    edge: float
    top: float
    degree: int = field(default=DEGREE)

    def at(self, value: float) -> float:
        return max(1.0, (2 * value - self.edge - self.low) / (self.edge - self.low))

    def fit_degree(self, least: float) -> None:
        """Lower degree if rounding errors at the top would drown the components near ``least``."""
        spread = math.acosh(self.at(self.top)) - math.acosh(self.at(least))
        if spread > 0:
            self.degree = max(2, min(DEGREE, int(math.log(MOST_SPREAD) / spread)))

    def grown(self, value: float) -> float:
        """What a component at ``value`` is multiplied by."""
        return math.exp(_growth(self.degree, self.at(value)) - _growth(self.degree, self.at(self.top)))

    def apply(self, product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray) -> np.ndarray:
        """The polynomial of V times q; vq is V q."""
        half, middle = (self.edge - self.low) / 2, (self.edge + self.low) / 2
        s = first = half / (self.top - middle)
        y = (vq - middle * q) * (s / half)
        for _ in range(self.degree - 1):
            after = 1 / (2 / first - s)
            q, y = y, (product(y) - middle * y) * (2 * after / half) - (s * after) * q
            s = after
        return y


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn from all usable vectors; None without any, or if all are equal."""
    usable = _usable(vectors, vec_col)
    size = usable.groupBy(F.size(vec_col).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if size is None:
        return None
    dims, n = size["dims"], size["count"]
    passes = _Passes(usable.where(F.size(vec_col) == dims).select(vec_col), dims)
    # high and low parts, so that long sums are exact
    parts = passes.sum(lambda u: np.stack([(u >> 26).sum(0), (u & (2 ** 26 - 1)).sum(0)]), (2, dims), np.int64)
    own = [(int(hi) << 26) + int(lo) for hi, lo in parts.T]
    centre = np.array([s / n for s in own])

    def product(q: np.ndarray) -> np.ndarray:
        def of(u: np.ndarray) -> np.ndarray:
            x = u - centre
            return x.T @ (x @ q)
        return passes.sum(of, q.shape, np.float64) / n

    trace = float(passes.sum(lambda u: np.square(u - centre).sum(keepdims=True), (1, 1), np.float64)[0, 0]) / n
    if trace == 0:
        return None
    rng = np.random.default_rng(SEED)
    width = min(dims, components + GUARD)
    low, edge, top = _edges(product, dims, width / dims, rng)
    q = np.linalg.qr(rng.normal(size=(dims, width)))[0]
    vq, least, miss, since = product(q), edge, 1.0, 0
    for _ in range(ROUNDS):
        whole = width == dims  # nothing lies outside the block
        if not whole:
            probes = rng.normal(size=(dims, PROBES))
            probes -= q @ (q.T @ probes)
            f = _Filter(low, max(edge, low + 1e-8 * top), top)
            f.fit_degree(max(least, f.edge))
            both = np.hstack([q, probes])
            y = f.apply(product, both, product(both) if vq is None else np.hstack([vq, product(probes)]))
            q, left = np.linalg.qr(y[:, :width])[0], y[:, width:]
            vq = product(q)
        ritz, turn = np.linalg.eigh((m := q.T @ vq) / 2 + m.T / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        k = int((ritz[:components] > ZERO * trace).sum())
        residuals = np.linalg.norm(vq - q * ritz, axis=0)
        residual, least = float(residuals[:k].max()) / ritz[0], float(ritz[k - 1])
        if not whole:
            left = left - q @ (q.T @ left)
            miss = float(np.prod(np.minimum(1, 0.8 * np.linalg.norm(left, axis=0) / max(f.grown(least), 1e-300))))
            low, edge, top = min(low, max(0.0, float(ritz[-1]))), float(ritz[-1]), max(top, float(ritz[0]))
        else:
            miss = 0.0
        if miss < MISS and residual <= TOLERANCE:
            break
        since += 1
        if whole:
            q = np.linalg.qr(q)[0]
            vq = product(q)
        elif since == PATIENCE and width < min(dims, MOST_BLOCK):
            since, more = 0, min(dims, MOST_BLOCK, 2 * width) - width
            q = np.linalg.qr(np.hstack([q, rng.normal(size=(dims, more))]))[0]
            width += more
            vq = product(q)
    else:
        raise ArithmeticError(f"components are not certified after {passes.done} passes: residual {residual:.1e}, "
                              f"probability of a missed one {miss:.1e}; the spectrum has no edge behind {width} columns")
    values, q = ritz[:k].copy(), q[:, :k]
    whitened = q.T @ product(q) / np.sqrt(np.outer(values, values))
    return Whitening(n, [s + n * SHIFT for s in own], centre, values, q, trace,
                     float(np.abs(whitened - np.eye(k)).max()), residual, miss, passes.done)


def _deviation(u: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly."""
    own = [s - n * SHIFT for s in sums]
    if float(n) * float(np.abs(u).max()) < 2.0 ** 62:
        y = n * u - np.array(own, np.int64)
        if float(np.square(y.astype(np.float64)).sum(1).max()) < 9e18:
            return pa.array((y * y).sum(1))
    each = (sum((n * c - s) ** 2 for c, s in zip(row, own)) for row in u.tolist())
    return pa.array([d if d < 2 ** 63 else None for d in each], pa.int64())


def whiten(vectors: DataFrame, model: Whitening | None, vec_col: str = "embedding", carry: list[str] = ()) -> DataFrame:
    """A row for each usable vector and component, with the columns ``carry``."""
    added = T.StructType([
        T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    kept = without(vectors.select(*carry).schema, added.names)
    schema = T.StructType([*kept, *added.fields])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims, k = model.vectors.shape
    onto = model.vectors / np.sqrt(model.values)
    share = model.values / model.trace

    def of(batch: pa.RecordBatch) -> pa.Table:
        out, at = [], 0
        for u in _blocks(batch.column(0)):
            rows = pa.array(np.repeat(np.arange(at, at + len(u)), k))
            at += len(u)
            own = pa.array(np.repeat(np.arange(len(u)), k))
            size = len(u) * k
            out.append(pa.table([
                *(batch.column(i + 1).take(rows) for i in range(len(kept))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(u))), pa.array(np.full(size, model.n)),
                _deviation(u, model.n, model.sums).take(own), pa.array(((u - model.centre) @ onto).ravel()),
                pa.array(np.tile(share, len(u))), pa.array(np.full(size, model.identity_error))], schema.names))
        return pa.concat_tables(out)

    usable = _usable(vectors, vec_col).where(F.size(vec_col) == dims)
    return map_arrow(usable.select(F.col(vec_col).alias("vec"), *(F.col(f.name) for f in kept)), of, schema)
