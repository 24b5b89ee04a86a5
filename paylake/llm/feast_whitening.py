"""Embedding whitening by FEAST contour integration.

Method.  Vectors become whole numbers, x = floor(256 * c).  Their distinct ones
(the fit list) give the mean and the centred covariance, summed over tasks.
The covariance is as wide as a vector is long, whatever the number of rows, and
its leading eigenvectors are found on the driver: inertia counts (positive
pivots of a symmetric indefinite factorisation of V - s I) bracket the
eigenvalues wanted; over that interval the spectral projector is integrated on a
circle by quadrature, each node a solve with the complex shifted covariance;
Rayleigh-Ritz on the projected block gives the components, and it is repeated
until residuals vanish and the interval holds as many Ritz values as its
inertia counts say.  Rows are projected where they lie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, pick, release_memory

SCALE = 256
COMPONENTS = 4
NODES = 16          # quadrature nodes on the upper half of the circle
CHUNK = 32          # eigenvalues of an interval at most, where inertia can separate them
ROUNDS = 40
GAP = 1e-10         # eigenvalues closer than this part of the largest stay in one interval
_SUM = 24           # low bits that are summed apart
_N = -1             # dimension under which rows are counted
_LONG = 1 << 63


# ------------------------------------------------------------ eigenvalues

def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, negative, zero) eigenvalues of a symmetric matrix, by Sylvester's law from
    its factorisation with complete pivoting over 1 x 1 and 2 x 2 blocks."""
    a, n, k = a.copy(), len(a), 0
    alpha = (1 + 17 ** 0.5) / 8
    positive = negative = 0
    while k < n:
        rest = a[k:, k:]
        diagonal = np.abs(np.diag(rest))
        i = int(diagonal.argmax())
        off = np.abs(np.tril(rest, -1))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[i], off[r, s]) == 0:
            break
        if diagonal[i] >= alpha * off[r, s]:
            step, places = 1, [i]
        else:
            step, places = 2, [int(s), int(r)]
        for j, at in enumerate(places):
            a[[k + j, k + at]] = a[[k + at, k + j]]
            a[:, [k + j, k + at]] = a[:, [k + at, k + j]]
            places = [at if p == j and p != at else p for p in places]  # a row may have been swapped away
        block = a[k:k + step, k:k + step].copy()
        signs = np.linalg.eigvalsh(block)
        positive, negative = positive + int((signs > 0).sum()), negative + int((signs < 0).sum())
        below = a[k + step:, k:k + step].copy()
        a[k + step:, k + step:] -= below @ np.linalg.solve(block, below.T)
        k += step
    return positive, negative, n - positive - negative


def above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of v above shift."""
    return inertia(v - shift * np.eye(len(v)))[0]


def cut_at(v: np.ndarray, k: int, low: float, high: float) -> float:
    """A shift with k eigenvalues above it; more, if those at the cut are closer than GAP of high."""
    end = GAP * high
    while high - low > end:
        middle = (low + high) / 2
        count = above(v, middle)
        if count == k:
            return middle
        low, high = (middle, high) if count > k else (low, middle)
    return low - end if low > 2 * end else low


def project(v: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block projected onto the eigenvectors of [low, high], by Gauss-Legendre quadrature
    of the resolvent over the circle on that interval."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    eye = np.eye(len(v))
    for node, weight in zip(nodes, weights):
        turn = radius * np.exp(1j * np.pi / 2 * (1 - node))
        out += weight / 2 * np.real(turn * np.linalg.solve((centre + turn) * eye - v, block.astype(complex)))
    return out


def interval_vectors(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors in columns) of the ``count`` eigenvalues in (low, high)."""
    d = len(v)
    size = min(d, max(2 * count, count + 8))
    random = np.random.default_rng(20240607)
    block = random.standard_normal((d, size))
    for _ in range(ROUNDS):
        block, r = np.linalg.qr(project(v, block, low, high))
        small = block.T @ v @ block
        values, turn = np.linalg.eigh((small + small.T) / 2)
        block = block @ turn
        residual = np.linalg.norm(v @ block - block * values, axis=0) / max(np.abs(v).max(), np.abs(values).max())
        found = np.flatnonzero((values > low) & (values <= high))
        if len(found) == count and residual[found].max(initial=0) <= 2e-15 * d ** 0.5:
            return values[found], block[:, found]
        if len(found) > count or np.abs(np.diag(r)).min() < 1e-300:  # spurious: start with a wider block
            size = min(d, size * 2)
            block = random.standard_normal((d, size))
    if len(found) == count and residual[found].max(initial=0) <= 1e-12:
        return values[found], block[:, found]
    raise ArithmeticError(f"{len(found)} eigenvalues found where inertia counts {count}")


def leading_components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors in columns) of the k largest eigenvalues, falling; fewer
    where the others are zero to double precision.  An eigenvector's largest entry is positive."""
    d = len(v)
    top = float(np.abs(v).sum(axis=1).max(initial=0)) * (1 + 1e-9)  # no eigenvalue lies beyond (Gershgorin)
    if top == 0 or k < 1:
        return np.zeros(0), np.zeros((d, 0))
    v, unit = v / top, top
    zero = 16 * d * np.finfo(float).eps * float(np.trace(v))
    k = min(k, above(v, zero))
    values, vectors, high, done = [], [], 1.0 + 1e-9, 0
    while done < k:
        low = cut_at(v, min(k, done + CHUNK), zero, high)
        upto = above(v, low)
        some = interval_vectors(v, low, high, upto - done)
        values.append(some[0])
        vectors.append(some[1])
        high, done = low, upto
    if not values:
        return np.zeros(0), np.zeros((d, 0))
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values * unit, vectors


# ------------------------------------------------------------------- rows

def _whole_numbers(vector: str) -> Column:
    return F.transform(F.col(vector), lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("bigint"))


def _finite(vector: str) -> Column:
    def good(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    return F.col(vector).isNotNull() & F.forall(vector, good)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), d)


def _sum_pass(d: int):
    """Per task the exact sum of every dimension and the number of vectors."""
    def run(batches):
        high, low, n = [0] * d, [0] * d, 0
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            n += len(x)
            high = [a + int(b) for a, b in zip(high, (x >> _SUM).sum(axis=0))]
            low = [a + int(b) for a, b in zip(low, (x & ((1 << _SUM) - 1)).sum(axis=0))]
        total = [str((a << _SUM) + b) for a, b in zip(high, low)]
        yield pa.RecordBatch.from_arrays([pa.array([*range(d), _N], pa.int32()), pa.array([*total, str(n)])], ["dim", "total"])
    return run


class Centre:
    """Rows of n * x - S and their n-th part, exact before the one division."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def scaled(self, x: np.ndarray) -> np.ndarray:
        reach = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        kind = np.int64 if reach < _LONG else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def deviation(self, x: np.ndarray) -> pa.Array:
        y = self.scaled(x)
        reach = int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1])
        if reach >= _LONG:
            y = y.astype(object)
        out = (y * y).sum(axis=1)
        return pa.array([None if not -_LONG <= a < _LONG else int(a) for a in out.tolist()], pa.int64())

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def _product_pass(centre: Centre, d: int, map_: np.ndarray):
    """Per task the upper half of the sum of outer products of the centred, mapped vectors."""
    def run(batches):
        wide = map_.shape[1]
        total = np.zeros((wide, wide))
        for batch in batches:
            y = centre(_matrix(batch.column("x"), d)) @ map_
            total += y.T @ y
        i, j = np.triu_indices(wide)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "v"])
    return run


def _covariance(fit: DataFrame, centre: Centre, d: int, map_: np.ndarray) -> np.ndarray:
    """Covariance of the mapped vectors of the fit list: an entry per pair of dimensions."""
    parts = fit.mapInArrow(_product_pass(centre, d, map_), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = parts.toArrow()
    i, j, v = (rows.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((map_.shape[1],) * 2)
    out[i, j] = out[j, i] = v / centre.n
    return out


def _project_pass(centre: Centre, d: int, map_: np.ndarray, explained: list[float], error: float):
    k = map_.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            n = len(x)
            deviation = centre.deviation(x).take(pa.array(np.repeat(np.arange(n), k)))
            whitened = (centre(x) @ map_).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                 pa.array(np.full(n * k, centre.n)), deviation, pa.array(whitened), pa.array(np.tile(explained, n), pa.float64()),
                 pa.array(np.full(n * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
        release_memory()
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector
    and component, for the leading ``components`` components of the distinct vectors.

    A vector that is null or holds a null or non-finite entry is dropped.  Shorter
    vectors count as filled up with zeros to the longest; entries beyond 64 bits
    are held at their limits.  Rows that repeat an id or a vector, and null ids,
    get rows of their own.  Components without variance (all of them, if there is
    one distinct vector) don't exist and give no rows; equal eigenvalues share
    their space in any way, the same for all rows.  ``deviation`` is null where it
    doesn't fit 64 bits.  Extra columns are ignored; an empty table gives no rows.
    The driver holds the covariance, whose size is that of a vector squared.
    """
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    spark = vectors.sparkSession
    good = pick(vectors, vec_id=vec_id, embedding=embedding).where(_finite("embedding")).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), _whole_numbers("embedding").alias("x"))
    d = good.agg(F.max(F.size("x"))).first()[0] or 0
    if not d:
        return spark.createDataFrame([], schema)
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(d) - F.size("x")))
    good = good.select("vec_id", filled.alias("x"))
    fit = materialize(good.select("x").distinct(), "fit-list")
    sums = {r["dim"]: int(r["total"]) for r in fit.mapInArrow(_sum_pass(d), "dim int, total string").groupBy("dim")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    centre = Centre(sums[_N], [sums[i] for i in range(d)])
    v = _covariance(fit, centre, d, np.eye(d))
    values, vectors_ = leading_components(v, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    map_ = vectors_ / np.sqrt(values)
    error = float(np.abs(_covariance(fit, centre, d, map_) - np.eye(len(values))).max())
    explained = (values / np.trace(v)).tolist()
    return good.mapInArrow(_project_pass(centre, d, map_, explained, error), schema)
