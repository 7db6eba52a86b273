"""Embedding whitening: the leading components by spectrum slicing.

Vectors become integers ``x = floor(64 c) + 1000000``. Each distinct vector counts once, so that
copies do not bend the result; their number, sums and covariance are Spark aggregates, of which
the driver receives one value for each pair of dimensions, however many rows there are (at most
``MOST_DIMENSIONS`` dimensions). Covariances are centred before they are multiplied.

Components are found from the top by slicing the spectrum of the covariance V. The factorisation
``V - shift I = L D L'`` has as many negative entries of D as V has eigenvalues below the shift
(Sylvester's law of inertia), so halving a bracket of the k-th eigenvalue needs counts only. Once
counts isolate it from its neighbours, Rayleigh quotient iteration converges cubically from
inside; counts just below and above its result certify that it is the k-th. If a result lies
elsewhere, the bracket is halved again. Eigenvalues that agree to rounding stay one bracket of
several; their vectors are any orthonormal basis of their common space.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are left out, and
so are rows whose length is not that of most distinct vectors (ties: the longer), since they share
no covariance; repeated rows are returned each; null identifiers are kept; eigenvalues that are
zero to rounding cannot be whitened and have no rows, so that equal vectors, a single vector or an
empty table give an empty result; integers beyond ``BOUND`` become that bound, as they would leave
64 bits; ``deviation`` is null where it is beyond 64 bits; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import map_rows
from siftwell.sources.workspace import discard, materialize

COMPONENTS = 16
SCALE, OFFSET = 64.0, 1_000_000
#: Largest size of an integer entry, and of dimensions that the driver factorises.
BOUND, MOST_DIMENSIONS = 1 << 61, 2048
#: Vectors whose products are summed before they are sent on.
ROWS = 4096


def count_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie below ``shift``.

    Symmetric elimination with a pivot of one row, or of two where its diagonal entries are small
    beside the largest entry, which bounds growth; D has blocks of one or two rows.
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(np.abs(a).max(initial=0), np.finfo(float).tiny)
    below = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        k = int(diagonal.argmax())
        i, j = divmod(int(np.abs(a).argmax()), len(a))
        if i == j or diagonal[k] >= 0.64 * abs(a[i, j]):
            pivot = a[k, k]
            if abs(pivot) <= tiny:
                # What is left is zero to rounding: eigenvalues at the shift are not below it.
                return below
            below += int(pivot < 0)
            rest = np.delete(np.arange(len(a)), k)
            column = a[rest, k]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:
            block = a[np.ix_([i, j], [i, j])]
            # The larger off-diagonal entry makes the block's determinant negative.
            below += 1
            rest = np.delete(np.arange(len(a)), [i, j])
            columns = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
    return below


def _rayleigh(
    matrix: np.ndarray, low: float, high: float, found: np.ndarray
) -> tuple[float, np.ndarray] | None:
    """An eigenpair by Rayleigh quotient iteration from inside a bracket, apart from ``found``."""
    n, scale = len(matrix), np.abs(matrix).max()
    vector = np.random.default_rng(len(found)).normal(size=n)
    value = (low + high) / 2
    near = False
    for step in range(40):
        vector = vector - found.T @ (found @ vector)
        vector /= np.linalg.norm(vector)
        if step >= 2:
            value = float(vector @ matrix @ vector)
            if not low <= value <= high:
                value = min(max(value, low), high)
                if step > 8:
                    return None
            residual = np.linalg.norm(matrix @ vector - value * vector)
            if near:
                return value, vector
            # One step more brings the vector to full precision.
            near = residual <= 8 * np.finfo(float).eps * n * scale
        try:
            vector = np.linalg.solve(matrix - value * np.eye(n), vector)
        except np.linalg.LinAlgError:
            # The shift is an eigenvalue to the last digit; one beside it serves as well.
            beside = value + 4 * np.finfo(float).eps * scale
            vector = np.linalg.solve(matrix - beside * np.eye(n), vector)
        if not np.isfinite(vector).all():
            return None
    return None


def leading_components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (rows) of the positive ones, at most ``most``."""
    n = len(matrix)
    if not n:
        return np.empty(0), np.empty((0, 0))
    reach = float(np.abs(matrix).sum(axis=1).max())
    rounding = np.finfo(float).eps * n * reach
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = n - count_below(matrix, shift)
        return counts[shift]

    positive = min(most, above(4 * rounding)) if reach else 0
    values, vectors = [], np.empty((0, n))
    while len(values) < positive:
        k = len(values)
        # The (k + 1)-th largest lies in [low, high): more than k reach low, at most k reach high.
        low, high = 4 * rounding, reach + 2 * rounding
        for shift, count in counts.items():
            if count > k:
                low = max(low, shift)
            elif shift > low:
                high = min(high, shift)
        pair = None
        while pair is None:
            cluster = above(low) - above(high)
            if high - low <= 4 * rounding:
                pair = _rayleigh(matrix, low - 8 * rounding, high + 8 * rounding, vectors)
                if pair is None:
                    raise ArithmeticError("Rayleigh quotient iteration did not converge")
                break
            if cluster == 1:
                pair = _rayleigh(matrix, low, high, vectors)
                # Certified: k eigenvalues above this one, and this one above the rest.
                margin = max(4 * rounding, np.finfo(float).eps * 16 * high)
                if pair and not above(pair[0] + margin) <= k < above(pair[0] - margin):
                    pair = None
                if pair:
                    break
            middle = (low + high) / 2
            if above(middle) > k:
                low = middle
            else:
                high = middle
        values.append(pair[0])
        vectors = np.vstack([vectors, pair[1]])
    return np.array(values), vectors


@dataclass
class Whitening:
    """What whitens vectors: the fit list's size and sums, eigenvalues and components."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``, by the difference to the whole part of the mean, which is exact."""
        middle = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - middle).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - S)^2``, exact; None beyond 64 bits."""
        estimate = ((self.centred(x) * self.n) ** 2).sum(axis=1)
        small = estimate < 2.0**62
        middle = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        with np.errstate(over="ignore"):
            squares = (self.n * (x - middle) - rest) ** 2
        found: list[int | None] = squares.sum(axis=1).tolist()
        for k in np.nonzero(~small)[0].tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(x[k].tolist(), self.sums))
            found[k] = exact if exact < 1 << 63 else None
        return found


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: rows with a usable vector, as integers."""
    entries = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    bound = float(BOUND)
    whole = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-bound)), F.lit(bound)))
    usable = vectors.where(F.size("embedding") > 0).where(~bad)
    return usable.select("vec_id", F.transform(entries, lambda c: whole(c) + OFFSET).alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy().reshape(-1, d)


def _summed(fit: DataFrame, function, kind: pa.DataType, total: str) -> dict[tuple[int, int], object]:
    """Sums over all batches of the matrices that ``function`` makes of each, by row and place."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = function(batch)
        at = pa.array(np.arange(len(rows)), pa.int32())
        return pa.record_batch({"at": at, "v": pa.array(list(rows), pa.list_(kind))})

    name = "long" if kind == pa.int64() else "double"
    parts = map_rows(fit.select("x"), run, f"at int, v array<{name}>", ROWS)
    each = parts.select("at", F.posexplode("v").alias("place", "v"))
    sums = each.groupBy("at", "place").agg(F.sum(F.col("v").cast(total)).alias("v"))
    return {(r["at"], r["place"]): r["v"] for r in sums.collect()}


def sizes_and_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""

    def halves(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch, d)
        ones = np.zeros((1, d), np.int64)
        ones[0, 0] = len(x)
        return np.vstack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), ones])

    found = _summed(fit, halves, pa.int64(), "decimal(38,0)")
    sums = [(int(found[0, k]) << 32) + int(found[1, k]) for k in range(d)]
    return int(found[2, 0]), sums


def covariance(fit: DataFrame, d: int, centred, n: int) -> np.ndarray:
    """Covariance, divisor ``n``, of what ``centred`` makes of the vectors ``x``."""

    def products(batch: pa.RecordBatch) -> np.ndarray:
        part = centred(_matrix(batch, d))
        return np.vstack([part.T @ part, part.sum(axis=0)])

    found = _summed(fit, products, pa.float64(), "double")
    k = 1 + max(place for _, place in found)
    sums = np.array([[found[i, j] for j in range(k)] for i in range(k + 1)])
    mean = sums[-1] / n
    matrix = sums[:-1] / n - np.outer(mean, mean)
    return (matrix + matrix.T) / 2


def fit_whitening(fit: DataFrame, d: int, most: int = COMPONENTS) -> Whitening:
    """Fit on a table of distinct integer vectors ``x`` of length ``d``, at least one."""
    if d > MOST_DIMENSIONS:
        raise ValueError(f"{d} dimensions; the driver factorises at most {MOST_DIMENSIONS}")
    n, sums = sizes_and_sums(fit, d)
    model = Whitening(n, sums, 0.0, np.empty(0), np.empty((0, d)))
    matrix = covariance(fit, d, model.centred, n)
    values, vectors = leading_components(matrix, most)
    return Whitening(n, sums, float(np.trace(matrix)), values, vectors)


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whitened_vectors(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: its whitened coordinate and figures of the fit.

    ``identity_error`` is the largest entry, by size, of the fit list's whitened covariance less the
    identity, taken from the whitened vectors themselves.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors)
    distinct, path = materialize(rows.select("x").distinct(), "fit")
    lengths = distinct.groupBy(F.size("x").alias("d")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], SCHEMA)
    d = usual["d"]
    fit = distinct.where(F.size("x") == d)
    model = fit_whitening(fit, d, most)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    error = float(np.abs(covariance(fit, d, model.whiten, model.n) - np.eye(k)).max())
    discard(spark, path)
    shared = spark.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fitted = shared.value
        x = _matrix(batch, d)
        m = len(x)
        return pa.record_batch(
            {
                "vec_id": batch["vec_id"].cast(pa.int64()).take(np.repeat(np.arange(m), k)),
                "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, fitted.n), pa.int64()),
                "deviation": pa.array(fitted.deviations(x), pa.int64()).take(np.repeat(np.arange(m), k)),
                "whitened": pa.array(fitted.whiten(x).ravel()),
                "explained": pa.array(np.tile(fitted.values / fitted.trace, m)),
                "identity_error": pa.array(np.full(m * k, error)),
            }
        )

    return map_rows(rows.where(F.size("x") == d), run, SCHEMA, ROWS)
