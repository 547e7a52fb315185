"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. A pass over the fit list multiplies it with a thin block of
vectors: every task sums its own centred products, Spark adds them up, and the driver gets as many
rows as there are dimensions. A three-term recurrence over such passes is a Chebyshev polynomial of
the covariance that damps the unwanted part of the spectrum; QR and Rayleigh-Ritz follow, until the
residuals of the wanted pairs certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import find_package, over_batches, pick, record, stored

#: Components, vectors of the block, steps of x per unit, largest degree of a filter.
COMPONENTS, WIDTH, STEPS, DEGREE = 4, 24, 256, 10
#: Residual, as a share of the largest eigenvalue, that certifies a pair; what rounding must at least allow.
CERTIFIED, STALLED = 2e-14, 1e-10
#: The filter may lift the first wanted direction above the last one by so much.
_LIFT = np.log(1e8)
_OUTER, _SLICE, _SMALL = 200, 1 << 22, 32768
#: A component with a smaller share of the variance has none.
NO_VARIANCE = 1e-12
_LARGEST = float(np.nextafter(2.0**63, 0))


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: the number of fitted vectors, sums per dimension, eigenvalues and unit
    eigenvectors (columns), the trace, the identity error and the number of passes."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float | None
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], float)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = pick(vectors, vec_id=id_col, vector=vector_col).select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    return rows.where(usable(F.col("vector")))


def integers(vectors: pa.Array, d: int) -> np.ndarray:
    """floor(256 c) of each entry as a long; beyond the longs, the nearest one."""
    with np.errstate(over="ignore"):
        scaled = np.floor(STEPS * vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, d))
    return np.clip(scaled, -(2.0**63), _LARGEST).astype(np.int64)


def encoded(x: np.ndarray) -> list[bytes]:
    """Each row as bytes, two an entry where that is enough, else eight: equal rows, equal bytes."""
    small = ((x >= -_SMALL) & (x < _SMALL)).all(1)
    return [(row.astype("<i2") if s else row.astype("<i8")).tobytes() for row, s in zip(x, small)]


def decoded(rows: pa.Array, d: int) -> np.ndarray:
    x = rows.to_pylist()
    wide = [len(r) != 2 * d for r in x]
    if not any(wide):
        return np.frombuffer(b"".join(x), "<i2").reshape(-1, d)
    return np.array([np.frombuffer(r, "<i8" if w else "<i2") for r, w in zip(x, wide)], np.int64).reshape(-1, d)


def _summed(fit: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray], height: int) -> np.ndarray:
    """The sum over the fit list of ``part``, a matrix (height, width) of a slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((height, width)), max(1, _SLICE // d)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                total += part(decoded(batch.column(0).slice(lo, rows), d))
        yield record(i=np.arange(height, dtype=np.int32), **{f"c{j}": total[:, j] for j in range(width)})

    columns = [f"c{j}" for j in range(width)]
    parts = fit.mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in columns))
    out = np.zeros((height, width))
    for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in columns]).collect():
        out[row["i"]] = row[1:]
    return out


class _Passes:
    """Products of the centred covariance with blocks of vectors, one pass each."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean, self.count, self.trace = fit, n, mean, 0, 0.0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        mean, d = self.mean, len(self.mean)

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return np.column_stack((centred.T @ (centred @ q), (centred * centred).sum(0)))

        total = _summed(self.fit, d, q.shape[1] + 1, part, d) / self.n
        self.count, self.trace = self.count + 1, float(total[:, -1].sum())
        return total[:, :-1]


class _Lanczos:
    """One vector that rides along with the passes and tells where the spectrum begins."""

    def __init__(self, d: int, rng: np.random.Generator):
        v = rng.standard_normal(d)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def follow(self, product: np.ndarray) -> None:
        if len(self.alpha) == len(self.basis):
            return  # an invariant space is reached
        self.alpha.append(float(product @ self.vector))
        space = np.array(self.basis)
        rest = product - space.T @ (space @ product)
        rest -= space.T @ (space @ rest)
        size = float(np.linalg.norm(rest))
        if size > 1e-12 * max(abs(a) for a in self.alpha) and len(self.basis) < len(product):
            self.beta.append(size)
            self.basis.append(rest / size)

    def lowest(self) -> float:
        """A lower estimate of the smallest eigenvalue, never negative."""
        k = len(self.alpha)
        values, vectors = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1) + np.diag(self.beta[: k - 1], -1))
        error = self.beta[k - 1] * abs(vectors[-1, 0]) if len(self.beta) >= k else 0.0
        return max(0.0, float(values[0] - error))


def eigenpairs(passes: Callable[[np.ndarray], np.ndarray], d: int, k: int, width: int = WIDTH, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of the matrix that ``passes`` multiplies with.

    The block has ``width`` vectors, the whole space if it has no more dimensions. The filter's
    interval runs from the lowest eigenvalue, as estimated, to the last Ritz value of the block. Its
    degree stays low enough for the wanted directions to survive side by side in double precision.
    Ends when all wanted residuals are certified, or when rounding lets them fall no further.
    """
    rng = np.random.default_rng(seed)
    m = min(d, max(width, k))
    q = np.linalg.qr(rng.standard_normal((d, m)))[0]
    probe, before = _Lanczos(d, rng), np.inf

    def multiply(y: np.ndarray) -> np.ndarray:
        out = passes(np.column_stack((y, probe.vector)))
        probe.follow(out[:, -1])
        return out[:, :-1]

    for _ in range(_OUTER):
        product = multiply(q)
        values, turn = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(product[:, :k] - q[:, :k] * values[:k], axis=0).max())
        if m == d or residual <= CERTIFIED * top or (residual <= STALLED * top and residual > before / 4):
            return values[:k], q[:, :k]
        before = residual
        low, high = probe.lowest(), float(values[-1])
        half = max((high - low) / 2, 1e-8 * top)
        centre = low + half
        grow = np.arccosh(np.maximum((values[[0, k - 1]] - centre) / half, 1.0))
        degree = int(np.clip(_LIFT / max(grow[0] - grow[1], 1e-9), 2, DEGREE))
        older, newer = q, (multiply(q) - centre * q) / half
        for _ in range(degree - 1):
            older, newer = newer, 2 * (multiply(newer) - centre * newer) / half - older
        q = np.linalg.qr(newer)[0]
    raise ArithmeticError("the eigenpairs were not certified")


def fit(vectors: DataFrame, components: int = COMPONENTS, width: int = WIDTH, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """Fits the whitening on each distinct integer vector once.

    Vectors that are null or hold null or non-finite entries take no part. The dimension is the one
    that most vectors have (the larger of two); vectors of another dimension take no part either.
    """
    find_package(vectors.sparkSession)
    rows = _clean(vectors, id_col, vector_col)
    lead = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lead["d"] if lead else 0
    if not d:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, None, 0)

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield record(x=pa.array(encoded(integers(batch.column(0), d)), pa.binary()))

    fitted = stored(rows.where(F.size("vector") == d).select("vector").mapInArrow(over_batches(encode), "x binary").distinct(), "fit")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = decoded(batch.column(0), d).astype(np.int64)
            wide = len(x) and int(np.abs(x >> 1).max()) * len(x) >= 1 << 61
            n, total = n + len(x), [t + int(s) for t, s in zip(total, (x.astype(object) if wide else x).sum(0))]
        yield record(i=np.arange(d, dtype=np.int32), n=np.full(d, n, np.int64), s=pa.array([Decimal(t) for t in total], pa.decimal128(28, 0)))

    sums = sorted(fitted.mapInArrow(add, "i int, n bigint, s decimal(28,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    n, totals = sums[0]["n"], tuple(int(r["s"]) for r in sums)
    passes = _Passes(fitted, n, np.array([s / n for s in totals], float))
    values, directions = eigenpairs(passes, d, min(components, d), width)
    model = Whitening(n, totals, values, directions, passes.trace, None, passes.count)
    return Whitening(n, totals, values, directions, passes.trace, _identity_error(fitted, model), passes.count)


def _varied(model: Whitening) -> np.ndarray:
    return model.values > NO_VARIANCE * model.trace


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates along the components that have variance."""
    at = _varied(model)
    return ((x - model.mean) @ model.directions[:, at]) / np.sqrt(model.values[at])


def _identity_error(fitted: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened covariance minus the identity."""
    d, k = len(model.sums), int(_varied(model).sum())
    if not k:
        return None
    mean = _summed(fitted, d, k, lambda x: _projected(x, model).sum(0)[None, :], 1)[0] / model.n

    def part(x: np.ndarray) -> np.ndarray:
        centred = _projected(x, model) - mean
        return centred.T @ centred

    return float(np.abs(_summed(fitted, d, k, part, k) / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    wide = len(x) and int(np.abs(x >> 1).max()) ** 2 * x.shape[1] >= 1 << 60
    own = x.astype(object) if wide else x
    square, cross = (own * own).sum(1), x.astype(object) @ np.array(sums, object)
    rest = sum(s * s for s in sums)
    return [n * n * int(a) - 2 * n * int(b) + rest for a, b in zip(square, cross)]


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector and component: vec_id, component (from 1), n, deviation (exact, decimal; null
    from 38 digits on), whitened, explained, identity_error.

    Vectors that the fit leaves out have no rows, repeated rows all have theirs. A component without
    variance has whitened null; explained is null where nothing varies. Columns other than the two
    named are not read.
    """
    find_package(vectors.sparkSession)
    id_type = vectors.select(vectors[f"`{id_col}`"]).schema[0].dataType.simpleString()
    d, k, varied = len(model.sums), len(model.values), _varied(model)
    share = [float(v / model.trace) if model.trace else None for v in model.values]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.num_rows
        x = integers(batch.column(1), d)
        deviation = [Decimal(v) if v < 10**38 else None for v in deviations(x, model.n, model.sums)]
        white = np.full((rows, k), np.nan)
        white[:, varied] = _projected(x, model)
        each = np.repeat(np.arange(rows), k)
        yield record(
            vec_id=batch.column(0).take(pa.array(each)), component=np.tile(np.arange(1, k + 1, dtype=np.int32), rows), n=np.full(rows * k, model.n, np.int64),
            deviation=pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)), whitened=pa.array(white.reshape(-1), pa.float64(), mask=np.tile(~varied, rows)),
            explained=pa.array(share * rows, pa.float64()), identity_error=pa.array([model.identity_error] * (rows * k), pa.float64()),
        )

    rows = _clean(vectors, id_col, vector_col).where((F.size("vector") == d) & F.lit(d > 0))
    return rows.mapInArrow(over_batches(run), f"vec_id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
