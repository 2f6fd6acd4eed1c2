"""Embedding whitening: leading components by FEAST contour integration.

*Fit list.*  Entries become whole numbers x = floor(256 * c); each distinct vector counts once.
Counts and sums are exact, the covariance is centred before multiplying: rows minus the whole part of the
mean, products summed as exact integers, the fractions of the means taken off at the end, so
every entry is the nearest double whatever the partitions.

*Components.*  Orthogonal reflections bring the covariance V to three diagonals; Sylvester inertia
counts of the shifted matrix (Sturm sequences) say how many eigenvalues lie below any number.  Bisection with these counts
gives intervals, one around each group of eigenvalues that lie closer than ``NEAR`` of the largest,
with clear space to the next group.  For each interval the projector on its
eigenvectors is a contour integral of the resolvent, a sum over quadrature points z on a circle,

    P Y  =  1/N  sum  Re( r e^(i t) (z I - V)^-1 Y ),     z = c + r e^(i t),

of complex shifted solves.  Rayleigh-Ritz in the projected space gives eigenvalues and vectors; rounds
repeat until the residuals are at rounding level.  The Ritz values inside each interval must
be as many as the inertia counts say, or the subspace grows: none is missed.  A last
Rayleigh-Ritz over all intervals makes the components orthogonal among each other.

*Spark.*  Distinct vectors are one shuffle (equal ones merge before it); sums and products are a
bounded table a task, added by Spark; the shifted solves of a round, one for each interval and quadrature
point, are the tasks of one job with V broadcast (``MAX_DIM`` bounds it to 32 MB).  Scores come
from one pass over the source.  Only dim x dim numbers ever reach the driver.

Cases: rows whose vector is NULL, empty, has NULL or non-finite entries, or an entry whose scaled value
does not fit 62 bits are dropped; so are those of another length than the most
common one (of the distinct vectors; ties: the longer).  Components with an eigenvalue of no more than
``RANK`` of the largest have no whitened value and are not returned, so a table
of equal vectors gives no rows, nor does an empty one.  Repeated rows and ids give rows of their own.
A deviation beyond 63 bits is NULL, its digits are in ``deviation_digits``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tierline.llm.common import bounded_batches, drop_path, table, written
from tierline.llm.vectors import column_sums, decimals, whole_numbers

SCALE = 256
COMPONENTS = 4
MAX_DIM = 2048
#: Quadrature points on the upper half of a contour (the lower half is their conjugate).
POINTS = 8
#: Eigenvalues closer than this share of the largest share an interval.
NEAR = 2.0 ** -30
RANK = 1e-11
ROUNDS = 30
#: Rows whose products are summed at once: 2**15 products of 2 * 18 bits are exact in a double.
CHUNK = 1 << 15
LIMB = 18
MOST = (1 << 63) - 1


@dataclass
class Whitening:
    """n vectors with sums ``total``; unit components (rows) with their eigenvalues, and the trace of V."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.total])
        return (x - mean) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n x - total)^2."""
        largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        off = np.array(self.total, object)
        if (self.n * largest + max(abs(s) for s in self.total)) ** 2 * len(off) <= MOST:
            diff = self.n * x - off.astype(np.int64)
            return (diff * diff).sum(axis=1).tolist()
        diff = self.n * x.astype(object) - off
        return (diff * diff).sum(axis=1).tolist()


# ---------------------------------------------------------------- fit list and covariance

def fit_list(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """The distinct whole-number vectors of the ``embedding`` column, as bytes."""
    def run(batches):
        for batch in batches:
            for length in np.unique(np.diff(_offsets(batch.column(0)))):
                if length:
                    _, x = whole_numbers(batch.column(0), scale, int(length))
                    yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary())], ["x"])

    bounded_batches(rows.sparkSession)
    return rows.select("embedding").mapInArrow(run, "x binary").distinct()


def _offsets(column: pa.Array) -> np.ndarray:
    return column.offsets.to_numpy()


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def counts_and_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    def run(batches):
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _vectors(batch.column(0), dim)
            n, total = n + len(x), total + column_sums(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), decimals([*total, n])], ["place", "total"])

    found = {r["place"]: int(r["total"]) for r in fit.mapInArrow(run, "place int, total decimal(38,0)")
             .groupBy("place").agg(F.sum("total").alias("total")).collect()}  # dim + 1 rows
    return found.get(dim, 0), [found.get(i, 0) for i in range(dim)]


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, each times 2 ** (LIMB * its place), is ``y``."""
    out = []
    while y.size and (y.max() >= 1 << LIMB or y.min() < -(1 << LIMB)):
        out.append((y & ((1 << LIMB) - 1)).astype(float))
        y = y >> LIMB
    return [*out, y.astype(float)]


def covariance(fit: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Covariance with divisor n: each entry is the exact one, rounded once."""
    dim = len(total)
    middle = [s // n for s in total]
    centre = np.array(middle, np.int64)
    upper = np.triu_indices(dim)
    arrow = pa.schema([("power", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            y = _vectors(batch.column(0), dim) - centre
            for i in range(0, len(y), CHUNK):
                parts = limbs(y[i:i + CHUNK])
                for a, left in enumerate(parts):
                    for b, right in enumerate(parts):
                        own = (left.T @ right).astype(np.int64).astype(object)[upper]
                        sums[a + b] = sums[a + b] + own if a + b in sums else own
        for power, values in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), power), pa.int32()),
                                              pa.array(range(len(values)), pa.int32()), decimals(values)], schema=arrow)

    products = [0] * len(upper[0])
    for r in (fit.mapInArrow(run, "power int, place int, total decimal(38,0)").groupBy("power", "place")
              .agg(F.sum("total").alias("total")).collect()):  # dim * (dim + 1) / 2 rows, times up to 7 powers
        products[r["place"]] += int(r["total"]) << (LIMB * r["power"])
    rest = [s - n * m for s, m in zip(total, middle)]
    out = np.zeros((dim, dim))
    for i, j, p in zip(upper[0].tolist(), upper[1].tolist(), products):
        out[i, j] = out[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    return out


# ---------------------------------------------------------------- inertia and intervals

def three_diagonals(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Main and next diagonal of an orthogonally similar matrix (Householder reflections)."""
    t = v.copy()
    for k in range(len(t) - 2):
        u = t[k + 1:, k].copy()
        size = np.linalg.norm(u)
        if not size:
            continue
        u[0] += size if u[0] >= 0 else -size
        u /= np.linalg.norm(u)
        own = t[k + 1:, k + 1:]
        w = own @ u
        w -= u * (u @ w)
        own -= 2 * (np.outer(u, w) + np.outer(w, u))
        t[k + 1:, k] -= 2 * u * (u @ t[k + 1:, k])
    return np.diag(t).copy(), np.diag(t, -1).copy()


def inertia_below(diagonals: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative pivots of the shifted matrix."""
    main, side = diagonals
    tiny = np.finfo(float).tiny
    pivot = main[0] - shifts
    count = (pivot < 0).astype(int)
    for i in range(1, len(main)):
        pivot = np.where(pivot == 0, tiny, pivot)
        with np.errstate(over="ignore"):
            pivot = main[i] - shifts - side[i - 1] ** 2 / pivot
        count += pivot < 0
    return count


def intervals(v: np.ndarray, want: int) -> list[tuple[float, float, int]]:
    """(centre, radius, eigenvalues) of the contours that hold the ``want`` largest eigenvalues."""
    diagonals = three_diagonals(v)
    dim, scale = len(v), float(np.abs(v).sum(axis=1).max())
    low, high = np.full(dim, -scale), np.full(dim, scale * (1 + 1e-9))
    for _ in range(48):
        mid = (low + high) / 2
        less = inertia_below(diagonals, mid) <= np.arange(dim)  # the i-th eigenvalue is not below
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    values = (low + high) / 2
    start = np.flatnonzero(np.concatenate(([True], np.diff(values) > NEAR * scale)))
    groups = [values[a:b] for a, b in zip(start, [*start[1:], dim])]
    out, held = [], 0
    for g in range(len(groups) - 1, -1, -1):
        if held >= want:
            break
        first, last = groups[g][0], groups[g][-1]
        space = min(first - groups[g - 1][-1] if g else scale, groups[g + 1][0] - last if g + 1 < len(groups) else scale)
        out.append(((first + last) / 2, (last - first) / 2 + space / 2, len(groups[g])))
        held += len(groups[g])
    for centre, radius, size in out:
        below = inertia_below(diagonals, np.array([centre - radius, centre + radius]))
        if below[1] - below[0] != size:
            raise ArithmeticError(f"inertia counts {below[1] - below[0]} eigenvalues around {centre}, bisection {size}")
    return out


# ---------------------------------------------------------------- contour integration

def projected(spark: SparkSession, shared, bases: dict[int, np.ndarray], spans) -> dict[int, np.ndarray]:
    """The bases projected by the contour integrals: one task a shifted solve."""
    tasks = [(i, j) for i in bases for j in range(POINTS)]

    def solve(batches):
        v = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                i, j = tasks[k]
                turn = np.exp(1j * np.pi * (j + 0.5) / POINTS)
                centre, radius, _ = spans[i]
                z = centre + radius * turn
                own = (radius * turn * np.linalg.solve(z * np.eye(len(v)) - v, bases[i].astype(complex))).real / POINTS
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()),
                                                  pa.array([own.tobytes()], pa.binary())], ["span", "point", "part"])

    parts = max(1, min(len(tasks), spark.sparkContext.defaultParallelism))
    rows = spark.range(0, len(tasks), 1, parts).mapInArrow(solve, "span int, point int, part binary").collect()
    out = {i: np.zeros_like(bases[i]) for i in bases}
    for r in sorted(rows, key=lambda r: (r["span"], r["point"])):
        out[r["span"]] += np.frombuffer(r["part"]).reshape(bases[r["span"]].shape)
    return out


def ritz(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: eigenvalues (falling) and vectors of V in the space of the basis."""
    q, _ = np.linalg.qr(basis)
    values, turn = np.linalg.eigh(q.T @ v @ q)
    return values[::-1], (q @ turn)[:, ::-1]


def leading(spark: SparkSession, v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of V, falling, and their unit eigenvectors as rows."""
    dim, scale = len(v), float(np.abs(v).sum(axis=1).max())
    if not scale:
        return np.zeros(0), np.zeros((0, dim))
    spans = intervals(v, min(want, dim))
    shared = spark.sparkContext.broadcast(v)
    random = np.random.default_rng(dim)
    open_ = {i: random.standard_normal((dim, min(dim, size + 2))) for i, (_, _, size) in enumerate(spans)}
    done: dict[int, np.ndarray] = {}
    found: set[int] = set()
    for _ in range(ROUNDS):
        for i, basis in projected(spark, shared, open_, spans).items():
            centre, radius, size = spans[i]
            values, vectors = ritz(v, basis)
            inside = np.flatnonzero(np.abs(values - centre) < radius)
            inside = [k for k in inside if np.linalg.norm(v @ vectors[:, k] - values[k] * vectors[:, k]) <= 4 * dim * 2.0 ** -52 * scale]
            if len(inside) == size and i in found:  # as many as the inertia counts say, twice
                done[i] = vectors[:, inside]
                del open_[i]
            elif len(inside) > size:  # copies of one vector: another space
                open_[i] = random.standard_normal((dim, min(dim, basis.shape[1] + size + 2)))
            else:
                found |= {i} if len(inside) == size else set()
                open_[i] = vectors
        if not open_:
            break
    shared.destroy()
    if open_:
        raise ArithmeticError("contour integration found fewer eigenvalues than the inertia counts")
    values, vectors = ritz(v, np.concatenate([done[i] for i in sorted(done)], axis=1))
    values, vectors = values[:want], vectors[:, :want].T
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values, vectors * sign[:, None]


# ---------------------------------------------------------------- whitening

def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the ``embedding`` column; None without vectors that vary."""
    spark, paths = rows.sparkSession, []
    distinct = written(fit_list(rows, scale), "whitening-fit", paths)
    try:
        lengths = distinct.groupBy((F.octet_length("x") / 8).cast("int").alias("dim")).count().orderBy(
            F.desc("count"), F.desc("dim")).limit(1).collect()
        if not lengths:
            return None
        dim = lengths[0]["dim"]
        if dim > MAX_DIM:
            raise ValueError(f"vectors of {dim} entries: at most {MAX_DIM} are supported")
        own = distinct.filter(F.octet_length("x") == 8 * dim)
        n, total = counts_and_sums(own, dim)
        v = covariance(own, n, total)
        values, vectors = leading(spark, v, components)
        good = values > RANK * values[0] if len(values) else values > 0
        if not good.any():
            return None
        model = Whitening(n, total, vectors[good], values[good], float(np.trace(v)))
        model.identity_error = identity_error(own, model)
        return model
    finally:
        for path in paths:
            drop_path(spark, path)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured."""
    k, dim = model.components.shape

    def run(batches):
        for batch in batches:
            w = model.project(_vectors(batch.column(0), dim))
            sums = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], ["place", "total"])

    rows = vectors.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    sums = np.array([r["total"] for r in sorted(rows, key=lambda r: r["place"])]) / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


OUTPUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "deviation_digits string")


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, model: Whitening | None = None) -> DataFrame:
    """A row for each vector of ``rows`` (vec_id, embedding) and each component."""
    model = model or fit(rows, components, scale)
    schema = StructType([rows.schema["vec_id"], *StructType.fromDDL(OUTPUT).fields])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    k, dim = model.components.shape

    def run(batches):
        for batch in batches:
            place, x = whole_numbers(batch.column(1), scale, dim)
            n = len(x)
            deviation = model.deviations(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(place, k))),
                pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                pa.array(np.full(n * k, model.n), pa.int64()),
                pa.array([d if d <= MOST else None for d in deviation for _ in range(k)], pa.int64()),
                pa.array(model.project(x).ravel()),
                pa.array(np.tile(model.values / model.trace, n)),
                pa.array(np.full(n * k, model.identity_error)),
                pa.array([None if d <= MOST else str(d) for d in deviation for _ in range(k)], pa.string()),
            ], schema=arrow)

    bounded_batches(rows.sparkSession)
    return rows.select("vec_id", "embedding").mapInArrow(run, schema)


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
