"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, ``floor(scale * c)``. The directions are fitted on the distinct vectors: their
centred rows are reduced by QR, block after block in each task and then the tasks' triangles in rounds, to one
triangle R with ``R'R = n * covariance``. R is as wide as the vectors and all the driver gets. There Householder
reflections make it bidiagonal, dqds finds the squared singular values to high relative accuracy, and a twisted
factorisation of the tridiagonal ``B'B - value`` gives each direction.

The covariance is never formed, so small variances keep their digits. All rows are then projected in one pass.

Defined results: rows whose vector is NULL or has NULL or non-finite entries (or entries whose whole number does
not fit 62 bits) are dropped; vectors of another length than most distinct ones (ties: the longer) cannot be
compared and are dropped as well; a NULL vec_id is kept; repeated rows are reported each, and their vector counts
once in the fit; directions of equal variance are any orthonormal ones of their space; a direction without
variance has ``whitened`` and ``explained`` 0, and leaves 1 as ``identity_error``; a ``deviation`` beyond 64 bits
is NULL; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.workspace import scratch_path, write_and_reopen

#: Rows that one QR step adds to a triangle (at least as many as the vectors are long).
BLOCK_ROWS = 4096
#: Triangles that one task reduces to one.
FAN_IN = 32

_EPS = float(np.finfo(float).eps)
_LARGEST = 2.0**62


@dataclass(frozen=True)
class Whitening:
    """Directions by falling variance, fitted on ``n`` distinct vectors of whole numbers with sums ``sums``."""

    scale: int
    n: int
    sums: list[int]
    directions: np.ndarray  # one per column
    variances: np.ndarray
    trace: float
    identity_error: float = float("nan")

    @property
    def factors(self) -> np.ndarray:
        """Directions over the square roots of their variances; 0 without variance."""
        noise = (4 * len(self.sums) * _EPS) ** 2 * max(self.trace, 0.0)
        some = self.variances > noise
        return self.directions * np.where(some, 1 / np.sqrt(np.where(some, self.variances, 1.0)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n; the whole part of the mean is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    return (x - whole).astype(np.float64) - part


def whole_numbers(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of whole numbers) for each length of the usable vectors of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL becomes NaN
    unusable = ~(np.abs(values) * scale < _LARGEST)
    x = np.floor(np.where(unusable, 0.0, values) * scale).astype(np.int64)
    faults = np.append(0, np.cumsum(unusable))
    usable = (faults[offsets[1:]] == faults[offsets[:-1]]) & ~column.is_null().to_numpy(zero_copy_only=False)
    length = np.diff(offsets)
    for size in np.unique(length[usable]).tolist():
        rows = np.flatnonzero(usable & (length == size))
        yield rows, x[offsets[rows][:, None] + np.arange(size)]


def _packed(x: np.ndarray) -> pa.Array:
    """One binary value per row: 16-bit numbers where all of the row fit, else 64-bit ones."""
    small = (x >= -(1 << 15)).all(1) & (x < 1 << 15).all(1)
    rows = [r.tobytes() for r in x.astype("<i8")]
    for i, r in zip(np.flatnonzero(small).tolist(), x[small].astype("<i2"), strict=True):
        rows[i] = r.tobytes()
    return pa.array(rows, pa.binary())


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    kinds = {2 * width: "<i2", 8 * width: "<i8"}
    rows = column.to_pylist()
    out = np.empty((len(rows), width), np.int64)
    sizes = np.array([len(r) for r in rows])
    for size, kind in kinds.items():
        at = np.flatnonzero(sizes == size)
        out[at] = np.frombuffer(b"".join(rows[i] for i in at.tolist()), kind).reshape(len(at), width)
    return out


def distinct_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(length, x) of every distinct usable vector."""

    def pack(batches):
        for batch in batches:
            for _, x in whole_numbers(batch.column("embedding"), scale):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), x.shape[1], np.int32)), _packed(x)], ["length", "x"]
                )

    return rows.select("embedding").mapInArrow(pack, "length int, x binary").distinct()


def _sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum in each dimension; each task sends one row per dimension."""

    def add(batches):
        n, total = 0, [0] * width
        for batch in batches:
            x = _unpacked(batch.column("x"), width)
            n += len(x)
            safe = len(x) * float(np.abs(x).max(initial=0)) < _LARGEST
            part = x.sum(0) if safe else x.astype(object).sum(0)
            total = [a + int(b) for a, b in zip(total, part, strict=True)]
        if n:
            values = pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width, dtype=np.int32)), values], ["i", "value"])

    parts = vectors.select("x").mapInArrow(add, "i int, value decimal(38,0)")
    found = {r["i"]: int(r["value"]) for r in parts.groupBy("i").agg(F.sum("value").alias("value")).collect()}
    return found[-1], [found[i] for i in range(width)]


def triangle(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred vectors: blocks in each task, then triangles in rounds."""
    width = len(sums)

    def reduced(blocks):
        r = np.zeros((0, width))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), "r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def blocks(batches):
        step = max(BLOCK_ROWS, width)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                yield _centred(_unpacked(batch.column("x").slice(at, step), width), n, sums)

    def triangles(batches):
        for batch in batches:
            for r in batch.column("r"):
                yield np.frombuffer(r.as_py()).reshape(-1, width)

    spark = vectors.sparkSession
    found = vectors.select("x").mapInArrow(lambda b: reduced(blocks(b)), "r binary")
    found = write_and_reopen(found, scratch_path(spark, "whitening-triangles"))
    while (count := found.count()) > 1:
        found = found.repartition(-(-count // FAN_IN)).mapInArrow(lambda b: reduced(triangles(b)), "r binary")
        found = write_and_reopen(found, scratch_path(spark, "whitening-triangles"))
    r = np.frombuffer(found.first()["r"]).reshape(-1, width)
    return np.vstack([r, np.zeros((width - len(r), width))])


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V'`` by Householder reflections from both sides."""
    a, size = r.copy(), len(r)
    v = np.eye(size)

    def reflector(x):
        """u and t such that ``I - t u u'`` takes x to a multiple of the first unit vector."""
        norm = np.linalg.norm(x)
        if norm == 0:
            return x, 0.0
        u = x / norm
        u[0] += 1.0 if u[0] >= 0 else -1.0
        return u, 1 / abs(u[0])

    for k in range(size):
        u, t = reflector(a[k:, k])
        a[k:, k:] -= np.outer(t * u, u @ a[k:, k:])
        if k < size - 2:
            u, t = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ u, t * u)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ u, t * u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values, falling, of the bidiagonal with squared entries ``q`` and ``e``.

    Each transform shifts by a lower bound of the smallest value, the reciprocal of the trace of the inverse,
    which a transform without shift gives. So no difference of nearby numbers is formed but the shift's own.
    """

    def transform(shift):
        new_q, new_e, d, inverse = [], [], q[0] - shift, 0.0
        for k in range(len(e)):
            if d < 0:
                return None
            inverse += 1 / d if d else np.inf
            at = d + e[k]
            share = d / at if at else 1.0
            new_q.append(at)
            new_e.append(e[k] * (q[k + 1] / at) if at else 0.0)
            d = q[k + 1] * share - shift
        if d < 0:
            return None
        return [*new_q, d], new_e, inverse + (1 / d if d else np.inf)

    q, e, shifted, found = list(q), list(e), 0.0, []
    while q:
        if not e or e[-1] <= _EPS**2 * (shifted + q[-1]):
            found.append(shifted + q.pop())
            e = e[: len(q) - 1] if q else []
            continue
        if 1.5 * q[0] < q[-1]:  # the small values belong at the end
            q.reverse()
            e.reverse()
        plain = transform(0.0)
        shift = (1 - 4 * len(q) * _EPS) / plain[2]
        done = transform(shift) if shift > _EPS * shifted else None
        if done is None:
            q, e = plain[:2]
        else:
            q, e = done[:2]
            shifted += shift
    return sorted(found, reverse=True)


def twisted_vectors(diagonal: np.ndarray, above: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors (columns) of ``B'B`` for its eigenvalues ``values``, B upper bidiagonal.

    ``B'B = L D L'``; for each value the stationary factorisation from the top and the progressive one from the
    bottom are joined at the index where the residual is least. Vectors of nearly equal values are made
    orthogonal to the ones before, taking another twist where one would repeat them.
    """
    size = len(diagonal)
    d, lower = diagonal**2, above / diagonal[:-1]
    vectors = np.zeros((size, len(values)))
    tiny = np.finfo(float).tiny

    def twists(value):
        """Candidate vectors, the best index first."""
        down, plus = np.empty(size), np.empty(size - 1)
        up, minus = np.empty(size), np.empty(size - 1)
        down[0] = -value
        for k in range(size - 1):
            pivot = down[k] + d[k] or tiny
            plus[k] = d[k] * lower[k] / pivot
            down[k + 1] = plus[k] * lower[k] * down[k] - value
        up[-1] = d[-1] - value
        for k in range(size - 2, -1, -1):
            pivot = d[k] * lower[k] ** 2 + up[k + 1] or tiny
            minus[k] = lower[k] * d[k] / pivot
            up[k] = up[k + 1] * (d[k] / pivot) - value
        residual = np.abs(down + up + value)
        for r in np.argsort(np.where(np.isfinite(residual), residual, np.inf)).tolist():
            z = np.zeros(size)
            z[r] = 1.0
            for k in range(r - 1, -1, -1):
                z[k] = -plus[k] * z[k + 1]
            for k in range(r, size - 1):
                z[k + 1] = -minus[k] * z[k]
            norm = np.linalg.norm(z)
            if np.isfinite(norm):
                yield z / norm

    for i, value in enumerate(values):
        near = [j for j in range(i) if abs(values[j] - value) <= 1e-3 * values[0]]
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            for z in twists(value):
                for _ in range(2):
                    z = z - vectors[:, near] @ (vectors[:, near].T @ z)
                if np.linalg.norm(z) > 0.1:
                    break
            else:  # the values are equal to the last digit: any direction of their space that is left
                z = np.linalg.svd(vectors[:, :i].T)[2][i] if i else np.eye(size)[0]
        vectors[:, i] = z / np.linalg.norm(z)
    return vectors


def principal_directions(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(directions as columns, their eigenvalues of ``r'r``, the sum of all eigenvalues)."""
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0:
        return np.eye(len(r))[:, :wanted], np.zeros(wanted), 0.0
    diagonal, above, v = bidiagonalised(r / scale)
    diagonal = np.where(diagonal == 0, 1e-60, diagonal)  # far below what the triangle's rounding leaves
    values = dqds((diagonal**2).tolist(), (above**2).tolist())
    directions = v @ twisted_vectors(diagonal, above, values[:wanted])
    return directions, np.array(values[:wanted]) * scale**2, sum(values) * scale**2


def fit_whitening(rows: DataFrame, scale: int, components: int) -> Whitening | None:
    """Whitening by the first ``components`` directions of the distinct vectors; None without vectors."""
    spark = rows.sparkSession
    vectors = write_and_reopen(distinct_vectors(rows, scale), scratch_path(spark, "whitening-vectors"))
    lengths = vectors.filter("length > 0").groupBy("length").count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if most is None:
        return None
    vectors = vectors.filter(F.col("length") == most["length"])
    width = most["length"]
    n, sums = _sums(vectors, width)
    directions, values, total = principal_directions(triangle(vectors, n, sums), min(components, width))
    model = Whitening(scale, n, sums, directions, values / n, total / n)
    return Whitening(scale, n, sums, directions, values / n, total / n, _identity_error(vectors, model))


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, without sign, of the covariance of the whitened distinct vectors minus the identity."""
    factors, width = model.factors, len(model.sums)
    size = factors.shape[1]

    def moments(batches):
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            white = model.centred(_unpacked(batch.column("x"), width)) @ factors
            white = np.hstack([white, np.ones((len(white), 1))])
            total += white.T @ white
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "value"])

    found = vectors.select("x").mapInArrow(moments, "i long, j long, value double")
    total = np.zeros((size + 1, size + 1))
    for r in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] = r["value"]
    mean = total[:size, size] / model.n
    covariance = total[:size, :size] / model.n - np.outer(mean, mean)  # the mean is 0 to rounding
    return float(np.abs(covariance - np.eye(size)).max())


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sums) ** 2; None beyond 63 bits.

    Sums of 64-bit numbers that wrap around are exact for a result that fits; a float tells which ones do.
    """
    rough = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(1)
    wrapped = x.view(np.uint64) * np.uint64(n) - np.array([s % (1 << 64) for s in sums], np.uint64)
    exact = (wrapped * wrapped).sum(1, dtype=np.uint64)
    out: list[int | None] = exact.astype(np.int64).tolist()
    for i in np.flatnonzero(rough > 2.0**62).tolist():  # near the end of the range or beyond it
        value = sum((n * a - s) ** 2 for a, s in zip(x[i].tolist(), sums, strict=True)) if rough[i] < 2.0**64 else None
        out[i] = value if value is not None and value < 1 << 63 else None
    return out


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    schema = T.StructType(
        [
            T.StructField("vec_id", rows.schema["vec_id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")),
        ]
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    factors, width = model.factors, len(model.sums)
    size = factors.shape[1]
    explained = np.where(factors.any(0), model.variances / (model.trace or 1.0), 0.0)

    def project(batches):
        for batch in batches:
            for at, x in whole_numbers(batch.column("embedding"), model.scale):
                if x.shape[1] != width:
                    continue
                m = len(x)
                deviation = pa.array(_deviation(x, model.n, model.sums), pa.int64())
                row = np.repeat(np.arange(m), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(at[row])),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * size, model.n, np.int64)),
                        deviation.take(pa.array(row)),
                        pa.array((model.centred(x) @ factors).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * size, model.identity_error)),
                    ],
                    schema.names,
                )

    return rows.select("vec_id", "embedding").mapInArrow(project, schema)
