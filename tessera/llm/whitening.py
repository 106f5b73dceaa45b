"""Whitening of embeddings by a bidiagonal qd solver.

Blocks of centred rows are reduced by QR, each to a triangle as wide as a vector is long; triangles are stacked and reduced again, in
tasks, until one is left. It alone reaches the driver, where Householder reflections make it bidiagonal, the dqds
transform finds the squares of its singular values to high relative accuracy, and a twisted factorisation at each wanted one gives its
right singular vector. Eigenvalues of the covariance are those squares over the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

_EPS = np.finfo(float).eps
#: Triangles that one task stacks, and values that it holds before it reduces them (about).
FAN, BLOCK_VALUES = 32, 1 << 21


# -- the solver, over one triangle ----------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and W with orthonormal columns, for R = U B W^T with some orthonormal U."""
    a, d = np.array(r, dtype=float), r.shape[1]
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """Unit v such that x - 2 v (v . x) is zero after its first entry."""
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return None
        v = x / norm
        v[0] += np.copysign(1.0, v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < d and (v := reflector(a[k, k + 1 :])) is not None:
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _unreduced(diagonal: np.ndarray, above: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of B that hang together: its superdiagonal is cut where it is nothing next to its neighbours."""
    start = 0
    for k in range(len(diagonal)):
        if k == len(above) or abs(above[k]) <= _EPS * (abs(diagonal[k]) + abs(diagonal[k + 1])):
            yield start, k + 1
            start = k + 1


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix, falling.

    Works on q and e, the squares of its entries. Each transform takes a shift off all values; one that leaves a negative
    number is undone and tried with a smaller shift, at last with none, which always succeeds. Values split off at the end
    where e is nothing next to what has been shifted off and the q beside it.
    """
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    values, shifted = [], 0.0
    stalled = 0
    while q:
        m = len(q)
        if m == 1:
            values.append(q.pop() + shifted)
            e.clear()
            continue
        if e[-1] <= _EPS**2 * (shifted + q[-1]) or (e[-1] <= _EPS**2 * q[-2] and q[-1] + shifted == 0):
            values.append(q.pop() + shifted)
            e.pop()
            stalled = 0
            continue
        if q[0] < q[-1] and stalled % 8 == 0:  # graded the wrong way: small values belong at the end
            q.reverse()
            e.reverse()
        # The smaller eigenvalue of the last 2 by 2 corner of B B^T is near the smallest one, and not below it.
        half, c = (q[-2] + e[-1] - q[-1]) / 2, q[-1] * e[-1]
        root = np.sqrt(half * half + c)
        corner = q[-1] - (c / (half + root) if half > 0 else root - half) if root > 0 else q[-1]
        tau = max(0.0, float(corner)) if stalled < 60 else 0.0
        for attempt in range(4):
            new_q, new_e, d, at = [0.0] * m, [0.0] * (m - 1), q[0] - tau, 0
            while at < m - 1 and (d >= 0 or tau == 0):
                new_q[at] = d + e[at]
                ratio = q[at + 1] / new_q[at] if new_q[at] > 0 else 0.0
                new_e[at] = e[at] * ratio
                d = d * ratio - tau
                at += 1
            if d >= 0 or tau == 0:
                new_q[-1] = max(d, 0.0)
                q, e, shifted = new_q, new_e, shifted + tau
                break
            # Only the last number is below zero: by that much the shift was too large.
            better = tau + d if at == m - 1 and attempt < 2 else tau / 4
            tau = better if better > 0 and attempt < 2 else 0.0
        stalled += 1
        if stalled > 1000:
            raise ArithmeticError("the qd transform does not converge")
    return np.sort(np.array(values))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B^T B at an eigenvalue, from the twisted factorisation whose middle is smallest.

    B^T B - value is factorised from the top (stationary qd with a shift) and from the bottom (progressive qd); where the two meet
    in the smallest number, the vector is one, and its other entries follow by the two sets of multipliers.
    """
    m = len(diagonal)
    if m == 1:
        return np.ones(1)
    q, e = diagonal**2, above**2
    tiny = max(np.finfo(float).tiny, _EPS * _EPS * max(q.max(), value))
    # L D L^T with D = q and multipliers l; stationary: L+ D+ L+^T = L D L^T - value.
    # B^T B has diagonal q[k] + e[k-1] and off-diagonal diagonal[k] * above[k].
    s, top, down = np.empty(m), np.empty(m), np.empty(m - 1)
    s[0] = -value
    for k in range(m):
        top[k] = s[k] + q[k]
        if abs(top[k]) < tiny:
            top[k] = -tiny
        if k < m - 1:
            down[k] = diagonal[k] * above[k] / top[k]
            s[k + 1] = e[k] * (s[k] / top[k]) - value
    p, bottom, up = np.empty(m), np.empty(m), np.empty(m - 1)
    p[-1] = q[-1] - value
    for k in range(m - 2, -1, -1):
        bottom[k + 1] = e[k] + p[k + 1]
        if abs(bottom[k + 1]) < tiny:
            bottom[k + 1] = -tiny
        up[k] = diagonal[k] * above[k] / bottom[k + 1]
        p[k] = q[k] * (p[k + 1] / bottom[k + 1]) - value
    r = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(m)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(r, m - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def _apart(vector: np.ndarray, near: list[np.ndarray], diagonal: np.ndarray, above: np.ndarray, value: float, salt: int) -> np.ndarray:
    """The vector made orthogonal to those of eigenvalues close to its own; where little is left of it, by inverse iteration."""
    for attempt in range(6):
        for _ in range(2):
            for other in near:
                vector = vector - other * (other @ vector)
        norm = np.linalg.norm(vector)
        if norm > 0.5:
            return vector / norm
        # One step from a start of its own towards the eigenvalue, moved off it by a few units in the last place.
        m = len(diagonal)
        start = np.random.default_rng(1 + salt + attempt).standard_normal(m)
        for other in near:
            start -= other * (other @ start)
        t = np.diag(diagonal**2) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
        t[range(1, m), range(1, m)] += above**2
        vector = np.linalg.solve(t - value * (1 + 4 * _EPS) * np.eye(m) + np.eye(m) * np.finfo(float).tiny, start)
        vector /= np.linalg.norm(vector)
    return vector / max(np.linalg.norm(vector), np.finfo(float).tiny)


def components_of(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of R^T R, falling, and their unit eigenvectors as columns."""
    d = r.shape[1]
    scale = np.abs(r).max()
    if scale == 0:
        return np.zeros(min(wanted, d)), np.eye(d)[:, :wanted]
    diagonal, above, w = bidiagonal(r / scale)
    found = []
    for start, stop in _unreduced(diagonal, above):
        q, e = diagonal[start:stop], above[start : stop - 1]
        found += [(float(value), start, stop) for value in dqds(q, e)[:wanted]]
    found.sort(key=lambda f: -f[0])
    found = found[:wanted]
    vectors, by_part = np.zeros((d, len(found))), {}
    for k, (value, start, stop) in enumerate(found):
        q, e = diagonal[start:stop], above[start : stop - 1]
        vector = _twisted(q, e, value)
        near = [v for v, other in by_part.get(start, []) if abs(other - value) <= 1e-3 * max(other, value)]
        if near:
            vector = _apart(vector, near, q, e, value, k)
        by_part.setdefault(start, []).append((vector, value))
        vectors[:, k] = w[:, start:stop] @ vector
    return np.array([f[0] for f in found]) * scale * scale, vectors


# -- the rows -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``count`` vectors with ``sums`` per dimension, eigenvalues of their covariance and ``trace``, its whole."""

    count: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without any variance is not a number."""
        with np.errstate(divide="ignore", invalid="ignore"):
            roots = np.sqrt(np.where(self.values > 0, self.values, np.nan))
            return (_centred(x, self.count, self.sums) @ self.vectors) / roots


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _exact(x: np.ndarray, count: int, sums: np.ndarray) -> np.ndarray:
    """count * x - sums: as 64-bit integers where those hold it, otherwise as Python's."""
    reach = count * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + int(max(map(abs, sums.tolist()), default=0))
    kind = np.int64 if reach < 2**62 else object
    return x.astype(kind) * kind(count) - sums.astype(kind) if kind is np.int64 else x.astype(object) * count - sums.astype(object)


def _centred(x: np.ndarray, count: int, sums: np.ndarray) -> np.ndarray:
    return _exact(x, count, sums).astype(float) / count


def _deviations(x: np.ndarray, count: int, sums: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null where a long cannot hold one."""
    off = _exact(x, count, sums)
    if off.dtype == object or (off.size and float(np.abs(off).max()) ** 2 * off.shape[1] >= 2.0**62):
        found = [sum(int(v) * int(v) for v in row) for row in off]
        return [v if v < 2**63 else None for v in found]
    return (off * off).sum(axis=1).tolist()


def fixed_point(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """key and x: floor(scale * component) of the vectors without null or non-finite components.

    Where vectors differ in length, those of the commonest length (of those, the smallest) stay; empty ones don't.
    """
    c = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), c.alias("c")).filter(F.col("c").isNotNull() & (F.size("c") > 0))
    rows = rows.filter(F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    widths = rows.groupBy(F.size("c").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    rows = rows.filter(F.size("c") == (widths[0]["width"] if widths else 0))
    return rows.select("key", F.transform("c", lambda v: F.floor(v * scale).cast("long")).alias("x"))


def _sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """How many vectors there are and their sums per dimension, added up on the way to the driver."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64()), ("total", pa.string())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), len(batch.column(0)[0]))
                whole = x.astype(object) if int(np.abs(x.astype(float)).max()) > 2**40 else x
                total = whole.sum(axis=0).astype(object) + (0 if total is None else total)
                n += batch.num_rows
        if n:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total)), pa.array([str(v) for v in total])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    parts = fit.select("x").mapInArrow(add, "place int, n long, total string")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    rows = parts.groupBy("place").agg(F.sum("n").alias("n"), exact.cast("string").alias("total")).orderBy("place").collect()
    totals = [int(r["total"]) for r in rows]
    kind = np.int64 if all(abs(t) < 2**62 for t in totals) else object
    return (rows[0]["n"] if rows else 0), np.array(totals, dtype=kind)


def _triangle(fit: DataFrame, count: int, sums: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of all centred rows: a triangle per task, then of stacks of triangles."""
    width = len(sums)
    schema = pa.schema([("part", pa.int32()), ("r", pa.binary())])
    at_once = max(width, BLOCK_VALUES // width)

    def reduced(pieces: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        held, rows, some = np.zeros((width, width)), [], False
        size = 0
        for piece in pieces:
            rows.append(piece)
            size += len(piece)
            if size >= at_once:
                held, rows, size, some = _r_of([held, *rows], width), [], 0, True
        if rows:
            held, some = _r_of([held, *rows], width), True
        if some:
            from pyspark import TaskContext

            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([held.tobytes()], pa.binary())], schema=schema
            )

    def of_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (
            _centred(_matrix(batch.column(0).slice(at, at_once), width), count, sums)
            for batch in batches
            for at in range(0, batch.num_rows, at_once)
        )
        return reduced(blocks)

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return reduced(np.frombuffer(r).reshape(width, width) for batch in batches for r in batch.column(1).to_pylist())

    parts = written(fit.select("x").mapInArrow(of_vectors, "part int, r binary"), "whitening-triangles")
    left = parts.count()
    while left > 1:
        tasks = -(-left // FAN)
        # Dealt out in turn, so that no task gets more than a stack.
        dealt = parts.repartition(tasks, (F.col("part") % tasks) if tasks > 1 else F.lit(0)).select("part", "r")
        parts = written(dealt.mapInArrow(of_triangles, "part int, r binary"), "whitening-triangles")
        left = parts.count()
    return np.frombuffer(parts.collect()[0]["r"]).reshape(width, width) if left else np.zeros((width, width))


def _r_of(rows: list[np.ndarray], width: int) -> np.ndarray:
    r = np.linalg.qr(np.concatenate(rows), mode="r")
    return np.concatenate([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def fit_whitening(fit: DataFrame, wanted: int) -> Whitening | None:
    """Fitted on the rows of ``fit`` (x); None if there are none."""
    count, sums = _sums(fit)
    if not count:
        return None
    r = _triangle(fit, count, sums)
    squares, vectors = components_of(r, min(wanted, len(sums)))
    trace = float((r * r).sum()) / count
    values = squares / count
    values = np.where(values > trace * len(sums) * _EPS * _EPS, values, 0.0)
    return Whitening(count, sums, values, vectors, trace)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry, in absolute value, of the whitened vectors' covariance less the identity; of components with variance."""
    schema = pa.schema([("place", pa.int32()), ("value", pa.float64())])
    some = np.flatnonzero(model.values > 0)
    if not len(some):
        return None
    k = len(some)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Means of the whitened vectors are zero by more than they are rounded, so sums may be taken as they are.
        total = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = model.scaled(_matrix(batch.column(0), len(model.sums)))[:, some]
                total += np.concatenate([w.sum(axis=0), (w.T @ w).reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], schema=schema)

    parts = fit.select("x").mapInArrow(add, "place int, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(k + k * k)
    for row in rows:
        total[row["place"]] = row["value"]
    mean, square = total[:k] / model.count, total[k:].reshape(k, k) / model.count
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, key: str, column: str, scale: int, components: int) -> DataFrame:
    """Each vector along the largest principal components of all distinct ones, with variance 1 along each.

    A vector's entries are taken as x = floor(``scale`` * entry). Returns a row per vector and component (from 1): the key,
    component, n (distinct x vectors, which alone are fitted), deviation (sum over dimensions of (n * x - S)^2, exact; null where it is
    2^63 or more), whitened, explained (the component's share of the variance) and identity_error (one value for all).

    Null vectors and those with a null or non-finite entry are dropped, as are empty ones and ones of another length than the
    commonest. Repeated rows each give their rows; null and repeated keys are kept. A component along which nothing varies has a
    null whitened value; with no variance at all explained and identity_error are null too. No vectors, no rows. Eigenvalues
    that tie leave the choice of directions open; it is the same for all rows.
    """
    spark = vectors.sparkSession
    rows = fixed_point(vectors, key, column, scale)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, components)
    columns = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], columns).withColumnRenamed("key", key)
    error = identity_error(fit, model)
    k = len(model.values)
    shares = (model.values / model.trace).tolist() if model.trace > 0 else [None] * k
    schema = pa.schema([
        ("key", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
    ])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(1), len(model.sums))
            scaled = model.scaled(x)
            deviations = pa.array(_deviations(x, model.count, model.sums), pa.int64())
            for j in range(k):
                values = pa.array(scaled[:, j], mask=np.isnan(scaled[:, j]))
                same = [pa.array([v] * n, t) for v, t in ((j + 1, pa.int32()), (model.count, pa.int64()))]
                ends = [pa.array([v] * n, pa.float64()) for v in (shares[j], error)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *same, deviations, values, *ends], schema=schema)

    return rows.mapInArrow(project, columns).withColumnRenamed("key", key)
