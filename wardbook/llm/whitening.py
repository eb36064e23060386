"""Embedding whitening: components of the covariance, refined from single precision.

1. Two passes over the vectors give, exactly, their number, the sums and the products of all pairs of dimensions
   after the rounded mean is taken off. A task adds up its own vectors and the partial sums of a row of the matrix
   meet under its number, so what comes to the driver is one matrix whatever the number of vectors. What rounding
   left of the mean is taken off in whole numbers too, so the covariance has no error but that of its last
   rounding.
2. Its eigenvectors in single precision are corrected by the iteration of Ogita and Aishima, which needs matrix
   products only, in extended precision: with X the vectors, R = I - X'X and S = X'AX, every eigenvalue is
   S_ii / (1 - R_ii), and X + XE is the next X, where E_ij is (S_ij + e_j R_ij) / (e_j - e_i) for eigenvalues
   that are apart and R_ij / 2 for those that are not. The error is squared by each step.
3. Eigenvalues too close for that form clusters. Within one, any basis of its space fits as well; the matrix less
   the cluster's mean eigenvalue is projected on that space, scaled up, and solved there in double precision.
   This turns the basis towards the single eigenvectors, and the iteration goes on.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.topk import usable

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
ROWS, FAN = 1 << 10, 256
_EXACT, _LONG = 1 << 53, 1 << 63
# Eigenvalues under this share of the largest one, times the dimensions, are rounding.
_RANK = np.finfo(float).eps
_HIGH = np.longdouble


def _refined(a: np.ndarray, x: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One step: the next vectors, the eigenvalues, up to which distance two count as close (``floor`` at
    least), and the largest entry that was wrong before the step."""
    r = np.eye(len(a), dtype=_HIGH) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    e = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    norm = lambda m: float(np.linalg.norm(m.astype(float)))
    close = 2 * (norm(off) + float(np.abs(e).max()) * norm(r)) / np.sqrt(len(a))
    gap = e[None, :] - e[:, None]
    apart = np.abs(gap) > max(close, floor)
    change = np.where(apart, (s + e[None, :] * r) / np.where(apart, gap, 1), r / 2)
    np.fill_diagonal(change, np.diag(r) / 2)
    wrong = max(float(np.abs(np.where(np.abs(gap) > floor, off, 0)).max()), float(np.abs(r).max()))
    return x + x @ change, e, max(close, floor), wrong


def _clusters(e: np.ndarray, close: float) -> list[np.ndarray]:
    """Numbers of eigenvalues that are linked by distances up to ``close``, two or more each."""
    order = np.argsort(e, kind="stable")
    cuts = np.flatnonzero(np.diff(e[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest orthonormal basis of nearly orthonormal vectors, by Newton's iteration."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=_HIGH) - x.T @ x) / 2
    return x


def eigen(a: np.ndarray, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision. The
    largest entry of each vector is positive."""
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.abs(a).max()) or 1.0
    a = a.astype(_HIGH) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_HIGH)
    # Eigenvalues this close are one, as far as double precision goes.
    floor = len(a) * np.finfo(float).eps * float(np.abs(a).max())
    last = np.inf
    for step in range(steps):
        x, e, close, wrong = _refined(a, x, floor)
        if wrong < 1e-3 * np.finfo(float).eps or step > 3 and wrong > last / 2:
            break
        last = wrong
        for own in _clusters(e, close):
            basis, middle = _orthonormal(x[:, own]), e[own].mean()
            part = basis.T @ (a @ basis) - middle * np.eye(len(own), dtype=_HIGH)
            size = np.abs(part).max()
            turn = np.linalg.eigh(((part + part.T) / (2 * size)).astype(float))[1] if size > 1e-3 * floor else np.eye(len(own))
            x[:, own] = basis @ _orthonormal(turn.astype(_HIGH))
    e = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-e, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    top = np.abs(x).argmax(axis=0)
    x = x * np.sign(x[top, np.arange(len(a))])
    return (e[order] * scale).astype(float), x.astype(float)


@dataclass
class Model:
    """What whitening needs of the vectors of one length."""

    n: int
    sums: np.ndarray  # exact, int64
    axes: np.ndarray  # dimensions x components, each over the root of its eigenvalue
    explained: np.ndarray

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean's whole part, which is taken off exactly, and the rest."""
        return self.sums // self.n, (self.sums % self.n) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.mean
        return ((x - whole) - rest) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2 over the dimensions; null where one is beyond 64 bits."""
        off = (x - self.sums // self.n) * self.n - self.sums % self.n
        if off.size and float(np.abs(off).max()) ** 2 * off.shape[1] < _LONG // 2:
            return (off * off).sum(axis=1).tolist()
        found = [sum(v * v for v in row) for row in off.tolist()]
        return [v if v < _LONG else None for v in found]


def _numbers(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Vectors of one length in small steps, as whole numbers: length, their rows in the batch, numbers, batch."""
    for batch in batches:
        lists = batch.column(column)
        sizes = lists.value_lengths().to_numpy()
        values, at = lists.flatten().to_numpy().astype(np.float64), np.append(0, np.cumsum(sizes))
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            step = max(1, min(ROWS, (1 << 20) // int(size)))
            for first in range(0, len(own), step):
                rows = own[first : first + step]
                x = np.floor(SCALE * values[at[rows][:, None] + np.arange(size)]).astype(np.int64) + SHIFT
                yield int(size), rows, x, batch


def _products(a: np.ndarray) -> np.ndarray:
    """a'a of whole numbers, exactly."""
    if a.size and float(np.abs(a).max()) ** 2 * len(a) < _EXACT:
        b = a.astype(np.float64)
        return (b.T @ b).astype(np.int64)
    return a.T @ a


def _partial(of):
    """Sums of ``of(size, x)`` (a matrix) over a task's vectors, as rows (size, row, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for size, _, x, _ in _numbers(batches):
            total[size] = total.get(size, 0) + of(size, x)
        for size, rows in total.items():
            n = len(rows)
            cols = [pa.array([size] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["size", "row", "sums"])

    return run


def _added(dtype):
    def run(rows: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(raw.as_py(), dtype) for raw in rows["sums"]], axis=0, dtype=dtype)
        return rows.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    return run


def _summed(vectors: DataFrame, of, dtype=np.int64) -> dict[int, np.ndarray]:
    """By length of the vectors, the matrix that ``of`` gives, summed over all of them."""
    schema = "size int, row int, sums binary"
    # The sums of FAN tasks first, so that no group has a row of every task.
    partial = vectors.mapInArrow(_partial(of), schema).withColumn("part", F.floor(F.spark_partition_id() / FAN))
    merged = partial.groupBy("size", "row", "part").applyInArrow(_added(dtype), f"{schema}, part long").drop("part")
    found = merged.groupBy("size", "row").applyInArrow(_added(dtype), schema).orderBy("size", "row").collect()
    out: dict[int, list[np.ndarray]] = {}
    for r in found:
        out.setdefault(r["size"], []).append(np.frombuffer(bytes(r["sums"]), dtype))
    return {size: np.array(rows) for size, rows in out.items()}


def covariance(n: int, rest: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Of vectors less a whole-number centre: ``rest`` are their sums and ``products`` their products, both exact."""
    exact = n * products.astype(object) - np.outer(rest.astype(object), rest.astype(object))
    return np.array([[float(v) for v in row] for row in exact / n], float).reshape(products.shape) / n if len(rest) else np.zeros((0, 0))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models by the vectors' length, from all rows of ``vectors`` (one column of usable vectors)."""
    ones = lambda size, x: np.vstack([x.sum(axis=0), np.full(size, len(x))])
    sums = _summed(vectors, ones)
    centres = {size: s[0] // s[1] for size, s in sums.items()}
    products = _summed(vectors, lambda size, x: _products(x - centres[size]))
    models = {}
    for size, (total, count) in sums.items():
        n = int(count[0])
        v = covariance(n, total - n * centres[size], products[size])
        e, x = eigen(v)
        kept = min(components, int((e > size * _RANK * max(e[0], 0.0)).sum()) if e[0] > 0 else 0)
        models[size] = Model(n, total, x[:, :kept] / np.sqrt(e[:kept]), e[:kept] / np.trace(v) if kept else e[:0])
    return models


def identity_errors(vectors: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length, the largest absolute entry of the whitened vectors' covariance less the identity."""
    sent = vectors.sparkSession.sparkContext.broadcast(models)

    def moments(size: int, x: np.ndarray) -> np.ndarray:
        y = sent.value[size].whitened(x)
        return np.vstack([y.T @ y, y.sum(axis=0)])

    out = {}
    for size, m in _summed(vectors, moments, np.float64).items():
        n, k = models[size].n, m.shape[1]
        mean = m[k] / n
        out[size] = float(np.abs(m[:k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0))
    return out


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``vectors`` (``vec_id`` and ``embedding`` are used) and component, from 1: ``vec_id``,
    ``component``, ``n`` (the number of vectors), ``deviation`` (sum of (n x - S)^2 over the dimensions, exact, or
    null if it is beyond 64 bits), ``whitened``, ``explained`` (the component's share of the variance) and
    ``identity_error`` (the largest error of the whitened vectors' covariance).

    An entry c counts as x = floor(1024 c) + 100000. Vectors that are null, empty, or hold a null or non-finite
    entry take no part; a null id stays null; equal rows are each returned. Vectors of other lengths are whitened
    apart. There are no more components than dimensions in which the vectors vary (none for a single vector);
    an empty table gives no rows. The model is one matrix of dimensions by dimensions for each length.
    """
    own = vectors.filter(usable(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    models = fit(own.select("embedding"), components)
    errors = identity_errors(own.select("embedding"), models)
    sent = vectors.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = sent.value
        for size, rows, x, batch in _numbers(batches, 1):
            m = models[size]
            k = m.axes.shape[1]
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(each), m.n), pa.int64()),
                    pa.array(m.deviations(x), pa.int64()).take(pa.array(each)), pa.array(m.whitened(x).ravel(), pa.float64()),
                    pa.array(np.tile(m.explained, len(x)), pa.float64()), pa.array(np.full(len(each), errors.get(size, 0.0)), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = own.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
