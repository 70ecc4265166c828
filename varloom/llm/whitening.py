"""Embedding whitening by spectral divide and conquer on polar decompositions.

Entries become whole numbers x = floor(64 * c) + 1000000.  Sums over the table are exact decimals; the covariance is summed from
centred products, one partial matrix per task.  Its eigenvectors come from QDWH: the polar factor U of the covariance minus a
shift is +1 on the eigenvectors above the shift and -1 below, so (U + I) / 2 projects on an invariant subspace.  An orthonormal
basis of it and of its complement splits the covariance into two smaller ones, which are split in turn until single components
are left.  The matrix has one row and column per dimension, whatever the number of rows; only it and the component matrix pass
through the driver.  The component matrix is broadcast, and rows are whitened in Arrow batches.

The whitened covariance is measured on the rows themselves, in a pass over the written result.

Defined cases: a vector that is null, empty, or holds a null, NaN or infinite entry, or one of 2^46 and more, is left out; so are
vectors whose length is not the most frequent one (ties: the longer one), as one covariance has one dimension; components whose
variance is zero in double precision are none, so equal rows or a single row give no result; a null id stays null; rows that
repeat an id count and return each time; a deviation beyond 38 digits is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import slices
from varloom.operators.materialize import stored

SCALE, OFFSET = 64, 1_000_000
#: Entries from here on leave the whole numbers that a double holds exactly.
MOST = float(1 << 46)
_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: its matrix sign, by the dynamically weighted Halley iteration."""
    n = len(a)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(float).tiny)
    # the least singular value from below; a shift next to an eigenvalue leaves it near zero
    r = np.linalg.qr(x, mode="r")
    least = np.abs(np.diag(r)).min()
    low = 1.0 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(r), 1)) if least > n * _EPS else _EPS
    low, eye = min(max(low, _EPS), 1.0), np.eye(n)
    for _ in range(30):
        square = low * low
        step = np.cbrt(4.0 * (1.0 - square) / square**2)
        root = np.sqrt(1.0 + step)
        a_k = root + 0.5 * np.sqrt(max(8.0 - 4.0 * step + 8.0 * (2.0 - square) / (square * root), 0.0))
        b_k = (a_k - 1.0) ** 2 / 4.0
        c_k = a_k + b_k - 1.0
        if c_k > 100.0:
            q = np.linalg.qr(np.vstack((np.sqrt(c_k) * x, eye)))[0]
            moved = (b_k / c_k) * x + (a_k - b_k / c_k) / np.sqrt(c_k) * (q[:n] @ q[n:].T)
        else:
            moved = (b_k / c_k) * x + (a_k - b_k / c_k) * np.linalg.solve(eye + c_k * (x.T @ x), x.T).T
        moved = (moved + moved.T) / 2.0
        low = min(low * (a_k + b_k * square) / (1.0 + c_k * square), 1.0)
        change = np.linalg.norm(moved - x)
        x = moved
        if change <= np.cbrt(4.0 * _EPS) and 1.0 - low <= 10 * _EPS:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    diagonal = np.diag(a)
    mean = float(diagonal.mean())
    spread = max(float(np.linalg.norm(a - mean * np.eye(len(a)))) / np.sqrt(len(a)), _EPS * abs(mean))
    yield float(np.median(diagonal))
    yield mean
    # next to the mean lie shifts that part the spectrum without touching an eigenvalue
    for i in range(1, 20):
        yield mean + spread * (i * 0.6180339887 % 1.0 - 0.5)


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int]:
    """Orthogonal basis whose first columns span the eigenvectors above a shift, and their number."""
    n = len(a)
    rng = np.random.default_rng(n)
    best = None
    for shift in _shifts(a):
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2.0
        k = int(round(float(np.trace(projector))))
        if not 0 < k < n:
            continue
        start = np.linalg.qr(projector @ rng.standard_normal((n, k)))[0]
        basis = np.linalg.qr(projector @ start, mode="complete")[0]
        left = float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))
        if best is None or left < best[0]:
            best = (left, basis, k)
        if left <= 4 * np.sqrt(n) * _EPS * scale:
            break
    return (best[1], best[2]) if best else (np.eye(n), 1)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and the eigenvectors as columns of a symmetric matrix."""
    n = len(a)
    scale = float(np.linalg.norm(a))
    parts: list[np.ndarray] = []
    todo = [np.eye(n)] if n else []
    while todo:
        basis = todo.pop()
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2.0
        off = inner - np.diag(np.diag(inner))
        if len(inner) == 1 or np.linalg.norm(off) <= _EPS * scale:
            parts.append(basis)
            continue
        turned, k = _split(inner, scale)
        todo += [basis @ turned[:, k:], basis @ turned[:, :k]]
    vectors = np.hstack(parts) if parts else np.zeros((n, n))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _rows(width: int) -> int:
    """Rows of about a million entries, so that a batch's memory does not grow with the dimension."""
    return max(1, (1 << 20) // max(width, 1))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _sum_matrix(rows: DataFrame, name: str, width: int, mean: np.ndarray, exact: np.ndarray | None = None) -> np.ndarray:
    """Sum over all rows of the products of ``rows[name]`` less ``mean``; whole numbers are first shifted by ``exact``."""
    lower = np.tril_indices(width)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in slices(batches, _rows(width)):
            values = _matrix(batch.column(name), width)
            centred = (values if exact is None else (values - exact).astype(float)) - mean
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(lower[0].astype(np.int32)), pa.array(lower[1].astype(np.int32)), pa.array(total[lower])], ["i", "j", "v"]
        )

    total = np.zeros((width, width))
    sums = rows.select(name).mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for i, j, v in sums.toLocalIterator():  # one row per pair of dimensions
        total[i, j] = total[j, i] = v
    return total


def scaled(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows as a written table, and their dimension."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < MOST), F.lit(False)))
    whole = F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.when(good & (F.size(vector) > 0), whole).alias("x"))
    rows = stored(rows.filter("x is not null"), "whitening")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    return rows.filter(F.size("x") == width), width


@dataclass(frozen=True)
class Model:
    """What whitening needs: all arrays have one entry per dimension."""

    n: int
    sums: tuple[int, ...]
    #: eigenvalues that are kept, in falling order, and the trace of the covariance
    values: np.ndarray
    trace: float
    #: dimensions x kept components, each divided by the root of its eigenvalue
    weights: np.ndarray

    @property
    def whole_mean(self) -> np.ndarray:
        return np.array([round(s / self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest_mean(self) -> np.ndarray:
        """What the mean has beyond ``whole_mean``, without cancellation."""
        return np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.whole_mean)])


def fit(rows: DataFrame, width: int, components: int = 32) -> Model:
    """Whitening of all ``rows`` (vec_id, x), which have ``width`` entries each."""
    sums, n = [0] * width, 0
    added = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at")
    for at, total, count in added.agg(F.sum(F.col("v").cast("decimal(20,0)")), F.count("*")).collect():  # one row per dimension
        sums[at], n = int(total), count
    if not n:
        return Model(0, (), np.zeros(0), 0.0, np.zeros((0, 0)))
    plain = Model(n, tuple(sums), np.zeros(0), 0.0, np.zeros((0, 0)))
    covariance = _sum_matrix(rows, "x", width, plain.rest_mean, plain.whole_mean) / n
    values, vectors = eigen(covariance)
    kept = min(components, int((values > width * _EPS * max(values[0], 0.0)).sum()))
    return Model(n, tuple(sums), values[:kept], float(np.trace(covariance)), vectors[:, :kept] / np.sqrt(values[:kept]))


def whiten(rows: DataFrame, width: int, model: Model) -> DataFrame:
    """vec_id, deviation (exact, decimal(38,0)) and whitened (array<double>) of ``rows`` as a written table."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def turned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        whole, rest, n = m.whole_mean, m.rest_mean, m.n
        left = [n * int(w) - s for w, s in zip(whole, m.sums)]
        for batch in slices(batches, _rows(width)):
            z = _matrix(batch.column("x"), width) - whole
            white = (z.astype(float) - rest) @ m.weights
            if width * (n * (int(np.abs(z).max(initial=0)) + 1)) ** 2 < 1 << 63:
                deviation = pa.array(((n * z + np.array(left, dtype=np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                exact = [sum((n * v + r) ** 2 for v, r in zip(row, left)) for row in z.tolist()]
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            ends = np.arange(len(z) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))],
                ["vec_id", "deviation", "whitened"],
            )

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return stored(rows.mapInArrow(turned, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>"), "whitened")


def identity_error(white: DataFrame, n: int, kept: int) -> float:
    """Largest absolute entry of the covariance of ``white`` (a table of :func:`whiten`) less the identity, measured on its rows."""
    if not kept:
        return 0.0
    means = np.zeros(kept)
    for at, mean in white.select(F.posexplode("whitened").alias("at", "v")).groupBy("at").agg(F.avg("v")).collect():
        means[at] = mean
    return float(np.abs(_sum_matrix(white, "whitened", kept, means) / n - np.eye(kept)).max())


def components(embeddings: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows, width = scaled(embeddings, id_col, vector_col)
    model = fit(rows, width, components)
    white = whiten(rows, width, model)
    kept = len(model.values)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if kept else F.array(F.lit(0.0))
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(identity_error(white, model.n, kept)).alias("identity_error"),
    )
