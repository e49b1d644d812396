"""Embedding whitening by a randomised range finder and Rayleigh-Ritz.

Vectors are put on a whole-number grid, so that counts, sums and deviations are exact. Covariances are over all vectors,
with divisor n, of centred values: (n*x - S) / n, rounded once.

1. One pass counts the vectors and sums them by dimension.
2. Range finder: the covariance V is applied to a random matrix of k + oversampling columns by one pass over all centred
   rows (each task sums its rows' products), then `passes` times more to an orthonormal basis of what came out.
3. Rayleigh-Ritz: V within the basis gives values and vectors. Its residuals |V u - e u| tell how good they are; where one
   is over `tolerance` times the gap to the next value, and over rounding, the basis is expanded to the full dimension by
   one more pass, after which Rayleigh-Ritz is exact to rounding.
4. The rows are projected on the components and divided by the roots of their values; one more pass measures how far the
   result's covariance is from the identity.

The driver holds matrices of the vectors' dimension alone. Sums of tasks are added up in groups before they get there.

Nulls: a null vector, one with null or non-finite entries, or one shorter than the longest of the others (it lacks
entries) is dropped; a null vec_id is kept; repeated rows count as often as they stand there. Entries beyond 2^43 on the
grid are taken as that. A component whose value is no more than rounding (1e-12 of the largest) can't be whitened and is
left out: an empty table, or vectors that are all equal, give no rows. A deviation beyond 64 bits is null. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, MOST = 1024, 100_000, 1 << 43


def grid(vectors: pa.Array, dim: int) -> np.ndarray:
    """x = floor(1024 c) + 100000 of every vector, as rows."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64).reshape(-1, dim) + SHIFT


def complete(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) of the vectors without null or non-finite entries."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
    return embeddings.where(F.col(vector_col).isNotNull() & (F.size(v) > 0) & finite).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


GROUPS = 32
_SUM = "part long, sum binary"


def added(rows: DataFrame, parts: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], join: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add, kind: type = np.float64) -> np.ndarray | None:
    """The arrays that `parts` makes of each task's rows, added up in order of the tasks: in GROUPS groups by tasks, then by
    the driver, which gets no more than GROUPS arrays, however many tasks there are."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (out := parts(batches)) is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.astype(kind).tobytes()], pa.binary())], ["part", "sum"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, np.ndarray] = {}
        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("sum").to_pylist(), strict=True):
                new = np.frombuffer(data, kind)
                groups[part % GROUPS] = join(groups[part % GROUPS], new) if part % GROUPS in groups else new
        if groups:
            yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array([x.tobytes() for x in groups.values()], pa.binary())], ["part", "sum"])

    summed = rows.mapInArrow(one, _SUM).repartition(GROUPS, F.col("part") % GROUPS).sortWithinPartitions("part").mapInArrow(several, _SUM).collect()
    total = None
    for row in sorted(summed, key=lambda r: r["part"]):
        new = np.frombuffer(row["sum"], kind)
        total = new if total is None else join(total, new)
    return total


def _longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of vectors (count first); shorter vectors than the longest are dropped."""
    return a + b if len(a) == len(b) else max(a, b, key=len)


def _counted(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
    total = None
    for b in batches:
        size = np.asarray(b.column("v").value_lengths())
        if not len(size):
            continue
        dim = int(size.max())
        x = grid(b.column("v").filter(pa.array(size == dim)), dim)
        new = np.concatenate([[len(x)], x.sum(0)])
        total = new if total is None else _longer(total, new)
    return total


@dataclass
class FitList:
    """How many vectors there are, their dimension and their sums by dimension."""

    n: int
    sums: np.ndarray

    def numerators(self, b: pa.RecordBatch) -> np.ndarray:
        """n * x - S, exactly: in 64 bits where these hold it, else in Python's numbers."""
        dim = len(self.sums)
        size = np.asarray(b.column("v").value_lengths())
        x = grid(b.column("v").filter(pa.array(size == dim)), dim)
        if self.n * max(1, int(np.abs(x).max(initial=0))) < 1 << 61:
            return self.n * x - self.sums
        return self.n * x.astype(object) - self.sums.astype(object)

    def centred(self, b: pa.RecordBatch) -> np.ndarray:
        return self.numerators(b).astype(np.float64) / self.n

    def deviations(self, b: pa.RecordBatch) -> list[int | None]:
        top = self.numerators(b)
        if top.dtype == object or (len(top) and len(self.sums) * int(np.abs(top).max()) ** 2 >= 1 << 63):
            exact = (top.astype(object) ** 2).sum(1).tolist()
            return [d if d < 1 << 63 else None for d in exact]
        return (top**2).sum(1).tolist()


def fit_list(rows: DataFrame) -> FitList | None:
    """Of the vectors of `rows` (from `complete`) those of the greatest length; None without any."""
    total = added(rows, _counted, _longer, np.int64)
    return None if total is None else FitList(int(total[0]), total[1:].copy())


def applied(rows: DataFrame, fit: FitList, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """V @ basis and the trace of V, by one pass over all centred rows."""

    def parts(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        out = np.zeros(basis.size + 1)
        for b in batches:
            x = fit.centred(b)
            out[:-1] += (x.T @ (x @ basis)).ravel()
            out[-1] += np.einsum("ij,ij->", x, x)
        return out

    total = added(rows, parts) / fit.n
    return total[:-1].reshape(basis.shape), float(total[-1])


def ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values (falling), vectors and residual norms of V within an orthonormal basis; image is V @ basis."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = basis @ turn
    return values, vectors, np.linalg.norm(image @ turn - vectors * values, axis=0)


@dataclass
class Components:
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    expanded: bool


def components(rows: DataFrame, fit: FitList, k: int = 8, oversampling: int = 8, passes: int = 3, tolerance: float = 1e-12, seed: int = 0) -> Components:
    """The k first eigenvectors of the covariance, fewer where its rank is less."""
    dim = len(fit.sums)
    width = min(dim, k + oversampling)
    start = np.random.default_rng(seed).standard_normal((dim, width))
    image, trace = applied(rows, fit, start)
    for _ in range(passes):
        basis = np.linalg.qr(image)[0]
        image, trace = applied(rows, fit, basis)
    values, vectors, residuals = ritz(basis, image)
    wanted = min(k, dim)
    # How far each value is from its neighbours; what lies beyond the basis is at most about the last value in it.
    below = values[:wanted] - np.append(values, max(values[-1], 0))[1 : wanted + 1]
    gap = np.maximum(np.minimum(below, np.append(np.inf, below[:-1])), 0)
    rounding = 64 * np.finfo(np.float64).eps * abs(values[0])
    expanded = width < dim and bool((residuals[:wanted] > np.maximum(tolerance * gap, rounding)).any())
    if expanded:
        rest = np.random.default_rng(seed + 1).standard_normal((dim, dim - width))
        basis = np.linalg.qr(np.concatenate([basis, rest], 1))[0]
        image, trace = applied(rows, fit, basis)
        values, vectors, _ = ritz(basis, image)
    kept = np.flatnonzero(values[:wanted] > 1e-12 * max(values[0], 0.0))
    return Components(values[kept], vectors[:, kept], trace, expanded)


def whiten(embeddings: DataFrame, k: int = 8, oversampling: int = 8, passes: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, whitened (array: one for each component), explained (array), identity_error of each vector."""
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    rows = complete(embeddings, id_col, vector_col)
    fit = fit_list(rows)
    if fit is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    found = components(rows, fit, k, oversampling, passes)
    if not len(found.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    frame = found.vectors / np.sqrt(found.values)
    width = frame.shape[1]

    def spread(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        out = np.zeros(width * (width + 1))
        for b in batches:
            w = fit.centred(b) @ frame
            out += np.concatenate([(w.T @ w).ravel(), w.sum(0)])
        return out

    total = added(rows, spread) / fit.n
    mean = total[width * width :]
    error = float(np.abs(total[: width * width].reshape(width, width) - np.outer(mean, mean) - np.eye(width)).max())
    explained = (found.values / found.trace).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.filter(pa.array(np.asarray(b.column("v").value_lengths()) == len(fit.sums)))
            w = fit.centred(own) @ frame
            m = len(w)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * width, pa.int32()), pa.array(w.ravel()))
            shares = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * width, pa.int32()), pa.array(np.tile(explained, m)))
            yield pa.RecordBatch.from_arrays([own.column("vec_id"), pa.array(np.full(m, fit.n)), pa.array(fit.deviations(own), pa.int64()), lists, shares, pa.array(np.full(m, error))], ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, numbered from 1."""
    each = whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
