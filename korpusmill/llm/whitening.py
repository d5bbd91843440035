"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become whole numbers, so sums and deviations are exact. The covariance
V of the distinct vectors is never formed: Spark passes over their stored
blocks give V times a block of vectors, each vector centred before it is
multiplied. A Chebyshev polynomial of V, evaluated by its three-term recurrence
with one pass a degree, damps all eigenvalues below the block's; QR and
Rayleigh-Ritz follow, until residuals certify the leading eigenpairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.session import shared_folder, store

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Vectors of the block beyond the wanted ones, a filter's degrees, and its aim: how much more the last wanted eigenvalue grows than the damped ones.
GUARD, DEGREES, AIM = 32, (4, 40), 1e9
#: Of the largest eigenvalue: residuals of certified pairs, and what counts as no variance.
CERTIFIED, NOTHING, MAX_FILTERS = 1e-13, 1e-12, 60
#: Numbers a stored block of vectors and a row of a batch hold, and rows of partial sums that reach the driver.
BLOCK_NUMBERS, MOST_SUMS = 1 << 18, 64
#: Entries of this size and more have no exact whole number.
_LARGEST = 2.0**46


def whole_vectors(rows: DataFrame, column: str) -> DataFrame:
    """Adds ``x``: the vector as whole numbers; null if it is null, or an entry is null, not finite or of 2^46 or more."""
    c = F.col(column)
    sound = c.isNotNull() & F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < _LARGEST, F.lit(False)))
    x = F.transform(c, lambda e: (F.floor(e.cast("double") * SCALE) + SHIFT).cast("bigint"))
    return rows.withColumn("x", F.when(sound, x))


# --- passes over the stored vectors
def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _to_blocks(dim: int):
    rows = max(1, BLOCK_NUMBERS // dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block():
            return pa.record_batch({"block": pa.array([np.concatenate(held).astype("<i8").tobytes()], pa.binary())})

        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), rows):
                held.append(x[at : at + rows])
                size += len(held[-1])
                if size >= rows:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    return run


def _added(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column(0):
                own = np.frombuffer(raw.as_py(), kind)
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch({"part": pa.array([total.tobytes()], pa.binary())})

    return run


@dataclass
class Fit:
    """The stored distinct vectors: how many, their length, and the exact sums of each dimension."""

    blocks: DataFrame
    dim: int
    n: int
    sums: np.ndarray

    def total(self, of_block: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray | None:
        """The sum over all blocks of what a function makes of one (a flat array of one size); None without blocks."""
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for raw in batch.column(0):
                    own = of_block(np.frombuffer(raw.as_py(), "<i8").reshape(-1, dim))
                    total = own if total is None else total + own
            if total is not None:
                yield pa.record_batch({"place": pa.array([TaskContext.get().partitionId()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

        parts = self.blocks.mapInArrow(run, "place int, part binary")
        if self.blocks.rdd.getNumPartitions() > MOST_SUMS:
            parts = parts.repartition(MOST_SUMS, "place").select("part").mapInArrow(_added(kind), "part binary").select(F.lit(0).alias("place"), "part")
        rows = sorted((r["place"], bytes(r["part"])) for r in parts.collect())  # MOST_SUMS rows at most
        return sum(np.frombuffer(r, kind) for _, r in rows) if rows else None

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n  # whole numbers up to the division

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        centre, n = self.centre(), self.n

        def of_block(x):
            c = centre(x)
            return (c.T @ (c @ q)).ravel()

        return self.total(of_block, "<f8").reshape(q.shape) / n


def distinct_vectors(rows: DataFrame, dim: int) -> Fit:
    """Stores each distinct ``x`` of ``dim`` entries once. Copies meet in map-side aggregates."""
    spark = rows.sparkSession
    distinct = rows.where(F.size("x") == dim).select("x").distinct()
    blocks = store(distinct.mapInArrow(_to_blocks(dim), "block binary"), shared_folder(spark, "vectors"))
    fit = Fit(blocks, dim, 0, np.zeros(dim, np.int64))
    sums = fit.total(lambda x: np.append(x.sum(axis=0), len(x)), "<i8")
    if sums is not None:
        fit.n, fit.sums = int(sums[-1]), sums[:-1]
    return fit


# --- eigenpairs
@dataclass
class Spectrum:
    """Leading eigenpairs of V by falling eigenvalue, V's trace, the residuals that certify them, and the passes it took."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def _least_value(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> float:
    """A guess at the smallest eigenvalue from some Lanczos steps, for the damped interval's lower end."""
    q, before, beta, basis, diagonal, off = start / np.linalg.norm(start), None, 0.0, [], [], []
    for _ in range(steps):
        basis.append(q)
        w = times(q[:, None])[:, 0]
        diagonal.append(float(q @ w))
        w -= np.array(basis).T @ (np.array(basis) @ w)
        w -= np.array(basis).T @ (np.array(basis) @ w)
        beta = float(np.linalg.norm(w))
        if beta <= 1e-12 * abs(diagonal[0]):
            beta = 0.0
            break
        off.append(beta)
        q = w / beta
    off = off[: len(diagonal) - 1]
    return float(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))[0])


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dim: int, trace: float, wanted: int, guard: int = GUARD, seed: int = 1) -> Spectrum:
    """The ``wanted`` leading eigenpairs of a symmetric operator without negative eigenvalues.

    Ends when ``wanted`` residuals are below CERTIFIED times the largest
    eigenvalue, or no filter lowers them any more and they are below a thousand
    times that; else raises ArithmeticError. Eigenvalues under NOTHING times
    the largest one are left out.
    """
    wanted = min(wanted, dim)
    size, passes = min(dim, wanted + guard), 0
    if trace <= 0 or not wanted:
        return Spectrum(np.zeros(0), np.zeros((dim, 0)), trace, np.zeros(0), 0)

    def apply(q):
        nonlocal passes
        passes += 1
        return times(q)

    rng = np.random.default_rng(seed)
    low = max(0.0, _least_value(apply, rng.standard_normal(dim), min(dim, 10))) * 0.98 if size < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, size)))[0]
    vq, best, stale = apply(q), np.inf, 0
    for _ in range(MAX_FILTERS):
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        order = np.argsort(-values, kind="stable")
        values, turn = values[order], turn[:, order]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        worst = residuals.max()
        stale = stale + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if size == dim or worst <= CERTIFIED * values[0] or stale > 2 and worst <= 1000 * CERTIFIED * values[0]:
            kept = values[:wanted] > NOTHING * values[0]
            return Spectrum(values[:wanted][kept], q[:, :wanted][:, kept], trace, residuals[kept], passes)
        # Damp [low, cut] by the recurrence T(k + 1) = 2 t T(k) - T(k - 1), scaled to stay near one at the top.
        cut = max(values[-1], 1e-6 * values[0])
        low = min(low, 0.9 * cut)
        half, mid = (cut - low) / 2, (cut + low) / 2
        reach = np.arccosh(max((values[wanted - 1] - mid) / half, 1 + 1e-6))
        degree = int(np.clip(np.ceil(np.log(AIM) / reach), *DEGREES))
        s = first = half / (values[0] - mid) if values[0] > mid + half else 1.0
        old, new = q, (vq - mid * q) * (first / half)
        for _ in range(2, degree + 1):
            following = 1 / (2 / first - s)
            old, new = new, (apply(new) - mid * new) * (2 * following / half) - (s * following) * old
            s = following
        q = np.linalg.qr(new)[0]
        vq = apply(q)
    raise ArithmeticError(f"eigenpairs not certified: residual {worst:.3g} of {values[0]:.3g}")


def spectrum(fit: Fit, components: int = COMPONENTS) -> Spectrum:
    """Leading eigenpairs of the covariance of the fitted vectors."""
    if fit.n < 2:
        return Spectrum(np.zeros(0), np.zeros((fit.dim, 0)), 0.0, np.zeros(0), 0)
    centre = fit.centre()
    trace = float(fit.total(lambda x: np.array([np.square(centre(x)).sum()]), "<f8")[0]) / fit.n
    return leading_pairs(fit.times, fit.dim, trace, min(components, fit.n - 1))


# --- whitening
_WHITE = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None beyond 64 bits."""
    d = n * x - sums
    if d.size and float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0**62:
        return np.square(d).sum(axis=1).tolist()
    out = [sum(v * v for v in row) for row in d.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every sound row's leading components, whitened: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, or holds a null, a number that is not finite or
    one of 2^46 or more, are left out, and so are vectors of another length
    than the commonest one (the longest of equally common ones) and empty ones.
    The model is fitted on the distinct vectors of the others (``n``); repeated
    rows are all returned. Components are numbered from 1 by falling
    eigenvalue, ``components`` at most, and as many as have any variance: one
    distinct vector, or none, gives no row. ``deviation`` is null where it is
    beyond 64 bits. ``identity_error`` is measured by a pass over the fitted
    vectors. Other columns are ignored.
    """
    spark = rows.sparkSession
    sound = whole_vectors(rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(column).alias("vector")), "vector")
    sound = sound.where("size(x) > 0").select("vec_id", "x")
    lengths = sound.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], _WHITE)
    fit = distinct_vectors(sound, lengths[0]["dim"])
    found = spectrum(fit, components)
    k = len(found.values)
    if not k:
        return spark.createDataFrame([], _WHITE)
    centre, project = fit.centre(), found.vectors / np.sqrt(found.values)
    covariance = fit.total(lambda x: (lambda w: (w.T @ w).ravel())(centre(x) @ project), "<f8").reshape(k, k) / fit.n
    error, explained = float(np.abs(covariance - np.eye(k)).max()), found.values / found.trace
    n, sums, step = fit.n, fit.sums, max(1, BLOCK_NUMBERS // max(fit.dim, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x, size = _matrix(part.column(1)), part.num_rows
                each = np.repeat(np.arange(size), k)
                yield pa.record_batch({
                    "vec_id": part.column(0).take(pa.array(each)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), size),
                    "n": np.full(size * k, n, np.int64), "deviation": pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                    "whitened": (centre(x) @ project).ravel(), "explained": np.tile(explained, size), "identity_error": np.full(size * k, error),
                })

    return sound.where(F.size("x") == fit.dim).mapInArrow(run, _WHITE)
