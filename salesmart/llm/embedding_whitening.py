"""Whitening of embeddings: leading components by block Jacobi-Davidson.

Entries become whole numbers x = floor(256 * c).  The fit list holds each
distinct x vector once: n vectors with the sums S of their dimensions.  The
covariance V (divisor n) is never formed.  The operator only ever multiplies
it with a few columns: each task centres its vectors, multiplies, and hands on
one small sum.

1. Rayleigh-Ritz in a subspace of at most ``MOST_BASIS`` columns gives the
   leading pairs, largest first, and their residuals.
2. A pair whose residual is at double precision (``PRECISION`` times the norm
   of V) is locked: it leaves the subspace, and all later work is orthogonal
   to it.
3. For the other wanted pairs the projected correction equations
   (I - Z Z') (V - theta I) (I - Z Z') t = -r are solved by inner MINRES, Z
   being the locked vectors and the wanted Ritz vectors.  The equations run
   in step, so one distributed product serves all of them.
4. The corrections are made orthogonal and extend the subspace.

Ends when all wanted pairs are locked; a last Rayleigh-Ritz step over them
checks the residuals again with a fresh product.

Bounds: the driver holds subspaces of ``dimensions x MOST_BASIS`` numbers and at
most ``SLOTS`` partial sums; tasks hold one batch of vectors.  Nothing there
grows with the rows.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries, or ones of 2 ** 40 or more after scaling, are dropped; vectors of
another length than the most frequent one (of equally frequent ones the longest) cannot be whitened with the others and are dropped; repeated rows and
equal vectors each get their result, and count once in the fit; components
with less than 1e-13 of the variance are rounding and have none, so there may
be fewer than asked for, and no rows at all where all vectors are equal; a
deviation that does not fit 63 bits is null; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, staged

#: The scale of the whole numbers, and the components wanted.
SCALE, COMPONENTS = 256, 4
#: Scaled entries beyond this are not taken.
MOST_ENTRY = 1 << 40
#: Residuals at double precision, as parts of the largest eigenvalue.
PRECISION = 64 * np.finfo(float).eps
#: Columns of the subspace, and those kept when it is begun again.
MOST_BASIS, KEPT_BASIS = 56, 24
#: Columns of the first subspace, steps of the inner solver, and rounds before the solver gives up.
FIRST_BASIS, INNER_STEPS, ROUNDS = 16, 6, 200
#: Correction equations solved together.
TOGETHER = 16
#: Groups in which the sums of tasks are added before they reach the driver.
SLOTS = 64


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a batch, one a row."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def summed(fit: DataFrame, length: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum over all batches of ``part`` of their vectors, added up in two steps in the order of the tasks."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column(0), length))
                total = own if total is None else total + own
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"slot": pa.array([task % SLOTS], pa.int32()), "task": pa.array([task], pa.int32()), "total": [pickle.dumps(total)]}
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, None
        for batch in batches:
            for task, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = pickle.loads(own)
                total, first = (own, task) if total is None else (total + own, first)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"task": pa.array([first], pa.int32()), "total": [pickle.dumps(total)]})

    parts = (
        fit.mapInArrow(gather, "slot int, task int, total binary")
        .repartition("slot")
        .sortWithinPartitions("task")
        .mapInArrow(add, "task int, total binary")
        .collect()
    )
    totals = [pickle.loads(row["total"]) for row in sorted(parts, key=lambda row: row["task"])]
    return sum(totals[1:], totals[0]) if totals else None


def moments(fit: DataFrame, length: int) -> tuple[int, list[int], list[int]]:
    """n, the sums and the sums of squares of each dimension, exactly."""

    def part(x: np.ndarray) -> np.ndarray:
        exact = x if np.abs(x).max(initial=0) < 1 << 24 else x.astype(object)  # 10,000 squares of it fit 63 bits
        rows = [len(x)] * x.shape[1]
        return np.array([rows, exact.sum(axis=0).tolist(), (exact * exact).sum(axis=0).tolist()], dtype=object)

    total = summed(fit, length, part)
    return int(total[0][0]), [int(v) for v in total[1]], [int(v) for v in total[2]]


def covariance_product(fit: DataFrame, mean: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """The distributed product of the covariance with a few columns."""

    def product(columns: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ columns)

        return summed(fit, len(mean), part) / n

    return product


def orthogonal(columns: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The part of ``columns`` orthogonal to the bases, as an orthonormal basis; what is left of none is dropped."""
    kept = []
    for column in columns.T:
        size = np.linalg.norm(column)
        for _ in range(3):  # again, as rounding leaves some of the bases in
            for basis in bases:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            left = np.linalg.norm(column)
            if left <= 1e-10 * size or left == 0:
                break
            column, size = column / left, 1.0
        else:
            kept.append(column)
    return np.array(kept).reshape(len(kept), len(columns)).T


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, least: float, steps: int) -> np.ndarray:
    """Approximate solutions of the symmetric (maybe indefinite) systems, one a column, in step.

    A column stops when its residual has fallen to ``least`` of the first one.
    """
    first = np.linalg.norm(right, axis=0)
    going = first > 0
    v = np.divide(right, first, out=np.zeros_like(right), where=going)
    v_old, w, w_old, x = (np.zeros_like(right) for _ in range(4))
    beta, eta = np.zeros(len(first)), first.copy()
    c_old, s_old, c, s = np.ones(len(first)), np.zeros(len(first)), np.ones(len(first)), np.zeros(len(first))
    for _ in range(steps):
        if not going.any():
            break
        at = np.flatnonzero(going)
        u = np.zeros_like(right)
        u[:, at] = product(v, at)
        alpha = (v * u).sum(axis=0)
        u = u - alpha * v - beta * v_old
        after = np.linalg.norm(u, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, after)
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        going &= rho1 > 0
        safe = np.where(going, rho1, 1.0)
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        c_old, s_old, c, s = c, s, delta / safe, after / safe
        x = x + np.where(going, c * eta, 0.0) * w
        eta = -s * eta
        going &= (np.abs(eta) > least * first) & (after > 1e-14 * first)
        v_old, v = v, np.divide(u, after, out=np.zeros_like(u), where=going)
        beta = after
    return x


def ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, largest first, with the vectors and their images."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], basis @ turn[:, ::-1], image @ turn[:, ::-1]


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], length: int, wanted: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues, their unit vectors, and the largest residual over the norm.

    ``product`` multiplies a symmetric non-negative matrix with some columns.
    """
    rng = np.random.default_rng(11)
    wanted = min(wanted, length)
    locked = np.zeros((length, 0))
    basis = orthogonal(rng.standard_normal((length, min(length, max(FIRST_BASIS, wanted)))))
    image = product(basis)
    norm, best, stale = 0.0, np.inf, 0
    for turn in range(ROUNDS):
        values, basis, image = ritz(basis, image)
        norm = max(norm, values[0]) if len(values) else norm
        open_ = wanted - locked.shape[1]
        residual = image - basis * values
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual[:, :open_], axis=0)
        # rounding can keep the residuals a little above the aim; then no turn makes them smaller
        whole = basis.shape[1] + locked.shape[1] == length
        stale = stale + 1 if len(sizes) and sizes[0] > best / 2 else 0
        best = min(best, sizes[0]) if len(sizes) else best
        aim = PRECISION * (1 if stale < 3 and not whole else 64) * max(norm, np.finfo(float).tiny)
        done = 0
        while done < len(sizes) and sizes[done] <= aim:
            done += 1
        if done:
            locked = np.hstack((locked, basis[:, :done]))
            basis, image, residual, values = basis[:, done:], image[:, done:], residual[:, done:], values[done:]
            best, stale = np.inf, 0
        open_ -= done
        if not open_ or not basis.shape[1]:
            break
        if basis.shape[1] > MOST_BASIS:
            basis, image = basis[:, :KEPT_BASIS], image[:, :KEPT_BASIS]
        # pairs next to the wanted ones are corrected with them: they share the product and clear the way
        several = min(max(open_, TOGETHER), basis.shape[1])
        theta, near = values[:several], np.hstack((locked, basis[:, :several]))

        def projected(v: np.ndarray, at: np.ndarray) -> np.ndarray:
            v = v[:, at]
            out = product(v) - v * theta[at]
            return out - near @ (near.T @ out)

        right = -residual[:, :several]
        right -= near @ (near.T @ right)
        correction = minres(projected, right, max(2.0 ** -(turn + 2), 1e-3), INNER_STEPS)
        fresh = orthogonal(correction, locked, basis)
        if not fresh.shape[1]:  # the corrections brought nothing new
            fresh = orthogonal(rng.standard_normal((length, 1)), locked, basis)
        if fresh.shape[1]:
            basis, image = np.hstack((basis, fresh)), np.hstack((image, product(fresh)))
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} of {wanted} components did not reach double precision")
    locked, _ = np.linalg.qr(locked)
    values, vectors, images = ritz(locked, product(locked))
    return values, vectors, float(np.abs(np.linalg.norm(images - vectors * values, axis=0)).max() / max(norm, np.finfo(float).tiny))


def whole_numbers(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): the usable rows with their entries as whole numbers."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c * SCALE) >= MOST_ENTRY))
    usable = rows.where(F.coalesce((F.size("v") > 0) & ~bad, F.lit(False)))
    return usable.select("id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def embedding_whitening(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``vectors`` and component: the id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ship(spark)
    out = T.StructType(
        [
            T.StructField(id, vectors.schema[id].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    rows = staged(whole_numbers(vectors, id, vector), "whole")
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "length")).alias("most")).first()["most"]
    if most is None:
        return spark.createDataFrame([], out)
    length = most["length"]
    rows = rows.where(F.size("x") == length)
    fit = staged(rows.select("x").distinct(), "fit")

    n, sums, squares = moments(fit, length)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    trace = float(Fraction(sum(n * q - s * s for s, q in zip(sums, squares)), n * n))
    if not trace > 0:
        return spark.createDataFrame([], out)
    values, axes, _ = jacobi_davidson(covariance_product(fit, mean, n), length, components)
    varied = values > 1e-13 * trace  # below, rounding is all there is
    values, axes = values[varied], axes[:, varied]
    turned = axes / np.sqrt(values)

    def second(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ turned
        return np.vstack((white.T @ white, white.sum(axis=0)))

    total = summed(fit, length, second) / n
    covariance = total[:-1] - np.outer(total[-1], total[-1])
    error = float(np.abs(covariance - np.eye(len(values))).max())
    k, parts = len(values), (values / trace).tolist()
    exact_sums = np.array(sums, dtype=object)

    def deviations(x: np.ndarray) -> list[int | None]:
        most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
        if most * most * length < 1 << 63:
            centred = n * x - exact_sums.astype(np.int64)
            return (centred * centred).sum(axis=1).tolist()
        centred = n * x.astype(object) - exact_sums
        found = (centred * centred).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), length)
            white = (x - mean) @ turned
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_pydict(
                {
                    id: batch.column(0).take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(each), n, np.int64)),
                    "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                    "whitened": pa.array(white.reshape(-1)),
                    "explained": pa.array(np.tile(parts, len(x))),
                    "identity_error": pa.array(np.full(len(each), error)),
                }
            )

    return rows.mapInArrow(whiten, out)
