"""Embedding whitening by spectral divide-and-conquer on QDWH polar decompositions.

The covariance, shifted by a number between its eigenvalues, has a polar factor that is +1 on the eigenvectors above
the shift and -1 on those below: half of it plus half of the identity projects on the invariant subspace above. The
covariance is cut into its blocks on both subspaces, and the blocks again, until each is a component. The polar factor
comes from the dynamically weighted Halley iteration in its QR form (a few steps, inverse-free).

Vectors are rounded to whole numbers first, so the counts and sums behind the means are exact. Tasks return sums of a
vector's length and matrices of its square, which are added up on Spark (the vectors' dimension bounds what the
driver sees); the components go back to the tasks with the function that applies them.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written

SCALE = 256
_EPS = float(np.finfo(float).eps)


def qdwh(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a square matrix without a zero singular value."""
    m, n = a.shape
    top = np.linalg.norm(a, 2)
    x = a / top
    # a lower bound of the least singular value: only the number of steps depends on it
    low = max(1.0 / max(np.linalg.cond(x, 1), 1.0) / np.sqrt(n), _EPS ** 2) if n else 1.0
    for _ in range(steps):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * q[:m] @ q[m:].T
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        if moved <= 10 * _EPS * np.sqrt(n) or (abs(1 - low) < 10 * _EPS and moved < _EPS ** (1 / 3)):
            break
    return x


def _shift(a: np.ndarray) -> float:
    """A number between the eigenvalues: off the middle of the diagonal by no more than its spread."""
    d = np.sort(np.diag(a))
    k = len(d) // 2
    return float((d[k - 1] + d[k]) / 2)


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None if ``a`` is a multiple of identity."""
    n = len(a)
    centre = np.trace(a) / n
    spread = np.linalg.norm(a - centre * np.eye(n))
    if spread <= 4 * n * _EPS * max(np.linalg.norm(a), np.finfo(float).tiny):
        return None
    # both sides hold an eigenvalue when the shift is the mean; the median cuts in halves if it is not one itself
    for shift in (_shift(a), centre, centre + 0.1 * spread / n, centre - 0.1 * spread / n):
        shifted = a - shift * np.eye(n)
        if np.linalg.cond(shifted) > 1 / (8 * n * _EPS):
            continue
        u = qdwh(shifted)
        p = (u + u.T) / 4 + np.eye(n) / 2
        rank = int(round(np.trace(p)))
        if not 0 < rank < n:
            continue
        # a basis of the projector's range and of the rest: its columns in the order of their lengths, then a second pass
        order = np.argsort(-np.diag(p), kind="stable")
        q, _ = np.linalg.qr(p[:, order], mode="complete")
        for _ in range(2):
            q, _ = np.linalg.qr(np.hstack([p @ q[:, :rank], (np.eye(n) - p) @ q[:, rank:]]))
        above, below = q[:, :rank], q[:, rank:]
        if np.linalg.norm(above.T @ a @ below) <= 100 * n * _EPS * np.linalg.norm(a):
            return above, below
    return None


def components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Each vector's largest entry is positive (the first of equals), so the same matrix gives the same signs.
    """
    a = (a + a.T) / 2
    n = len(a)
    values, vectors = [], []
    stack = [(a, np.eye(n))]                    # blocks of the matrix, largest eigenvalues on top
    while stack and len(values) < count:
        block, basis = stack.pop()
        cut = _split(block) if len(block) > 1 else None
        if cut is None:
            for j in range(len(block)):
                values.append(float(block[j, j]))
                vectors.append(basis[:, j])
            continue
        for side in reversed(cut):
            part = side.T @ block @ side
            stack.append(((part + part.T) / 2, basis @ side))
    e, v = np.array(values), np.array(vectors).reshape(len(values), n).T
    e = np.einsum("ij,ij->j", v, a @ v) if len(values) else e
    order = np.argsort(-e, kind="stable")[:count]
    e, v = e[order], v[:, order]
    v = v / np.linalg.norm(v, axis=0)
    lead = np.abs(v).argmax(axis=0) if n else []
    return e, v * np.where(v[lead, np.arange(v.shape[1])] < 0, -1.0, 1.0)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``x``: entries c as floor(256 c) (numbers beyond a long saturate).

    Null and empty vectors and those with a null or non-finite entry are left out; where lengths differ, the most
    frequent one stays (the greater of equals).
    """
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("c"))
    rows = rows.where((F.size("c") > 0) & F.forall("c", finite))
    lengths = rows.groupBy(F.size("c").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    rows = rows.where(F.size("c") == (lengths[0]["length"] if lengths else 0))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), -1)


def _column_sums(x: np.ndarray) -> list[Decimal]:
    """Exact sums of whole numbers: high and low halves apart, so no sum of a batch overflows."""
    high, low = (x >> 32).sum(0, dtype=np.int64), (x & 0xFFFFFFFF).sum(0, dtype=np.int64)
    return [Decimal((int(h) << 32) + int(v)) for h, v in zip(high, low)]


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension, exact. A row a task and dimension is added up on Spark."""
    def run(batches):
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                new = _column_sums(_matrix(batch.column(0)))
                n, sums = n + batch.num_rows, new if sums is None else [a + b for a, b in zip(sums, new)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(sums)), pa.int32()), pa.array([Decimal(n), *sums], pa.decimal128(38, 0))], ["d", "total"])

    rows = on_workers(fit).mapInArrow(run, "d int, total decimal(38,0)").groupBy("d").agg(F.sum("total").alias("total")).collect()
    total = {r["d"]: int(r["total"]) for r in rows}
    return total.pop(-1, 0), [total[d] for d in sorted(total)]


def _square(fit: DataFrame, mean: np.ndarray, weights: np.ndarray | None, n: int) -> np.ndarray:
    """The covariance of the vectors of ``fit``, or of their whitened values, divisor ``n``, centred before multiplying."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                c = _matrix(batch.column(0)) - mean
                c = c if weights is None else c @ weights
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["k", "v"])

    size = len(mean) if weights is None else weights.shape[1]
    out = np.zeros(size * size)
    for r in on_workers(fit).mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out.reshape(size, size) / max(n, 1)


def whiten(vectors: DataFrame, count: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    A row for each vector of :func:`whole_vectors` and component (from 1, by falling eigenvalue), at most ``count`` and
    no more than the fit list's covariance has eigenvalues apart from zero (rounding included): vectors that are all
    equal, or a single one, have no component and no rows, as has an empty table. Null and repeated ids give their rows
    like others; other columns are ignored. A ``deviation`` beyond a long is null.
    """
    x = written(whole_vectors(vectors, id_col, vec_col), "whole-vectors")
    fit = written(x.select("x").distinct(), "fit-list")
    n, sums = _totals(fit)
    mean = np.array([s / n for s in sums]) if n else np.zeros(0)
    cov = _square(fit, mean, None, n)
    e, v = components(cov, count)
    real = e > 64 * len(mean) * _EPS * max(np.trace(cov), 0.0) if len(e) else np.zeros(0, bool)
    e, v = e[real], v[:, real]
    weights = v / np.sqrt(e)
    explained = e / np.trace(cov) if len(e) else e
    error = float(np.abs(_square(fit, mean, weights, n) - np.eye(len(e))).max()) if len(e) else 0.0
    k = len(e)
    kind = x.schema["vec_id"].dataType.simpleString()
    whole = np.array(sums, object)

    def run(batches):
        for batch in batches:
            if not (batch.num_rows and k):
                continue
            own = _matrix(batch.column(1))
            rows = len(own)
            values = (own - mean) @ weights
            far = max(abs(int(own.min())), abs(int(own.max()))) * n + max(abs(s) for s in sums)
            if far * far * len(sums) < 1 << 63:
                deviation = ((own * n - whole.astype(np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [d if d < 1 << 63 else None for d in ((own.astype(object) * n - whole) ** 2).sum(1)]
            at = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, n)), pa.array(deviation, pa.int64()).take(pa.array(at)), pa.array(values.ravel()),
                 pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return on_workers(x).mapInArrow(run, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
