"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Components become whole numbers ``floor(scale * c) + OFFSET``.  Every distinct vector counts once.  The scatter of the distinct vectors is
gathered round their rounded mean, in whole numbers that double precision holds exactly, and moved to the true mean in
exact integers at the driver, so it depends on no order.  The scatter has the square of the dimension as cells, whatever the number of rows.

Of the covariance ``V = L L'`` (rows of ``L`` in pivot order are triangular) Jacobi rotations make the columns of ``L``
orthogonal: their squared norms are the eigenvalues, the columns at length 1 the components.  Small eigenvalues keep
their relative accuracy, as ``V`` is never multiplied further.

Defined results: rows are dropped whose vector is null or holds null or non-finite components, or has another length than
most rows have (of equally common lengths the greater counts).  Whole numbers beyond ``LIMIT`` are held at it.  A covariance of lower rank than the components
asked for gives as many components as its rank, none where all vectors are equal.  Equal eigenvalues come in the order of the
pivots.  Repeated rows each get their rows.  A deviation that fits no long is null.  An empty table gives an empty result.  Extra columns, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import stored
from sievework.llm.tally import tally
from sievework.llm.vectors import integers, matrices, usual_length

COMPONENTS, SCALE, LIMIT = 16, 64.0, 2**30
#: Added to whole numbers.  It drops out of every difference to a mean, so it is never carried along.
OFFSET = 1_000_000
SWEEPS, EPSILON = 60, 2.0**-52


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """``f`` with ``f @ f.T`` equal to ``v``: as many columns as the rank, rows in pivot order lower triangular."""
    d = len(v)
    f, left, order = np.zeros((d, d)), v.diagonal().copy(), np.arange(d)
    least = d * EPSILON * left.max(initial=0.0)
    for k in range(d):
        p = k + int(left[order[k:]].argmax())
        if left[order[p]] <= least:
            return f[:, :k]
        order[[k, p]] = order[[p, k]]
        i, rest = order[k], order[k + 1 :]
        f[i, k] = np.sqrt(left[i])
        f[rest, k] = (v[rest, i] - f[rest, :k] @ f[i, :k]) / f[i, k]
        left[rest] -= f[rest, k] ** 2
    return f


def orthogonal_columns(f: np.ndarray) -> np.ndarray:
    """``f`` times rotations that make its columns orthogonal: disjoint pairs of columns turn at once, all pairs in each sweep."""
    d, r = f.shape
    g = np.zeros((r + r % 2, d))
    g[:r] = f.T
    seats = np.arange(len(g))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(g) - 1):
            i, j = seats[: len(g) // 2], seats[len(g) // 2 :][::-1]
            a, b = g[i], g[j]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            size = np.sqrt(aa * bb)
            turn = np.abs(ab) > EPSILON * size
            worst = max(worst, float((np.abs(ab) / np.where(size > 0, size, 1)).max(initial=0.0)))
            z = (bb - aa) / np.where(turn, 2 * ab, 1)
            t = np.where(turn, np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.sqrt(1 + z * z)), 0.0)[:, None]
            c = 1 / np.sqrt(1 + t * t)
            g[i], g[j] = c * (a - t * b), c * (t * a + b)
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
        if worst <= d * EPSILON:
            break
    return g[:r].T


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling, and its unit eigenvectors as columns, as many as its rank."""
    g = orthogonal_columns(pivoted_cholesky(v))
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def covariance(fit: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows of ``fit(v)``, their sums, and their covariance with divisor n."""

    def add_sums(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, x in matrices(batch, 0, d):
            total[0] += len(x)
            total[1 : d + 1] += x.sum(0, dtype=np.int64)

    n, *sums = tally(fit, d + 1, add_sums).tolist()
    centre = np.array([round(s / n) if n else 0 for s in sums], np.int64)

    def add_products(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, x in matrices(batch, 0, d):
            y = (x - centre).astype(np.float64)
            total[: d * d] += (y.T @ y).ravel()

    products = tally(fit, d * d, add_products, "float64").reshape(d, d)
    rest = [s - n * c for s, c in zip(sums, centre.tolist(), strict=True)]  # sums round the centre
    exact = [[(n * int(p) - a * b) / (n * n) for p, b in zip(row, rest, strict=True)] for row, a in zip(products.tolist(), rest, strict=True)]
    return n, np.array(sums, np.int64), np.array(exact, float).reshape(d, d)


def deviations(m: np.ndarray) -> list[int | None]:
    """Exact sums of squares of the rows of a whole-number matrix; None where one fits no 64-bit number."""
    if m.shape[1] * float(np.abs(m).max(initial=0)) ** 2 < 2**62:
        return (m * m).sum(1).tolist()
    exact = [sum(x * x for x in row) for row in m.tolist()]
    return [x if x < 2**63 else None for x in exact]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` for each sound row and component."""
    kept = vectors.select(F.col(id_col).alias("_id"), integers(F.col(vector_col), scale, LIMIT).alias("v")).where("v IS NOT NULL")
    kept = stored(kept)
    d = usual_length(kept, "v")
    kept = kept.where(F.size("v") == d)
    fit = stored(kept.select("v").distinct())
    n, sums, v = covariance(fit, d)
    values, unit = principal(v) if n else (np.empty(0), np.empty((d, 0)))
    k = min(components, len(values))
    along = unit[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / v.trace() if k else values[:0]

    def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = n * x.astype(np.int64) - sums
        return m, (m / n) @ along

    def add_whitened(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, x in matrices(batch, 0, d):
            _, z = scaled(x)
            total[:k] += z.sum(0)
            total[k : k + k * k] += (z.T @ z).ravel()

    whitened = tally(fit, k + k * k, add_whitened, "float64") if k else np.zeros(0)
    mean = whitened[:k] / max(n, 1)
    error = float(np.abs(whitened[k:].reshape(k, k) / max(n, 1) - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in matrices(batch, 1, d) if k else ():
                m, z = scaled(x)
                every = np.repeat(np.arange(i, i + len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(deviations(m), pa.int64()).take(pa.array(every - i)), pa.array(z.ravel()), pa.array(np.tile(explained, len(x)))],
                    names=["_id", "component", "deviation", "whitened", "explained"],
                )

    kind = kept.schema["_id"].dataType.simpleString()
    out = kept.select("_id", "v").mapInArrow(run, f"_id {kind}, component int, deviation long, whitened double, explained double")
    return out.select(F.col("_id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
