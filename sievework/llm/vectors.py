"""Columns of vectors as whole numbers, and Arrow batches of them as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose arrays are worked on at once.
ROWS = 2048


def integers(vector: Column, scale: float, limit: int) -> Column:
    """``floor(scale * component)`` in double precision, kept within ``limit``; null for a vector that is null or holds null or non-finite components."""
    v = vector.cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(limit))), F.lit(float(-limit)))).cast("int"))
    return F.when(sound, whole)


def usual_length(rows: DataFrame, vector_col: str) -> int:
    """The commonest length of the vectors, the greater of equally common ones; 0 without vectors."""
    counted = rows.groupBy(F.size(vector_col).alias("d")).count().agg(F.max(F.struct("count", "d"))["d"].alias("d"))
    return counted.first()["d"] or 0


def matrices(batch: pa.RecordBatch, column: int, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """Up to ``ROWS`` rows of a batch at a time: the first row's place, and their vectors of length ``d`` as a matrix."""
    for i in range(0, len(batch), ROWS):
        part = batch.column(column).slice(i, ROWS)
        yield i, part.flatten().to_numpy().reshape(len(part), d)
