"""Tables of a fixed number of cells, summed over all rows of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of one shuffled block, and groups that each block is summed in before the last sum.
BLOCK, TURNS = 8192, 32


def _sums(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    """One row for each (turn, block) of the rows, their cells added up."""
    whole = zstandard.ZstdDecompressor().decompress
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for turn, block, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cells = np.frombuffer(whole(packed), dtype)
            if (turn, block) in held:
                held[turn, block] += cells
            else:
                held[turn, block] = cells.copy()
    yield _rows([(turn, block, cells) for (turn, block), cells in held.items()])


def _rows(blocks: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return pa.RecordBatch.from_arrays(
        [pa.array([b[0] for b in blocks], pa.int32()), pa.array([b[1] for b in blocks], pa.int32()), pa.array([squeeze(b[2].tobytes()) for b in blocks], pa.binary())],
        names=["turn", "block", "packed"],
    )


def tally(df: DataFrame, cells: int, add: Callable[[np.ndarray, pa.RecordBatch], None], dtype: str = "int64") -> np.ndarray:
    """``cells`` numbers: each task lets ``add`` put its batches into an array of zeros, and the tasks' arrays are summed.

    The arrays travel in compressed blocks and are summed in two rounds, so a reducer adds up to a ``TURNS``-th of the
    tasks' blocks, one at a time.  The driver gets the sums alone, ``cells`` numbers whatever the input.
    """
    schema = "turn int, block int, packed binary"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-cells // BLOCK) * BLOCK, dtype)
        for batch in batches:
            if len(batch):
                add(total, batch)
        parts = total.reshape(-1, BLOCK)
        yield _rows([(0, int(i), parts[i]) for i in np.flatnonzero(parts.any(1))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sums(batches, dtype)

    parts = df.mapInArrow(fold, schema).withColumn("turn", F.spark_partition_id() % TURNS)
    parts = parts.repartition("turn", "block").mapInArrow(reduce, schema).withColumn("turn", F.lit(0))
    total = np.zeros(-(-cells // BLOCK) * BLOCK, dtype).reshape(-1, BLOCK)
    for batch in parts.repartition("block").mapInArrow(reduce, schema).toArrow().to_batches():
        for block, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            total[block] += np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype)
    return total.ravel()[:cells]
