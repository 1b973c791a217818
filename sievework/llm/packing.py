"""Texts compressed before a shuffle and restored after it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.words import HELD_BYTES, slices


def numbered(docs: DataFrame, keep: Sequence[str], *more: Column) -> tuple[DataFrame, list[str]]:
    """``docs``' columns ``keep`` under names that clash with none, and ``more``; and those names with their types, as SQL."""
    held = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], *more)
    return held, [f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]


def renamed(out: DataFrame, keep: Sequence[str], made: Sequence[str]) -> DataFrame:
    """``out`` with the columns ``keep`` under their own names again; one named like a column in ``made`` gives way."""
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep) if c not in made], *made)


def in_slices(batches: Iterator[pa.RecordBatch], column: int, held: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their text (or binary) column holds up to ``held`` bytes, or one row; freed memory goes back at the end."""
    for batch in batches:
        for i, j in slices(batch.column(column), held):
            yield batch.slice(i, j - i)
        batch = None
    pa.default_memory_pool().release_unused()


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with their last column, a text, compressed to ``_packed`` (null: the empty text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
        for batch in in_slices(batches, -1, 4 * HELD_BYTES):
            texts = batch.columns[-1].cast(pa.binary())
            column = pa.array([squeeze(t.as_py() or b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*batch.schema.names[:-1], "_packed"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "_packed binary"])
    return rows.mapInArrow(run, schema)


def unpacked(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of each packed text in turn, so that only one of them is held at a time."""
    whole = zstandard.ZstdDecompressor().decompress
    return (whole(t.as_py()) for t in column)
