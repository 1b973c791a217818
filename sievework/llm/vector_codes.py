"""Vectors compressed to one codebook index per part, by value dictionaries.

Components become whole numbers; vectors are cut into ``parts`` equal parts, each with a codebook of up to 256 entries.
Assigning works on a slice of rows at a time: of each dimension the slice's distinct values form a dictionary, the
squared differences of every value to all entries are tabulated once, and the distance of a part to all entries is the
sum of the table rows that its dictionary codes point at.  A slice has at most as many values as rows, so the tables stay
small whatever the range of values.

Codebooks start as the vectors of least id and are moved by rounds over all rows.  A round's counts and sums have a fixed
size, so only they, never rows, meet at the driver.

Defined results: rows are dropped whose vector is null or holds null or non-finite components, or has another length than
most rows have (of equally common lengths the greater counts).  A length that ``parts`` does not divide is filled up with
zeros.  Whole numbers beyond ``LIMIT`` are held at it.  Null ids come last; rows of one id start codebooks in the order of their vectors.  With
fewer rows than entries each row starts an entry.  Distance ties go to the lower index, entries without parts stay.  Repeated rows
count as often as they stand and get equal codes.  Null labels are one label.  An empty table, or one whose vectors are all empty, gives an empty result.  Extra
columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast, stored
from sievework.llm.tally import tally
from sievework.llm.vectors import integers, matrices, usual_length

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
#: Whole numbers are held within this, so that squared distances of 512 dimensions fit 64 bits.
LIMIT = 2**26


def _padded(values: np.ndarray, parts: int) -> np.ndarray:
    return np.pad(values, ((0, 0), (0, -values.shape[1] % parts)))


def assign(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row's parts and its squared distance; ``books`` has parts, entries, positions."""
    parts, entries, width = books.shape
    reach = max(abs(int(f(a))) for f in (np.min, np.max) for a in (values, books))
    kind = np.int32 if width * (2 * reach) ** 2 < 2**31 else np.int64
    codes, errors = np.empty((len(values), parts), np.int64), np.empty((len(values), parts), np.int64)
    total, some = np.empty((len(values), entries), kind), np.empty((len(values), entries), kind)
    for p in range(parts):
        total[:] = 0
        for j in range(width):
            dictionary, code = np.unique(values[:, p * width + j], return_inverse=True)
            table = (dictionary[:, None].astype(np.int64) - books[p, :, j]) ** 2
            np.take(table.astype(kind), code, axis=0, out=some)
            total += some
        codes[:, p] = total.argmin(1)  # the first of equally near ones
        errors[:, p] = total[np.arange(len(values)), codes[:, p]]
    return codes, errors


def _moved(rows: DataFrame, books: np.ndarray, d: int) -> np.ndarray:
    """The codebooks after one round: entries become the floored means of their parts."""
    parts, entries, width = books.shape

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        cells = total[: parts * entries * (width + 1)].reshape(parts, entries, width + 1)
        for _, values in matrices(batch, 0, d):
            values = _padded(values, parts)
            codes, _ = assign(values, books)
            for p in range(parts):
                cells[p, :, width] += np.bincount(codes[:, p], minlength=entries)
                for j in range(width):  # sums of 2,048 such values are exact in double precision
                    cells[p, :, j] += np.bincount(codes[:, p], values[:, p * width + j], entries).astype(np.int64)

    sums = tally(rows.select("v"), parts * entries * (width + 1), add).reshape(parts, entries, width + 1)
    n = sums[:, :, width:]
    return np.where(n > 0, sums[:, :, :width] // np.maximum(n, 1), books)


def codebooks(rows: DataFrame, d: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, positions) of ``rows(_id, v)`` whose vectors have length ``d``."""
    first = rows.select("_id", "v").orderBy(F.col("_id").asc_nulls_last(), "v").limit(entries).collect()
    start = _padded(np.array([r["v"] for r in first], np.int64), parts)
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).swapaxes(0, 1))
    for _ in range(rounds):
        books = _moved(rows, books, d)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE,
) -> DataFrame:
    """``(id_col, code, error, label_error, codebooks_sha256)`` for each sound row."""
    kept = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), integers(F.col(vector_col), scale, LIMIT).alias("v"))
    kept = stored(kept.where("v IS NOT NULL"))  # read once to start and once a round
    d = usual_length(kept, "v")
    kept = kept.where(F.size("v") == d)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    if not d:
        return kept.limit(0).select(F.col("_id").alias(id_col), F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")], F.lit("").alias("codebooks_sha256"))
    books = codebooks(kept, d, parts, entries, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, values in matrices(batch, 2, d):
                codes, errors = assign(_padded(values, parts), books)
                hexed = [row.hex() for row in map(bytes, codes.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, len(values)) for c in batch.columns[:2]), pa.array(hexed, pa.string()), pa.array(errors.sum(1))], names=["_id", "_label", "code", "error"]
                )

    coded = stored(kept.select("_id", "_label", "v").mapInArrow(run, f"_id {kinds['_id']}, _label {kinds['_label']}, code string, error long"))
    sums = coded.groupBy(F.col("_label").alias("_same")).agg(F.sum("error").alias("label_error"))
    out = coded.join(bounded_broadcast(sums), F.col("_label").eqNullSafe(F.col("_same")))
    return out.select(F.col("_id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
