"""Embedding near-dedup by Euclidean p-stable hashing and exact cosine checks.

Vectors are scaled to length 1, so cosine ``c`` is distance ``sqrt(2 - 2 c)``.  A table hashes a
vector by ``k`` Gaussian projections, shifted and cut into cells of ``width``; vectors of one label
in one cell of a table are compared.  For a pair at the threshold one projection agrees with probability ``p1``, for
unrelated vectors with ``p2``; ``k`` is such that a label's unrelated vectors leave about ``CROWD`` in a cell, and the
number of tables makes the chance to miss a pair at the threshold ``MISS`` at most.

Equal vectors of a label are one class with a count.  What is shuffled to the tables is a class's key, cell and sketch,
the signs of ``SKETCH`` more projections, some 40 bytes; classes with a partner in their cell whose sketch is near are
then joined to their vectors once, and compared there by their exact cosine in double precision.  The limit on sketches loses a pair at the threshold
with a hundredth of ``MISS``.  A pair that meets in several tables is counted in the first: earlier cells are computed again from
the vectors.  Groups stay bounded and nothing is dropped, see ``meeting``; a group sends each member's number of links and
one edge to a neighbour of its tree, never its pairs.

Defined results: a vector that is null, empty or zero, or has a null or non-finite component, or whose label is
null, links with nothing and is kept.  Vectors of different lengths never link.  Repeated rows are rows that link with each other.  A null id
is never a component's id unless all are null.  An empty table gives an empty result.  Extra columns, of any name, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import cut
from sievework.llm import meeting
from sievework.llm.components import connected_components

COSINE, WIDTH, MISS, CROWD = 0.93, 2.0, 0.01, 256
SKETCH, SEED = 128, 20


def agree(distance: float, width: float) -> float:
    """Chance that one shifted, cut Gaussian projection puts two vectors at this distance in one cell."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def plan(rows: int, cosine: float = COSINE, width: float = WIDTH, miss: float = MISS, crowd: int = CROWD) -> tuple[int, int]:
    """Projections per table and tables for this many vectors of one label."""
    p1, p2 = agree(math.sqrt(2 - 2 * cosine), width), agree(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(max(rows / crowd, 1)) / -math.log(p2)))
    return k, math.ceil(math.log(miss) / math.log(1 - p1**k))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; the same row always gives the same bits."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # so that squares stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Each row with a 128-bit key of its label and vector, null if it can link with nothing.

    Vectors of floats stay floats, half as wide when they are shuffled; others become doubles.
    """
    v, label = F.col(vector_col), F.col(label_col)
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    sound = (
        label.isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    whole = vectors.schema[label_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return vectors.select(
        F.col(id_col).alias("_id"),
        F.when(sound, F.xxhash64(label, v)).alias("_k1"),
        F.when(sound, F.xxhash64(F.lit(11), v, label)).alias("_k2"),
        (label.cast("long") if whole else F.xxhash64(label)).alias("_label"),
        F.when(sound, v).alias("_v"),
    )


class Basis:
    """The projections for vectors of one length."""

    def __init__(self, d: int, k: int, tables: int, width: float):
        rng = np.random.default_rng(SEED + d)
        self.d, self.k, self.width = d, k, width
        self.along, self.shift = rng.standard_normal((d, k * tables)), rng.uniform(0, width, k * tables)
        self.mixer = rng.integers(1, 2**63, k * tables, np.uint64) | np.uint64(1)
        self.signs = rng.standard_normal((d, SKETCH))

    def cells(self, x: np.ndarray, tables: int) -> np.ndarray:
        """64-bit cell of each unit row in each of the first tables."""
        n = self.k * tables
        cells = np.floor((x @ self.along[:, :n] + self.shift[:n]) / self.width).astype(np.int64).view(np.uint64)
        cells = (cells * self.mixer[:n]).reshape(len(x), tables, self.k)
        return np.bitwise_xor.reduce(cells ^ (cells >> np.uint64(29)), axis=2) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(self.d)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """Signs of further projections, packed into words."""
        return np.packbits(x @ self.signs > 0, axis=1, bitorder="little").view(np.uint64)


def _tables(classes: DataFrame, k: int, tables: int, width: float) -> DataFrame:
    """Each class once per table: ``(turn, cell, key, s0, s1)``, the cell hashed with its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Basis] = {}
        for batch in batches:
            key, label = (batch.column(i).to_numpy() for i in (0, 1))
            sizes = batch.column(2).value_lengths().to_numpy()
            for d in np.unique(sizes).tolist():
                basis = made.get(d) or made.setdefault(d, Basis(d, k, tables, width))
                rows = np.flatnonzero(sizes == d)
                for i in range(0, len(rows), 2048):
                    some = rows[i : i + 2048]
                    x = unit(batch.column(2).take(pa.array(some)).flatten().to_numpy().reshape(len(some), d))
                    cells = basis.cells(x, tables) ^ (label[some, None].view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    sketch = basis.sketch(x).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(some))), pa.array(cells.view(np.int64).ravel()),
                         *(pa.array(np.repeat(c, tables)) for c in (key[some], sketch[:, 0], sketch[:, 1]))],
                        names=["turn", "cell", "key", "s0", "s1"],
                    )

    return classes.select("key", "label", "_v").mapInArrow(run, "turn int, cell long, key long, s0 long, s1 long")


def _linked(v: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float, label: np.ndarray, basis: Basis, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of ``first`` with rows of ``second`` (or within one) that meet in no earlier table."""
    within = first is second
    near = (v[first] @ v[second].T >= cosine) & (label[first, None] == label[None, second])
    if within:
        near = np.triu(near, 1)
    i, j = (rows[at] for rows, at in zip((first, second), np.nonzero(near), strict=True))
    if turn and len(i):
        used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        cells = basis.cells(v[used], turn)
        early = np.zeros(len(i), bool)
        for s in range(0, len(i), 1 << 15):
            a, b = place[: len(i)][s : s + (1 << 15)], place[len(i) :][s : s + (1 << 15)]
            early[s : s + (1 << 15)] = (cells[a] == cells[b]).any(1)
        i, j = i[~early], j[~early]
    return i, j


def near_links(classes: DataFrame, cosine: float, width: float, miss: float, crowd: int = CROWD) -> DataFrame:
    """``(key, links, other)`` rows: links found of a class, or an edge of a tree of linked classes."""
    most = classes.groupBy("label").agg(F.count("*").alias("m")).agg(F.max("m").alias("m")).first()["m"] or 0
    k, tables = plan(most, cosine, width, miss, crowd)
    limit = meeting.sketch_limit(math.acos(cosine) / math.pi, SKETCH, miss / 100)
    group = ["turn", "cell"]
    left = meeting.screened(_tables(classes, k, tables, width), group, ["s0", "s1"], limit)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Basis] = {}
        for table, _ in meeting.whole_groups(batches, [*group, "low", "high"]):
            turn, cell, low, high, own, keys, n, label = (table.column(c).to_numpy() for c in (*group, "low", "high", "own", "key", "n", "label"))
            vs = table.column("_v").combine_chunks()
            sizes = vs.value_lengths().to_numpy()
            out: list[tuple] = []
            for i, m in zip(*(x.tolist() for x in meeting.bounds([turn, cell, low, high])), strict=True):
                for d in np.unique(sizes[i : i + m]).tolist() if m > 1 else ():
                    rows = i + np.flatnonzero(sizes[i : i + m] == d)
                    v = unit(vs.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), d))
                    basis = made.get(d) or made.setdefault(d, Basis(d, k, tables, width))
                    every = np.arange(len(rows))
                    parts = (every, every) if low[i] == high[i] else (every[own[rows] == low[i]], every[own[rows] != low[i]])
                    a, b = _linked(v, *parts, cosine, label[rows], basis, int(turn[i]))
                    if len(a):
                        count = np.bincount(a, n[rows][b], len(rows)) + np.bincount(b, n[rows][a], len(rows))
                        some = np.flatnonzero(count)
                        x, y = meeting.forest(keys[rows][a], keys[rows][b])
                        out.append((np.concatenate([keys[rows][some], x]), np.concatenate([count[some].astype(np.int64), np.zeros(len(x), np.int64)]),
                                    np.concatenate([np.full(len(some), -1), y])))
            if out:
                key, links, other = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(links), pa.array(other, mask=other < 0)], names=["key", "links", "other"])

    members = classes.select("key", "n", "label", "_v")
    return meeting.blocked(left, members, group).mapInArrow(compare, "key long, links long, other long")


def near_dedup(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = COSINE, width: float = WIDTH, miss: float = MISS, crowd: int = CROWD,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for each row of ``vectors``."""
    rows = _classes(vectors, id_col, vector_col, label_col)
    first = lambda c: F.first(c).alias(c)  # noqa: E731  rows of a class are equal
    both = ["_k1", "_k2"]
    classes = rows.where("_k1 IS NOT NULL").groupBy(*both).agg(F.count("*").alias("n"), F.min("_id").alias("least"), first("_label"), first("_v"))
    # Numbers that the checkpoint fixes: one per class, so no two share one.
    classes = cut(classes.withColumns({"key": F.monotonically_increasing_id(), "label": F.col("_label")}))
    links = cut(near_links(classes, cosine, width, miss, crowd))
    roots = connected_components(links.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    counted = links.where("other IS NULL").groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select(*both, "key", "n", "least").join(counted, "key", "left").join(roots, F.col("key") == F.col("node"), "left")
    known = known.select(*both, "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(least, "root").select(*both, (F.col("links") + F.col("n") - 1).alias("links"), "component")
    out = rows.select("_id", *both).join(known, both, "left")
    component = F.when(F.col("links").isNull(), F.col("_id")).otherwise(F.col("component"))
    return out.select(
        F.col("_id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
