"""Members that meet in groups, compared where they meet so that no pairs are shuffled.

A search runs in two steps.  ``screened`` shuffles a member's key and a short bit sketch of it to each of its groups and
lets through those with a partner there whose sketch is near.  ``blocked`` brings what is left together
once more, with all that an exact comparison needs.  A group of any size stays bounded in memory: the screen passes one
of more than ``MOST`` members on whole, and the second step deals groups into blocks, each pair of which is a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import cut

#: Members up to which a group is screened at once, and members of a block.
MOST, BLOCK = 8192, 1024
#: Up to this many members a group's pairs are taken in step with those of other groups.
SMALL = 24


def sketch_limit(p: float, bits: int, miss: float) -> int:
    """The least number of differing bits that pairs whose bits differ with probability p exceed with at most ``miss``."""
    tail, t = 1.0, -1
    while tail > miss:
        t += 1
        tail -= math.comb(bits, t) * p**t * (1 - p) ** (bits - t)
    return t


def whole_groups(batches: Iterator[pa.RecordBatch], group: list[str], most: int | None = None) -> Iterator[tuple[pa.Table, bool]]:
    """Sorted rows as tables that cut no group, with False; of a group beyond ``most`` its rows alone, with True."""
    held, passed = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        columns = [table.column(c).to_numpy() for c in group]
        is_group = lambda values: np.all([c == x for c, x in zip(columns, values, strict=True)], axis=0)  # noqa: E731, B023
        last = [c[-1] for c in columns]
        done, start = int(np.argmax(is_group(last))), 0
        if passed is not None:
            start = int(is_group(passed).sum())
            if start:
                yield table.slice(0, start), True
            if start == table.num_rows:
                held = None
                continue
            passed = None
        if done > start:
            yield table.slice(start, done - start), False
        held = table.slice(done)
        if most is not None and held.num_rows > most:
            yield held, True
            held, passed = None, last
    if held is not None:
        yield held, False


def bounds(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal values in sorted columns."""
    change = np.any([c[1:] != c[:-1] for c in columns], axis=0) if len(columns[0]) > 1 else np.empty(0, bool)
    start = np.concatenate(([0], np.flatnonzero(change) + 1)) if len(columns[0]) else np.empty(0, np.int64)
    return start, np.diff(np.append(start, len(columns[0])))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of sketches, whose words are the last axis."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int32)


def near_some(start: np.ndarray, size: np.ndarray, sketch: np.ndarray, limit: int) -> np.ndarray:
    """Whether each row has another in its group within ``limit`` bits."""
    near = np.zeros(len(sketch), bool)
    few = (size > 1) & (size <= SMALL)
    first, last = np.repeat(start[few], size[few] - 1), np.repeat(start[few] + size[few], size[few] - 1)
    row = first + np.arange(len(first)) - np.repeat(np.cumsum(size[few] - 1) - (size[few] - 1), size[few] - 1)
    for step in range(1, SMALL):
        stays = row + step < last
        row, last = row[stays], last[stays]
        if not len(row):
            break
        hit = row[distance(sketch[row], sketch[row + step]) <= limit]
        near[hit] = near[hit + step] = True
    for i, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        group = sketch[i : i + n]
        chunk = max(1, (1 << 20) // n)
        for j in range(0, n, chunk):
            hit = distance(group[j : j + chunk, None], group[None]) <= limit
            near[i + j : i + min(n, j + chunk)] = hit.sum(1) > 1  # itself is one
    return near


def screened(rows: DataFrame, group: list[str], words: list[str], limit: int) -> DataFrame:
    """The rows of ``(group..., key, words...)`` that have a partner in their group within ``limit`` bits of ``words``.

    Returns ``(group..., key, m)``; m is how many of the group are left, 0 where the group was passed on unscreened.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, whole in whole_groups(batches, group, MOST):
            columns = [table.column(c).to_numpy() for c in (*group, "key")]
            if whole:
                near, m = np.ones(table.num_rows, bool), np.zeros(table.num_rows, np.int64)
            else:
                start, size = bounds(columns[:-1])
                near = near_some(start, size, np.stack([table.column(c).to_numpy() for c in words], axis=1).view(np.uint64), limit)
                m = np.repeat(np.add.reduceat(near, start, dtype=np.int64), size)
            if near.any():
                yield pa.RecordBatch.from_arrays([*(pa.array(c[near]) for c in columns), pa.array(m[near])], names=[*group, "key", "m"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*group, "key"))
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, f"{kinds}, m long")


def blocked(left: DataFrame, members: DataFrame, group: list[str], block: int | None = None) -> DataFrame:
    """``screened`` rows with the columns of ``members(key, ...)``, partitioned and sorted by ``(group..., low, high)``.

    ``own`` is the member's block.  Where ``low`` and ``high`` differ only members of different blocks need comparing; every
    pair of a group meets in exactly one (low, high).
    """
    left = cut(left)
    known, passed = left.where("m > 1"), left.where("m = 0").drop("m")
    sizes = cut(passed.groupBy(*group).agg(F.count("*").alias("m")))
    if not sizes.isEmpty():
        known = known.unionByName(passed.join(sizes, group))
    blocks = F.ceil(F.col("m") / F.lit(block or BLOCK)).cast("int")
    dealt = known.select(*group, "key", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"))
    dealt = dealt.select(*group, F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "own", "key").join(members, "key")
    order = [*group, "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "own", "key")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the pairs (a[i], b[i])."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[away], nodes[label[away]]
