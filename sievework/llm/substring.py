"""Substring dedup by seed and extend on winnowed anchors.

A window is ``window`` consecutive words of one text.  Its anchor is the ``seed``-word gram in it
with the least hash (the rightmost of equals), so equal windows have equal anchors at equal
offsets, wherever they stand.  Consecutive windows with one anchor form a block, which reaches as
far to both sides of the anchor as its windows do.

1. Seed: blocks join on the hash of their anchor gram; anchors that occur once are dropped.
2. Extend: blocks of one anchor whose whole reach is equal are repeated whole.  The others, at the
   edges of a repeat or at an edit, are extended word by word: one block of each distinct reach
   gives the hashes of its windows, and windows that another block of the anchor shares are
   repeated.  All repeated windows of a text together are its maximal repeats.
3. Every word that a repeated window covers is removed, in all its copies.

Pairs are never formed: a group of copies is counted by aggregates that shrink before the shuffle,
however large it is.  Joins on an anchor that a third of all texts hold have one row of it on the
other side, so AQE can split them.

Two words, grams or windows count as equal if their 64-bit hashes agree, windows only together
with their anchor's, so 128 bits in all.  Defined results: a null text has no words; texts shorter
than a window lose nothing; repeated rows are copies of each other.  An empty table gives an empty
result.  Extra columns are carried along only by ``remove_repeats``.  Very long texts are searched whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import stored
from sievework.llm.packing import in_slices, numbered, packed, renamed, unpacked
from sievework.llm.words import Powers, Rolling, Words, scramble, slices

WINDOW, SEED = 35, 8


def _anchors(words: Words, hashed: np.ndarray, rolling: Rolling, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and anchor of every window, in order, and the hash of the gram at each word."""
    n = len(hashed)
    counts = np.diff(words.first)
    long = counts >= window
    begin, many = words.first[:-1][long], counts[long] - window + 1
    if not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.arange(n - seed + 1)
    gram = scramble(rolling.span(at, at + seed))
    value, place, reach = gram, at, 1
    grams = window - seed + 1
    while reach < grams:
        step = min(reach, grams - reach)
        a, b = value[:-step], value[step:]
        later = b <= a
        value, place = np.where(later, b, a), np.where(later, place[step:], place[:-step])
        reach += step
    start = np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(int(many.sum()))
    return start, place[start], gram


def _blocks(column: pa.Array, powers: Powers, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Row, first window, windows, anchor's offset from the first, anchor hash and reach hash of each block."""
    words = Words(column)
    hashed = words.hashes(powers)
    rolling = Rolling(hashed, powers)
    start, anchor, gram = _anchors(words, hashed, rolling, window, seed)
    head = np.flatnonzero(np.concatenate((np.ones(min(1, len(anchor)), bool), anchor[1:] != anchor[:-1])))
    many = np.diff(np.append(head, len(anchor)))
    first, anchor = start[head], anchor[head]
    row = np.searchsorted(words.first, first, "right") - 1
    offset = anchor - first
    reach = scramble(rolling.span(first, first + many + window - 1) + scramble((many * 64 + offset).astype(np.uint64)))
    return row, first - words.first[row], many, offset, gram[anchor] if len(gram) else np.empty(0, np.uint64), reach


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a 96-bit key of each row's id and text; equal rows share it."""
    return docs.withColumns({"_k1": F.xxhash64(id_col, text_col), "_k2": F.hash(text_col, id_col)})


def blocks(docs: DataFrame, text_col: str, window: int, seed: int) -> DataFrame:
    """One row per block of each text of keyed ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in in_slices(batches, 2):
            row, first, many, offset, anchor, reach = _blocks(batch.column(2), powers, window, seed)
            keys = [c.take(pa.array(row)) for c in batch.columns[:2]]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(first.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(offset.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(reach.view(np.int64))],
                names=["_k1", "_k2", "first", "many", "offset", "anchor", "reach"],
            )

    return docs.select("_k1", "_k2", text_col).mapInArrow(run, "_k1 long, _k2 int, first int, many int, offset int, anchor long, reach long")


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """Hash and bit of every window of the blocks that each text of ``docs`` lists in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in in_slices(batches, 0):
            texts = pa.array(unpacked(batch.column(0)), pa.large_binary())
            for i, j in slices(texts):
                words = Words(texts.slice(i, j - i))
                rolling = Rolling(words.hashes(powers), powers)
                lists = batch.column(1).slice(i, j - i)
                each = lists.flatten()
                row = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy())
                field = lambda name: each.field(name).to_numpy()  # noqa: E731, B023
                many = field("many")
                start = np.repeat(words.first[row] + field("first"), many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                bit = np.repeat(words.first[row] + field("first") + field("offset"), many) - start
                same = pa.array(np.repeat(np.arange(len(many)), many))
                yield pa.RecordBatch.from_arrays(
                    [*(each.field(x).take(same) for x in ("anchor", "reach", "n")), pa.array(bit.astype(np.int32)),
                     pa.array(scramble(rolling.span(start, start + window)).view(np.int64))],
                    names=["anchor", "reach", "n", "bit", "hash"],
                )

    return docs.select("_packed", "wanted").mapInArrow(run, "anchor long, reach long, n long, bit int, hash long")


def repeats(docs: DataFrame, text_col: str, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """For keyed ``docs``: ``(_k1, _k2, found)``, the anchors of each text that have repeated windows.

    ``found`` is an array of (place of the anchor, bits of the repeated windows): bit b stands for the
    window that starts b words before the anchor.
    """
    if not seed <= window <= seed + 62:
        raise ValueError("a window needs a seed no longer than itself and within 62 words of its length")
    made = blocks(docs, text_col, window, seed)
    # Sides of joins that come from an aggregate are stored: AQE splits a hot key only between plain shuffles.
    seeds = stored(made.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    met = stored(made.join(seeds, "anchor"))

    first = lambda c: F.first(c).alias(c)  # noqa: E731  one row's values: none of them is null
    reaches = stored(met.groupBy("anchor", "reach").agg(F.count("*").alias("n"), *map(first, ("_k1", "_k2", "first", "many", "offset"))))
    mixed = stored(reaches.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor"))
    wanted = (
        reaches.join(mixed, "anchor")
        .groupBy("_k1", "_k2")
        .agg(F.collect_list(F.struct("first", "many", "offset", "anchor", "reach", "n")).alias("wanted"))
    )
    texts = packed(docs.select("_k1", "_k2", text_col)).join(wanted, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    windows = stored(_windows(texts, window))
    shared = stored(windows.groupBy("anchor", "hash").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", "hash"))
    edges = windows.where("n = 1").join(shared, ["anchor", "hash"]).groupBy("anchor", "reach").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    whole = reaches.where("n > 1").select("anchor", "reach", F.expr("shiftleft(shiftleft(1L, many) - 1, offset - many + 1)").alias("bits"))
    return (
        met.join(stored(edges.union(whole)), ["anchor", "reach"])
        .groupBy("_k1", "_k2")
        .agg(F.collect_set(F.struct((F.col("first") + F.col("offset")).alias("place"), "bits")).alias("found"))
    )


def _cover(n: int, place: np.ndarray, bits: np.ndarray, window: int) -> np.ndarray:
    """Whether each of n words stands in a repeated window."""
    change = np.zeros(n + 1, np.int64)
    for b in range(window):
        start = place[(bits >> b) & 1 == 1] - b
        np.add.at(change, start, 1)
        np.add.at(change, start + window, -1)
    return np.cumsum(change[:n]) > 0


def remove_repeats(
    docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False
) -> DataFrame:
    """``docs``' columns ``keep`` with ``n_words``, ``n_removed`` and ``kept``: the words kept, joined by
    one space; or ``kept_sha256`` in its place.
    """
    keyed = _keyed(docs, id_col, text_col)
    found = repeats(keyed, text_col, window)
    columns = keyed.select("_k1", "_k2", *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(text_col).alias("_text"))
    types = numbered(docs, keep)[1]
    joined = packed(columns).join(found, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    last = "kept_sha256" if digest else "kept"
    made = ["n_words", "n_removed", last]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, len(keep)):
            texts, lists = batch.column(len(keep)), batch.column(len(keep) + 1)
            total, removed, kept = [], [], []
            for i, text in enumerate(unpacked(texts)):
                words = text.split()
                gone = 0
                if lists[i].is_valid:
                    each = lists[i].values
                    covered = _cover(len(words), each.field("place").to_numpy(), each.field("bits").to_numpy(), window)
                    gone = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c] if gone else words
                text = b" ".join(words)
                total.append(len(words) + gone)
                removed.append(gone)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*batch.schema.names[: len(keep)], *made],
            )

    return renamed(joined.mapInArrow(run, ", ".join([*types, f"n_words long, n_removed long, {last} string"])), keep, made)
