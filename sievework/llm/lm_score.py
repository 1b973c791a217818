"""Language-model scoring by cross-entropy difference.

A target model (documents labelled as good) and a background model (all documents) are n-gram models
of one order, one smoothing and one vocabulary, the 256 bytes of UTF-8, three line ends standing before each
text.  A document's score is its loss per byte under the target less that under the background:
the lower, the more it is like the target.

All texts are counted: tasks sum their own n-grams, a shuffle sums those of all.  Probabilities are
interpolated from order to order, ``P(d|abc) = (c(abcd) + K P(d|bc)) / (c(abc) + K)``, by joins over the n-gram table,
which grows with the corpus and is never held whole.  Distinct texts are dealt into blocks of about ``BLOCK_BYTES``; each block asks
the table, by a join, for the n-grams it has, once each, and scores its texts with the answers.  So a frequent n-gram is sent once a
block, not once a document, and a worker holds what one block needs.

Defined results: a null or empty text has no tokens and null losses and score.  Without any target document the target model is
uniform.  Labels of an id more than once count as good if any does.  Repeated rows count and are scored row by row.  An empty table gives an empty result.  Extra
columns are ignored.  Very long texts are counted and scored whole.  Documents of equal scores are not ranked among themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast, stored
from sievework.llm.meeting import whole_groups
from sievework.llm.packing import in_slices, numbered, packed, renamed, unpacked
from sievework.llm.words import slices

ORDER, K = 5, 8.0
#: Bytes of text in a block.
BLOCK_BYTES = 10_000_000
#: Bytes of text taken at once.
HELD = 2_000_000
PAD = b"\n" * (ORDER - 1)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of all texts in a row, and where each text starts and ends among them."""
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(PAD + PAD.join(texts), np.uint8).astype(np.uint64)
    n = len(PAD)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    key = np.zeros(max(0, len(data) - n), np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(8)) | data[i : i + len(key)]
    start = np.cumsum(sizes + n) - sizes - n
    return key, start, start + sizes


def _inside(key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The n-grams of the texts, without those of the line ends between them."""
    change = np.zeros(len(key) + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    return key[np.cumsum(change[:-1]) > 0]


def _add(held: list[np.ndarray], key: np.ndarray) -> list[np.ndarray]:
    """Counts of ``held`` (keys, counts) with more keys."""
    new, n = np.unique(key, return_counts=True)
    keys, inverse = np.unique(np.concatenate([held[0], new]), return_inverse=True)
    return [keys, np.bincount(inverse, np.concatenate([held[1], n]), len(keys)).astype(np.int64)]


def count_grams(docs: DataFrame, text_col: str, target_col: str) -> DataFrame:
    """``(gram, target, background)``: counts over the texts where ``target_col`` holds, and over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.empty(0, np.uint64), np.empty(0, np.int64)]
        every, target = none, none
        for batch in in_slices(batches, 0, HELD):
            every = _add(every, _inside(*grams(batch.column(0))))
            target = _add(target, _inside(*grams(batch.filter(batch.column(1)).column(0))))
        in_target = np.zeros(len(every[0]), np.int64)
        in_target[np.searchsorted(every[0], target[0])] = target[1]
        yield pa.RecordBatch.from_arrays([pa.array(every[0].astype(np.int64)), pa.array(in_target), pa.array(every[1])], names=["gram", "target", "background"])

    counted = docs.select(text_col, target_col).mapInArrow(run, "gram long, target long, background long")
    return counted.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def models(counts: DataFrame, k: float = K) -> DataFrame:
    """``(gram, target_loss, background_loss)``: -log P of each n-gram's last byte under both models."""
    sums = [F.sum(c).alias(c) for c in ("target", "background")]
    by_order = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        by_order[n] = by_order[n + 1].groupBy(F.col("gram").bitwiseAND(F.lit(256**n - 1)).alias("gram")).agg(*sums)
    total = by_order[1].agg(*sums).first()
    known = by_order[1].select("gram", *[((F.col(c) + 1) / F.lit(float((total[c] or 0) + 256))).alias(f"p_{c}") for c in ("target", "background")])
    for n in range(2, ORDER + 1):
        here = by_order[n].withColumns({"_short": F.col("gram").bitwiseAND(F.lit(256 ** (n - 1) - 1)), "_history": F.shiftright("gram", 8)})
        history = by_order[n].groupBy(F.shiftright("gram", 8).alias("_history")).agg(*[F.sum(c).alias(f"h_{c}") for c in ("target", "background")])
        shorter = known.withColumnRenamed("gram", "_short")
        here = here.join(history, "_history").join(shorter, "_short")
        known = here.select("gram", *[((F.col(c) + k * F.col(f"p_{c}")) / (F.col(f"h_{c}") + k)).alias(f"p_{c}") for c in ("target", "background")])
    return known.select("gram", *[(-F.log(f"p_{c}")).alias(f"{c}_loss") for c in ("target", "background")])


def score_texts(docs: DataFrame, table: DataFrame, keep: list[str], text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs``' columns ``keep`` with ``n_tokens`` and the mean losses by ``table(gram, target_loss, background_loss)``."""
    key = [F.xxhash64(text_col).alias("_k1"), F.hash(text_col).alias("_k2")]
    keyed, _ = numbered(docs, keep, *key, F.col(text_col).alias("_text"))
    blocks = max(1, math.ceil((docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) / block_bytes))
    once = packed(keyed.where("_text <> ''").select("_k1", "_k2", "_text")).groupBy("_k1", "_k2").agg(F.first("_packed").alias("_packed"))
    texts = stored(once.withColumn("block", F.pmod("_k1", F.lit(blocks)).cast("int")))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in whole_groups(batches, ["block"]):
            block = rows.column("block").to_numpy()
            for b in np.unique(block).tolist():
                mine = rows.column("_packed").filter(pa.array(block == b)).combine_chunks()
                held = np.empty(0, np.uint64)
                for i, j in slices(mine, HELD // 8):  # packed
                    held = np.union1d(held, _inside(*grams(pa.array(unpacked(mine.slice(i, j - i)), pa.binary()))))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), b, np.int32)), pa.array(held.astype(np.int64))], names=["block", "gram"])

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("gram").to_numpy())
        known = answers.column("gram").to_numpy()[order].astype(np.uint64)
        losses = [answers.column(c).to_numpy()[order] for c in ("target_loss", "background_loss")]
        mine, out = rows.column("_packed").combine_chunks(), []
        for i, j in slices(mine, HELD // 8):
            grammed, start, stop = grams(pa.array(unpacked(mine.slice(i, j - i)), pa.binary()))
            at = np.minimum(np.searchsorted(known, grammed), max(0, len(known) - 1))
            size = stop - start
            sums = [np.concatenate(([0.0], np.cumsum(loss[at]))) for loss in losses]
            out.append((size, *((s[stop] - s[start]) / size for s in sums)))
        n, target, background = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"_k1": rows.column("_k1"), "_k2": rows.column("_k2"), "n_tokens": pa.array(n, pa.int64()), "target_loss": pa.array(target), "background_loss": pa.array(background)})

    answers = texts.select("block", "_packed").repartition("block").sortWithinPartitions("block").mapInArrow(asked, "block int, gram long").join(table, "gram")
    made = "_k1 long, _k2 int, n_tokens long, target_loss double, background_loss double"
    found = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, made)
    joined = keyed.drop("_text").join(stored(found), ["_k1", "_k2"], "left")
    return renamed(joined.withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)).cast("long")), keep, ["n_tokens", "target_loss", "background_loss"])


def cross_entropy_difference(
    docs: DataFrame, good: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs``' columns ``keep`` with ``n_tokens, target_loss, background_loss, ce_diff``.

    ``good`` holds the ids of the target documents; of at most a million they are broadcast.
    """
    chosen = good.select(F.col(id_col).alias("_good")).where("_good IS NOT NULL").distinct()
    marked = docs.select(id_col, text_col).join(bounded_broadcast(chosen), F.col(id_col) == F.col("_good"), "left")
    counts = stored(count_grams(marked.withColumn("_target", F.col("_good").isNotNull()), text_col, "_target"))
    scored = score_texts(docs, stored(models(counts)), keep, text_col, block_bytes)
    return scored.withColumn("ce_diff", F.col("target_loss") - F.col("background_loss"))
