"""Quality scores by random-indexing word vectors and a two-layer network with calibrated probabilities.

1. Word vectors: a word's index vector has ``NONZERO`` signs at places that its hash gives.  Over all documents each word gathers the index
   vectors of its neighbours within ``WINDOW`` words.  Words are runs of letters and digits, as written, and runs of
   other signs.  They share ``ROWS`` rows by hash, so the table has a fixed size for any vocabulary; tasks sum it in whole
   numbers and it depends on no order.  A row's vector is the mean of what it gathered, centred over all words and scaled.
2. A document: mean and spread of its words' vectors, rare words weighing more, with the number of words and the shares of them that are
   new in their piece of the text and that repeat the one before.
3. Network: one hidden layer of ``HIDDEN`` units fitted in numpy on a sample of at most ``SAMPLE`` labelled rows, those of least hashed
   id.  A fifth of the sample is kept apart: it ends the fitting and then sets the temperature that the score's log odds are
   divided by.

Texts beyond ``PIECE`` bytes are read whole, in pieces cut at blanks; windows do not cross cuts, and rows of a piece count for its text.

Defined results: null and empty texts have no words: their vectors are zero and they are scored like any other.  Without labels every score is 0;
with labels of one kind it is that label.  Rows labelled more than once count as 1 if any label says so.  Labels of ids without a document, and null
labels or ids, are passed over.  Repeated rows count as often as they stand and get equal scores.  An empty table gives an empty result.  A kept column
named like one made here gives way; other extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import Shared
from sievework.llm.packing import numbered, renamed
from sievework.llm.tally import tally
from sievework.llm.words import LONG_WORD, Powers, Rolling, scramble, slices

#: Labelled rows that fitting takes at most.
SAMPLE = 20_000
ROWS, SIZE, NONZERO, WINDOW = 2**14, 64, 4, 2
HIDDEN, EPOCHS, PATIENCE, BATCH, RATE, DECAY, SEED = 32, 60, 8, 128, 2e-3, 1e-4, 11
#: Bytes of text whose arrays are held at once, and words whose vectors are.
PIECE, GATHERED = 400_000, 1 << 15
#: Weight of a word of frequency f: COMMON / (COMMON + f).
COMMON = 1e-3
UNIT, SHARE = 64, 1024
FEATURES = 2 * SIZE + 3

_KIND = np.full(256, 2, np.uint8)  # 0 blank, 1 of a word, 2 another sign
_KIND[:33] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


class Tokens:
    """Hashes of the words of the texts of a binary Arrow column without nulls, and where each text's begin."""

    def __init__(self, column: pa.Array, powers: Powers):
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        text = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        kind = _KIND[text]
        edge = np.ones(len(text) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[at] = True
        edges = np.flatnonzero(edge)
        start, stop = edges[:-1], edges[1:]
        word = kind[start] > 0
        start, stop = start[word], stop[word]
        size = stop - start
        rolling = Rolling(text.astype(np.uint64) + np.uint64(1), powers)
        self.hash = scramble(rolling.span(start, stop) + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD):
            self.hash[i] = xxhash.xxh3_64_intdigest(text[start[i] : stop[i]])
        self.first = np.searchsorted(start, at)
        self.row = (self.hash >> np.uint64(40)).astype(np.int64) % ROWS


def pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """All texts of a column (null: empty), up to ``PIECE`` bytes at a time: the row of each piece, and the pieces."""
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
    for i, j in slices(column, PIECE):
        if j > i + 1 or len(text := column[i].as_py()) <= PIECE:
            yield np.arange(i, j), column.slice(i, j - i)
            continue
        at = 0
        while at < len(text):
            end = min(at + PIECE, len(text))
            if end < len(text):
                blank = max(text.rfind(b" ", at + 1, end), text.rfind(b"\n", at + 1, end))
                end = blank if blank > 0 else end
            yield np.array([i]), pa.array([text[at:end]], pa.large_binary())
            at = end


def index_vectors(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors of words."""
    shift = np.arange(NONZERO, dtype=np.uint64)
    place = (hashed[:, None] >> (shift * np.uint64(6))) % np.uint64(SIZE)
    return place.astype(np.int64), 1.0 - 2.0 * ((hashed[:, None] >> (np.uint64(32) + shift)) & np.uint64(1)).astype(np.float64)


def gather(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """What each row gathered over all texts: ``ROWS`` rows of ``SIZE`` sums, the neighbours and the words counted."""
    cells = ROWS * SIZE

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        powers = Powers()
        for _, texts in pieces(batch.column(0)):
            t = Tokens(texts, powers)
            n = len(t.hash)
            place, sign = index_vectors(t.hash)
            of = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
            total[cells + ROWS : cells + 2 * ROWS] += np.bincount(t.row, minlength=ROWS)
            for apart in range(1, WINDOW + 1):
                a = np.flatnonzero(of[apart:] == of[: n - apart]) if n > apart else np.empty(0, np.int64)
                for here, there in ((a, a + apart), (a + apart, a)):
                    key = (t.row[here, None] * SIZE + place[there]).ravel()
                    total[:cells] += np.bincount(key, sign[there].ravel(), cells).astype(np.int64)
                    total[cells : cells + ROWS] += np.bincount(t.row[here], minlength=ROWS)

    return tally(docs.select(text_col), cells + 2 * ROWS, add)


@dataclass
class Model:
    """Vectors and weights of the rows, and the network: 4 MB, whatever it was learned from."""

    vectors: np.ndarray
    weights: np.ndarray
    network: list[np.ndarray]
    temperature: float = 1.0
    constant: float | None = None  # the score of every text, where there is nothing to tell apart

    def features(self, column: pa.Array) -> np.ndarray:
        """One row of ``FEATURES`` numbers per text."""
        n = len(column)
        sums, squares = np.zeros((n, SIZE)), np.zeros((n, SIZE))
        weight, words, new, again = (np.zeros(n) for _ in range(4))
        powers = Powers()
        for rows, texts in pieces(column):
            t = Tokens(texts, powers)
            of = rows[np.repeat(np.arange(len(rows)), np.diff(t.first))]
            words += np.bincount(of, minlength=n)
            pair = t.hash ^ scramble(of.astype(np.uint64) + np.uint64(1 << 32))  # short words are hashes of small numbers too
            new += np.bincount(of[np.unique(pair, return_index=True)[1]], minlength=n)
            again += np.bincount(of[1:][(t.hash[1:] == t.hash[:-1]) & (of[1:] == of[:-1])], minlength=n)
            for i in range(0, len(of), GATHERED):
                at, row = of[i : i + GATHERED], t.row[i : i + GATHERED]
                v, w = self.vectors[row].astype(np.float64), self.weights[row]
                cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                weighed = v * w[:, None]
                sums[at[cut]] += np.add.reduceat(weighed, cut, axis=0)
                squares[at[cut]] += np.add.reduceat(weighed * v, cut, axis=0)
                weight[at[cut]] += np.add.reduceat(w, cut)
        some = np.maximum(weight, 1)[:, None]
        mean = sums / some
        spread = np.sqrt(np.maximum(squares / some - mean * mean, 0)) / UNIT
        mean /= UNIT
        return np.column_stack((mean, spread, np.log1p(words), new / np.maximum(words, 1), again / np.maximum(words, 1)))

    def odds(self, x: np.ndarray) -> np.ndarray:
        mean, scale, a, b, c, d = self.network
        return np.tanh((x - mean) / scale @ a + b) @ c + d

    def score(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.odds(self.features(column)) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> tuple[list[np.ndarray], float]:
    """A network, by Adam on the rows that are not ``apart``, and its temperature on those that are."""
    rng = np.random.default_rng(SEED)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    held = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
    train, test = np.flatnonzero(~apart), np.flatnonzero(apart)
    if not len(test):
        test = train
    odds = lambda p, rows: np.tanh(z[rows] @ p[0] + p[1]) @ p[2] + p[3]
    loss = lambda o, rows: float(np.mean(np.logaddexp(0, o) - y[rows] * o))
    best, least, waited, step = held, np.inf, 0, 0
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for i in range(0, len(order), BATCH):
            rows, step = order[i : i + BATCH], step + 1
            h = np.tanh(z[rows] @ held[0] + held[1])
            e = (1 / (1 + np.exp(-(h @ held[2] + held[3]))) - y[rows]) / len(rows)
            back = e[:, None] * held[2] * (1 - h * h)
            slopes = [z[rows].T @ back, back.sum(0), h.T @ e, e.sum(keepdims=True)]
            for k, g in enumerate(slopes):
                g = g + DECAY * held[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                held[k] = held[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        now = loss(odds(held, test), test)
        best, least, waited = (list(held), now, 0) if now < least else (best, least, waited + 1)
        if waited >= PATIENCE:
            break
    o = odds(best, test)
    low, high = -3.0, 3.0  # natural logs of the temperature; the loss has one valley in its inverse
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(o / np.exp(a), test) <= loss(o / np.exp(b), test) else (a, high)
    return [mean, scale, *best], float(np.exp((low + high) / 2))


def word_vectors(gathered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and weights of the rows from what they gathered, in whole ``UNIT``-ths and ``SHARE``-ths, whose sums are exact in any order."""
    cells = ROWS * SIZE
    near, count = gathered[cells : cells + ROWS].astype(float), gathered[cells + ROWS :].astype(float)
    vectors = gathered[:cells].reshape(ROWS, SIZE) / np.maximum(near, 1)[:, None]
    share = count / max(count.sum(), 1)
    vectors = vectors - share @ vectors
    vectors[count == 0] = 0
    scale = np.sqrt(share @ (vectors * vectors)) + 1e-12
    return np.clip(np.rint(vectors / scale * UNIT), -4095, 4095).astype(np.float32), np.rint(COMMON / (COMMON + share) * SHARE).clip(1)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from all documents and ``labels(id_col, label_col)``, of which at most ``sample`` rows are taken."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    model = Model(*word_vectors(gather(docs, text_col)), [])
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shared.value.features(batch.column(2)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([row.tobytes() for row in x], pa.binary())], names=["h", "label", "x"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    rows = texts.select(F.xxhash64("_id").alias("h"), "_label", "_text").mapInArrow(run, "h long, label int, x binary")
    found = rows.toArrow().sort_by([("h", "ascending"), ("label", "ascending"), ("x", "ascending")])  # FEATURES numbers of each row of the sample
    y = found["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        model.constant = float(y[0]) if len(y) else 0.0
        return model
    x = np.array([np.frombuffer(r, np.float32) for r in found["x"].to_pylist()], float)
    model.network, model.temperature = fit(x, y, found["h"].to_numpy() % 5 == 0)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``docs``' columns ``keep`` with ``score``."""
    shared = Shared(docs.sparkSession, model)
    source, types = numbered(docs, keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found)], names=[*batch.schema.names[: len(keep)], "score"])

    return renamed(source.mapInArrow(run, ", ".join([*types, "score double"])), keep, ["score"])
