"""Document fingerprints from prefix polynomial hashes.

A text's code points give two arrays of prefix hashes modulo the prime 2**31 - 1, one per base.  From
them the hash of any span takes two look-ups, so spans of any texts can be tested for equality, and
the longest common extension of two places is found by binary search.

The fingerprint has the number of code points, the hash of the whole text, and the least hash
of the ``SPAN``-point spans in each of 64 bins, one byte each.  The share of bins that agree, less
what agrees by chance, estimates the Jaccard likeness of two texts' sets of spans.

``compare_neighbours`` sets each document beside the next by id: rows are range-partitioned and
sorted once, partitions are read as streams, and only the first and last row of each partition meet
in a second, small step.

Defined results: a null text is the empty text, whose fingerprint is like no text but itself.  Rows of
equal id are ordered by the hash of their text and equal rows are each other's neighbours; null ids come
last.  The next document after the last is the first; a single document is its own.  An empty
table gives an empty result.  Extra columns are ignored.  Very long texts are fingerprinted whole, one at a time, with some 100 bytes held per character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import stored
from sievework.llm.packing import packed, unpacked
from sievework.llm.words import scramble

PRIME = np.uint64(2**31 - 1)
BASES = (1_103_515_245, 1_812_433_253 % (2**31 - 1))
SPAN, BINS = 16, 64
EMPTY = np.uint64(2**64 - 1)


def _reduce(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne prime, for x below 2**63."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return x - PRIME * (x >= PRIME)


class Powers:
    """Powers of the bases and of their inverses, grown by doubling."""

    def __init__(self) -> None:
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def need(self, n: int) -> None:
        while len(self.up[0]) < n:
            m = len(self.up[0])
            for b, base in enumerate(BASES):
                for table, step in ((self.up, base), (self.down, pow(base, -1, int(PRIME)))):
                    table[b] = np.concatenate([table[b], _reduce(table[b] * np.uint64(pow(step, m, int(PRIME))))])


class Prefixes:
    """Prefix hashes of one text (null: empty)."""

    def __init__(self, points: np.ndarray, powers: Powers):
        n = len(points)
        powers.need(n + 1)
        self.points, self.powers = points, powers
        values = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for up in powers.up:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_reduce(values * up[:n]), out=sums[1:])
            self.sums.append(_reduce(sums))

    def __len__(self) -> int:
        return len(self.points)

    def spans(self, start, stop) -> np.ndarray:
        """62-bit hash of each span; equal spans of any texts have equal hashes."""
        a, b = (_reduce((s[stop] + PRIME - s[start]) * down[start]) for s, down in zip(self.sums, self.powers.down, strict=True))
        return (a << np.uint64(31)) | b

    def extension(self, i: int, other: Prefixes, j: int) -> int:
        """How many code points agree from place i here and j in the other text."""
        low, high = 0, min(len(self) - i, len(other) - j)
        while low < high:
            middle = (low + high + 1) // 2
            if int(self.spans(np.int64(i), np.int64(i + middle))) == int(other.spans(np.int64(j), np.int64(j + middle))):
                low = middle
            else:
                high = middle - 1
        return low

    def bins(self, start: int, stop: int) -> np.ndarray:
        """The least hash in each bin of the spans that start from start on, before stop."""
        found = np.full(BINS, EMPTY)
        if stop > start:
            at = np.arange(start, stop)
            h = scramble(self.spans(at, at + SPAN))
            np.minimum.at(found, (h & np.uint64(BINS - 1)).astype(np.int64), h >> np.uint64(6))
        return found


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32)


def _print(n: int, whole: int, bins: np.ndarray) -> str:
    byte = np.where(bins == EMPTY, np.uint64(0), bins % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return f"{n:08x}{whole:016x}{byte.tobytes().hex()}"


def _all_bins(text: Prefixes) -> np.ndarray:
    if 0 < len(text) < SPAN:
        found = np.full(BINS, EMPTY)
        h = scramble(np.array([text.spans(np.int64(0), np.int64(len(text)))], np.uint64))[0]
        found[int(h) & (BINS - 1)] = h >> np.uint64(6)
        return found
    return text.bins(0, len(text) - SPAN + 1)


def fingerprint(text: Prefixes) -> str:
    return _print(len(text), int(text.spans(np.int64(0), np.int64(len(text)))), _all_bins(text))


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard likeness, from 0 to 1, of the texts of two fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s[24:]), np.uint8) for s in (a, b))
    either = int(((x > 0) | (y > 0)).sum())
    if not either:
        return 0.0
    share = int(((x == y) & (x > 0)).sum()) / either
    return max(0.0, (share - 1 / 255) / (1 - 1 / 255))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


class Document:
    """A text with its prefix hashes and fingerprint."""

    def __init__(self, text: str | None, powers: Powers):
        self.text = text or ""
        self.prefixes = Prefixes(code_points(text), powers)
        self.print = fingerprint(self.prefixes)

    def beside(self, following: Document) -> tuple:
        """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, shared_prefix."""
        edited = edited_text(self.text, following.text)
        changed = Prefixes(code_points(edited), self.prefixes.powers)
        changed_print = fingerprint(changed)
        return (
            len(self.text), hashlib.sha256(edited.encode()).hexdigest(), self.print, changed_print,
            likeness(self.print, changed_print), likeness(self.print, following.print), self.prefixes.extension(0, changed, 0),
        )


MADE = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("shared_prefix", pa.int64())]
SQL_TYPES = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document by id."""
    kind = docs.schema[id_col].dataType.simpleString()
    made = ", ".join(f"{name} {SQL_TYPES[t]}" for name, t in MADE)
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    order = [F.col("_id").asc_nulls_last(), F.col("_hash")]
    ordered = packed(source).repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_packed")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows beside their next; the partition's first and last text, marked by ``edge``."""
        powers, part = Powers(), TaskContext.get().partitionId()
        last = None
        held: list[tuple] = []
        id_type = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [id_type, *(t for _, t in MADE), pa.int32(), pa.string(), pa.string()]
            names = ["_id", *(n for n, _ in MADE), "part", "edge", "edge_text"]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        none = (None,) * len(MADE)
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0), unpacked(batch.column(1)), strict=True):
                now = (key.as_py(), Document(text.decode(), powers))
                if last is None:
                    held.append((now[0], *none, part, "first", now[1].text))
                else:
                    held.append((last[0], *last[1].beside(now[1]), part, None, None))
                last = now
            yield batch_of(held)
            held = []
        if last is not None:
            yield batch_of([(last[0], *none, part, "last", last[1].text)])

    done = stored(ordered.mapInArrow(stream, f"_id {kind}, {made}, part int, edge string, edge_text string"))

    # One row per partition: the partition that follows each, the first after the last.
    parts = [r["part"] for r in done.where("edge = 'first'").select("part").collect()]
    parts.sort()
    turn = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, next_part int")
    firsts = done.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"))
    lasts = done.where("edge = 'last'").select("_id", "part", "edge_text")
    meets = lasts.join(turn, "part").join(firsts, "next_part").select("_id", "edge_text", "next_text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            rows = [Document(a.as_py(), powers).beside(Document(b.as_py(), powers)) for a, b in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(MADE))], names=["_id", *(n for n, _ in MADE)]
            )

    edges = meets.mapInArrow(meet, f"_id {kind}, {made}")
    names = [n for n, _ in MADE]
    return done.where("edge IS NULL").select("_id", *names).union(edges).withColumnRenamed("_id", id_col)
