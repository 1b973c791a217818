"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code, known by its parity checks: ``Code``.  Two fingerprints that differ in up to ``t``
bits have a point halfway between them, and that point has an anchor within the covering radius R; so it is
enough to send each fingerprint to all anchors within ``R + t / 2`` of it and to
compare what meets at an anchor.  Sending them to ``R + t`` finds the same links with many more copies; ``radius`` sets it.

``simhash_near_dedup`` links 64-bit fingerprints within 2 bits.  Its code is the perfect Hamming code of 63 bits (R = 1), the
64th bit free: 33 anchors each.  A ball of radius 2 holds 2,081 words, so however many documents are alike, an anchor
never gets more distinct fingerprints than that: groups are bounded by the code and no cap or salt is
needed.  At an anchor the fingerprints within ``t`` bits are reduced to a spanning forest, so a
group of near copies sends one edge for each member and never its pairs.

``keep_one_of_each`` takes a similarity of shingle sets.  Sets of Jaccard similarity 0.8 differ in some 15 % of SimHash bits,
far more than two of 64, so fingerprints are longer and cut into bands.  A band is a point of the perfect binary Golay code
(23 bits, R = 3), compared within 2 bits at 5.3 anchors each, beside ``e`` bits that must agree; e grows with the logarithm of the
rows, so that anchors stay as crowded as ``CROWD``, and the number of bands makes the chance to miss a pair at the
threshold ``MISS`` at most.  Pairs that meet are held against each other on all bits, at least ``BITS``: the share that differs
estimates the angle of the two sets, and links at the angle of the threshold (at 0.8 give or take 0.025).

Defined results: a text that is null, empty or white space has fingerprint 0, which links like any
other.  Repeated rows share a component.  A null id takes part but is never a component's id
unless all its ids are null.  An empty table gives an empty result.  Extra columns are ignored by ``simhash_near_dedup`` and
carried, whatever their names, by ``keep_one_of_each``.  Very long texts are hashed whole.  A bit that exactly half the shingles have is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import cut
from sievework.llm import meeting
from sievework.llm.components import connected_components
from sievework.llm.packing import numbered, renamed
from sievework.llm.words import Powers, Rolling, Words, scramble, slices

SEED, SHINGLE, MAX_BITS = 42, 3, 2
#: Of the search by similarity: words of a shingle, similarity, chance to miss, members of an anchor, bits compared.
WORDS, SIMILARITY, MISS, CROWD, BITS = 5, 0.8, 0.02, 64, 1024


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text given as UTF-8: bit i is set if over half the shingle hashes set it."""
    words = text.lower().split() if text else []  # bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(joined[i:j], SEED) for i, j in zip(starts, stops, strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: Sequence[str] = ()) -> DataFrame:
    """``(id_col, keys..., fp)`` for each row; fp is signed."""
    kept = [id_col, *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(len(kept)).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(fps)], names=[*kept, "fp"])

    source = docs.select(*kept, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{schema}, fp long")


class Code:
    """A linear code by the syndrome of each bit; a point's anchors are the words it reaches by patterns of its own syndrome."""

    def __init__(self, syndromes: Sequence[int], radius: int):
        of = np.array(syndromes, np.int64)
        patterns, sums = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)]
        for weight in range(1, radius + 1):
            places = np.array(list(combinations(range(len(of)), weight)), np.int64)
            patterns.append(np.bitwise_or.reduce(np.uint64(1) << places.astype(np.uint64), axis=1))
            sums.append(np.bitwise_xor.reduce(of[places], axis=1))
        patterns, sums = np.concatenate(patterns), np.concatenate(sums)
        order = np.argsort(sums, kind="stable")
        self.patterns = patterns[order]
        self.size = np.bincount(sums, minlength=1 << int(of.max()).bit_length())
        self.start = np.cumsum(self.size) - self.size
        self.by_byte = [np.bitwise_xor.reduce(np.where(np.arange(256)[:, None] >> np.arange(8) & 1, np.pad(of, (0, -len(of) % 8)).reshape(-1, 8)[i], 0), axis=1) for i in range(-(-len(of) // 8))]

    def anchors(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of a point and anchor, for every anchor within the radius of it."""
        syndrome = np.zeros(len(points), np.int64)
        for i, table in enumerate(self.by_byte):
            syndrome ^= table[(points >> np.uint64(8 * i)).astype(np.int64) & 255]
        many = self.size[syndrome]
        index = np.repeat(np.arange(len(points)), many)
        at = np.repeat(self.start[syndrome] - (np.cumsum(many) - many), many) + np.arange(len(index))
        return index, points[index] ^ self.patterns[at]


@lru_cache(maxsize=4)
def hamming(radius: int) -> Code:
    """The perfect code of 63 bits, whose syndromes are the places 1 to 63, and a free 64th bit."""
    return Code([*range(1, 64), 0], radius)


@lru_cache(maxsize=4)
def golay(radius: int) -> Code:
    """The perfect code of 23 bits: a bit's syndrome is its power of x modulo the generator."""
    generator, x, of = 0b110001110101, 1, []  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
    for _ in range(23):
        of.append(x)
        x <<= 1
        x ^= generator if x >> 11 else 0
    return Code(of, radius)


def near_anchors(fps: np.ndarray, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Index of a fingerprint and anchor, for every anchor of the Hamming code within ``radius`` bits of it."""
    return hamming(radius).anchors(fps)


def _forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) that connect what is linked among the distinct fingerprints of an anchor."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= most
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    away = np.flatnonzero(label != np.arange(len(fps)))
    return fps[away], fps[label[away]]


def fingerprint_links(distinct: DataFrame, most: int = MAX_BITS, radius: int | None = None) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``fp`` within ``most`` (up to 2) bits.

    ``radius`` of the anchors sought: by default the covering radius plus half the threshold.
    """
    if not 0 <= most <= MAX_BITS:
        raise ValueError("the Hamming code's anchors serve thresholds of 0 to 2 bits")
    reach = 1 + (most + 1) // 2 if radius is None else radius

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fps), 1 << 14):
                part = fps[i : i + (1 << 14)]
                index, anchor = near_anchors(part, reach)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[index].view(np.int64))], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (np.empty(0, np.int64), np.empty(0, np.uint64))

        def groups(anchor: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.empty(0, int)
            size = np.diff(np.append(start, len(anchor)))
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            two = start[size == 2]  # most groups: compare them all at once
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= most]
            a.append(fp[two])
            b.append(fp[two + 1])
            for i, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                x, y = _forest(fp[i : i + n], most)
                a.append(x)
                b.append(y)
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(x.copy().view(np.int64)) for x in pairs], names=["a", "b"])

        for batch in batches:
            anchor = np.concatenate([left[0], batch.column(0).to_numpy()])
            fp = np.concatenate([left[1], batch.column(1).to_numpy().view(np.uint64)])
            if not len(anchor):
                continue
            done = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            left = (anchor[done:], fp[done:])
            yield groups(anchor[:done], fp[:done])
        yield groups(*left)

    sent = distinct.select("fp").mapInArrow(replicate, "anchor long, fp long")
    return sent.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(compare, "a long, b long")


def simhash_components(prints: DataFrame, id_col: str = "doc_id", most: int = MAX_BITS, radius: int | None = None) -> DataFrame:
    """``(fp, component_id)`` for every fingerprint of ``prints(id_col, fp)``."""
    distinct = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    roots = connected_components(fingerprint_links(distinct, most, radius))
    classes = cut(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return classes.join(least, "root").select("fp", "root", "component_id")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_BITS) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for each row of ``docs``."""
    prints = cut(fingerprints(docs, id_col, text_col))
    classes = simhash_components(prints, id_col, most)
    return prints.join(classes.select("fp", "component_id"), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def angle(similarity: float) -> float:
    """Share of SimHash bits in which sets of one size and this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan(rows: int, similarity: float = SIMILARITY, miss: float = MISS, crowd: int = CROWD) -> tuple[int, int]:
    """Bits that must agree beside a band's 23, and bands, for this many rows."""
    p = angle(similarity)
    within = sum(math.comb(23, i) * p**i * (1 - p) ** (23 - i) for i in range(3))
    exact = min(41, max(0, math.ceil(math.log2(max(1.0, 5.3 * rows / 4096 / crowd)))))
    return exact, math.ceil(math.log(miss) / math.log(1 - within * (1 - p) ** exact))


def majority(h: np.ndarray, words: int) -> np.ndarray:
    """Fingerprint of ``words`` 64-bit words from distinct shingle hashes: each bit as over half the hashes have it."""
    ones = np.zeros(64 * words, np.int64)
    mixer = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(h), 255):
        wide = scramble(h[i : i + 255, None] + mixer)
        ones += np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)


def wide_fingerprints(docs: DataFrame, keys: Sequence[str], text_col: str, shingle: int, words: int) -> DataFrame:
    """``(keys..., fp)``: the fingerprint of the set of lower-cased word shingles (fewer words: their whole sequence), as bytes."""
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = pa.compute.ascii_lower(batch.column(n_keys).cast(pa.large_string()))
            made = []
            for i, j in slices(texts):
                found = Words(texts.slice(i, j - i))
                hashed = found.hashes(powers)
                rolling = Rolling(hashed, powers)
                at = np.arange(max(0, len(hashed) - shingle + 1))
                gram = scramble(rolling.span(at, at + shingle))
                for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
                    if b - a >= shingle:
                        made.append(majority(np.unique(gram[a : b - shingle + 1]), words).tobytes())
                    elif b > a:
                        made.append(majority(scramble(rolling.span(np.array([a]), np.array([b])) + np.uint64(b - a)), words).tobytes())
                    else:
                        made.append(bytes(8 * words))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], pa.array(made, pa.binary())], names=[*keys, "fp"])

    source = docs.select(*keys, F.col(text_col).alias("_text"))
    return source.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), "fp binary"]))


def wide_links(classes: DataFrame, similarity: float, exact: int, bands: int, words: int) -> DataFrame:
    """Edges ``(a, b)`` of keys of ``classes(key, fp)`` that connect those whose fingerprints are alike by ``similarity``."""
    p, width = angle(similarity), 23 + exact
    limit = math.floor(64 * words * p)

    def prints(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), words)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = golay(4)
        weight = np.uint64(1) << np.arange(width, dtype=np.uint64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                key, fps = part.column(0).to_numpy(), prints(part.column(1))
                bits = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")
                for band in range(bands):
                    value = bits[:, band * width : (band + 1) * width].astype(np.uint64) @ weight
                    index, anchor = code.anchors(value & np.uint64(2**23 - 1))
                    spot = (value[index] >> np.uint64(23) << np.uint64(23)) | anchor
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(index), band, np.int32)), pa.array(spot.view(np.int64)), pa.array(key[index]), pa.array(fps[index, -1].view(np.int64))],
                        names=["band", "spot", "key", "s0"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in meeting.whole_groups(batches, [*group, "low", "high"]):
            band, spot, low, high, own, keys = (table.column(c).to_numpy() for c in (*group, "low", "high", "own", "key"))
            fps, edges = prints(table.column("fp")), []
            for i, n in zip(*(x.tolist() for x in meeting.bounds([band, spot, low, high])), strict=True):
                rows = np.arange(i, i + n)
                first, second = (rows, rows) if low[i] == high[i] else (rows[own[rows] == low[i]], rows[own[rows] != low[i]])
                chunk = max(1, (1 << 16) // n)
                for j in range(0, len(first), chunk):
                    a, b = np.nonzero(meeting.distance(fps[first[j : j + chunk], None], fps[None, second]) <= limit)
                    a, b = first[j + a], second[b]
                    a, b = meeting.forest(keys[a[a != b]], keys[b[a != b]])
                    edges.append((a, b))
            if edges:
                a, b = meeting.forest(*(np.concatenate(x) for x in zip(*edges, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    group = ["band", "spot"]
    sent = classes.select("key", "fp").mapInArrow(replicate, "band int, spot long, key long, s0 long")
    left = meeting.screened(sent, group, ["s0"], meeting.sketch_limit(p, 64, 0.002))
    return meeting.blocked(left, classes.select("key", "fp"), group).mapInArrow(compare, "a long, b long")


def near_copies(
    docs: DataFrame, keys: Sequence[str], id_col: str, text_col: str, similarity: float = SIMILARITY, shingle: int = WORDS, miss: float = MISS
) -> DataFrame:
    """``(keys..., root, component_id)`` for each row: its group of near copies, and the smallest id in that group."""
    exact, bands = plan(docs.count(), similarity, miss)
    words = max(BITS // 64, -(-bands * (23 + exact) // 64)) + 1  # the last is no band's: the screen's sketch
    prints = cut(wide_fingerprints(docs, [*keys, id_col], text_col, shingle, words))
    # Numbers that the checkpoint fixes: one per class, so no two share one.
    classes = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")).withColumn("key", F.monotonically_increasing_id()))
    roots = connected_components(wide_links(classes, similarity, exact, bands, words))
    rooted = cut(classes.join(roots, F.col("key") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "key").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp").drop("fp")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, shingle: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies one row, with its smallest id.

    Rows are known by a 128-bit key of all their columns; of a group's rows with its smallest id the one of least key stays, in whatever order the
    rows come.  Rows that are equal in all columns are reduced to one before texts are shuffled, which is once.
    """
    keys = ["_k1", "_k2"]
    whole = [F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]  # maps have no hash
    held, _ = numbered(docs, docs.columns, F.xxhash64(*whole).alias("_k1"), F.xxhash64(F.lit(1), *whole[::-1]).alias("_k2"))
    own = {c: f"_{docs.columns.index(c)}" for c in (id_col, text_col)}
    rows = near_copies(held, keys, own[id_col], own[text_col], similarity, shingle)
    first = rows.where(F.col(own[id_col]).eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min(F.struct(*keys)).alias("_row")).select("_row.*")
    return renamed(held.dropDuplicates(keys).join(chosen, keys, "left_semi"), docs.columns, [])
