"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pre-tokens of a batch that are not known yet stand in one buffer as linked lists.  A bucket per
merge rank holds the positions whose pair has that rank; a bitmap of three levels marks the buckets
that hold something, and find-first-set on it picks the next rank.  A drained bucket skips stale
entries (dead positions, or pairs whose rank has changed), merges what is left and queues the new
pairs, also where they rank lower than the bucket just drained.

Ranks whose token is part of a token of lower rank must merge one pair at a time within a pre-token.  Short
pre-tokens do so side by side, in arrays over all of them; a pre-token beyond ``LONG`` bytes is merged alone,
with the same queue over its positions, each bucket a heap, so that it costs ``n log n`` in its length n.

Distinct pre-tokens are remembered per Python worker until they and their ids take ``MEMORY`` bytes, after which
the memory starts afresh: a worker holds that and one slice of text, however long pre-tokens are, and no result changes.

Defined results: a null text encodes like the empty text, to no ids.  Repeated rows are encoded row
by row.  An empty table gives an empty result.  Extra columns are ignored.  Text that looks like a
special token is ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import Shared
from sievework.llm.packing import in_slices, numbered, renamed

#: Bytes of pre-tokens and ids that a worker remembers, and those of the objects that one pre-token takes.
MEMORY, ENTRY = 40_000_000, 150
#: Bytes of text whose pre-tokens are held at once.
HELD_CHARS = 1_500_000
#: Bytes beyond which a pre-token is merged alone.
LONG = 512
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """The tables of a rank file: token bytes by id, and the merged id of each pair of ids."""

    def __init__(self, lines: list[str]):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.size = max(ranks.values()) + 1
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        lengths, parts = np.zeros(self.size, np.int64), [b""] * self.size
        keys, merged = [], []
        for token, rank in ranks.items():
            lengths[rank], parts[rank] = len(token), token
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(rank)
        self.length, self.flat = lengths, np.frombuffer(b"".join(parts), np.uint8)
        self.start = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        # Open addressing: a slot holds the key or is passed on to the next.
        self.mask = (1 << int(4 * len(keys)).bit_length()) - 1
        self.slot_key, self.slot_id = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        self.longest_probe, left = 0, np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.slot_key[at[left]] < 0
            first = np.unique(at[left[free]], return_index=True)[1]
            put = left[free][first]
            self.slot_key[at[put]], self.slot_id[at[put]] = keys[put], merged[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask
            self.longest_probe += 1
        # Ranks whose token is part of a token of lower rank: their merges must go one at a time.
        parts_of = np.concatenate([keys // self.size, keys % self.size])
        self.risky = set(parts_of[parts_of > np.tile(merged, 2)].tolist())
        self.merged = dict(zip(keys.tolist(), merged.tolist(), strict=True))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).view(np.int64) & self.mask

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair of ids makes, NONE if it makes none."""
        key = left.astype(np.int64) * self.size + right
        at = self._slot(key)
        got = np.full(len(key), NONE, np.int32)
        todo = np.arange(len(key))
        for _ in range(self.longest_probe + 1):
            slot = self.slot_key[at]
            hit = slot == key[todo]
            got[todo[hit]] = self.slot_id[at[hit]]
            on = ~hit & (slot >= 0)
            if not on.any():
                break
            todo, at = todo[on], (at[on] + 1) & self.mask
        return got

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and the length of each."""
        length = self.length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        index = np.repeat(self.start[ids] - (ends - length), length)
        index += np.arange(total)
        return self.flat[index], length


class RankQueue:
    """Buckets of positions per rank under a bitmap of three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.bucket: dict[int, list[np.ndarray]] = {}

    def push(self, rank: np.ndarray, position: np.ndarray) -> None:
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        rank, position = rank[order], position[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(rank)]
        for i, r in enumerate(rank[bounds[:-1]].tolist()):
            held = self.bucket.get(r)
            part = position[bounds[i] : bounds[i + 1]]
            if held is None:
                self.bucket[r] = [part]
                self.low[r >> 6] |= 1 << (r & 63)
                self.mid[r >> 12] |= 1 << ((r >> 6) & 63)
                self.top |= 1 << (r >> 12)
            else:
                held.append(part)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has a bucket, and the positions in it."""
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) + (word & -word).bit_length() - 1
        word = self.low[b]
        r = (b << 6) + (word & -word).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        held = self.bucket.pop(r)
        return r, held[0] if len(held) == 1 else np.unique(np.concatenate(held))


def merge_all(vocabulary: Vocabulary, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BPE of pre-tokens of ``sizes`` bytes in a row in ``data``: all ids, and how many each has."""
    n = len(data)
    ids = vocabulary.byte_id[data]
    piece = np.repeat(np.arange(len(sizes)), sizes)
    after = np.arange(1, n + 1, dtype=np.int64)
    before = np.arange(-1, n - 1, dtype=np.int64)
    ends = np.cumsum(sizes)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    rank = np.full(n, NONE, np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = vocabulary.pair(ids[inner], ids[inner + 1])
    queue = RankQueue(vocabulary.size)
    some = np.flatnonzero(rank != NONE)
    queue.push(rank[some], some)
    while (popped := queue.pop()) is not None:
        r, at = popped
        at = at[rank[at] == r]  # stale entries go
        if not len(at):
            continue
        if len(at) > 1:
            at.sort()
            if r in vocabulary.risky:
                first = np.concatenate(([True], piece[at[1:]] != piece[at[:-1]]))
                queue.push(np.full(int((~first).sum()), r, np.int32), at[~first])
                at = at[first]
            else:
                joined = after[at[:-1]] == at[1:]
                if joined.any():  # of overlapping pairs in a row every second merges, from the left
                    starts = np.concatenate(([True], ~joined))
                    index = np.arange(len(at))
                    at = at[(index - index[starts][np.cumsum(starts) - 1]) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        after[at] = beyond
        has = beyond >= 0
        before[beyond[has]] = at[has]
        ids[at], ids[gone], rank[gone], rank[at] = r, -1, NONE, NONE
        left = before[at]
        new = np.concatenate([left[left >= 0], at[has]])
        if len(at) > 1:
            new = np.unique(new)  # neighbours that both merged
        fresh = vocabulary.pair(ids[new], ids[after[new]])
        rank[new] = fresh
        made = fresh != NONE
        queue.push(fresh[made], new[made])
    alive = ids >= 0
    return ids[alive], np.bincount(piece[alive], minlength=len(sizes))


def merge_long(vocabulary: Vocabulary, data: np.ndarray) -> np.ndarray:
    """BPE of one pre-token: its ids.

    A bucket is a run of positions known from the start, in order, beside a heap of those that merges add.
    """
    n, size, merged = len(data), vocabulary.size, vocabulary.merged.get
    first = vocabulary.byte_id[data]
    rank_at = np.append(vocabulary.pair(first[:-1], first[1:]), NONE)
    order = np.argsort(rank_at, kind="stable")
    order = order[rank_at[order] != NONE]
    bounds = np.flatnonzero(np.diff(rank_at[order], prepend=-1)).tolist()
    start = {int(rank_at[order[i]]): (i, j) for i, j in zip(bounds, [*bounds[1:], len(order)], strict=True)}
    order, ids, rank = array("q", order.tobytes()), array("i", first.tobytes()), array("i", rank_at.astype(np.int32).tobytes())
    after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
    after[n - 1] = -1
    low, mid, top = [0] * ((size >> 6) + 1), [0] * ((size >> 12) + 1), 0
    heaps: dict[int, list[int]] = {}
    for r in start:
        low[r >> 6] |= 1 << (r & 63)
    for a, word in enumerate(low):
        if word:
            mid[a >> 6] |= 1 << (a & 63)
            top |= 1 << (a >> 6)
    while top:
        a = (top & -top).bit_length() - 1
        b = (a << 6) + (mid[a] & -mid[a]).bit_length() - 1
        r = (b << 6) + (low[b] & -low[b]).bit_length() - 1
        at, stop = start.get(r, (0, 0))
        heap = heaps.setdefault(r, [])
        lower = False
        while not lower and (heap or at < stop):
            if at < stop and not (heap and heap[0] < order[at]):
                p = order[at]
                at += 1
            else:
                p = heappop(heap)
            if rank[p] != r:  # stale
                continue
            gone = after[p]
            beyond = after[gone]
            after[p], ids[p], rank[gone], ids[gone] = beyond, r, NONE, -1
            made = None
            if beyond >= 0:
                before[beyond] = p
                made = merged(r * size + ids[beyond])
            rank[p] = NONE if made is None else made
            left = before[p]
            other = merged(ids[left] * size + r) if left >= 0 else None
            if left >= 0:
                rank[left] = NONE if other is None else other
            for new, position in ((made, p), (other, left)):
                if new is not None:
                    heappush(heaps.setdefault(new, []), position)
                    low[new >> 6] |= 1 << (new & 63)
                    mid[new >> 12] |= 1 << ((new >> 6) & 63)
                    top |= 1 << (new >> 12)
                    lower |= new < r
        start[r] = (at, stop)
        if not heap and at >= stop:
            del heaps[r], start[r]
            low[b] &= ~(1 << (r & 63))
            if not low[b]:
                mid[a] &= ~(1 << (b & 63))
                if not mid[a]:
                    top &= ~(1 << a)
    ids = np.frombuffer(ids, np.int32)
    return ids[ids >= 0]


class Encoder:
    """Encodes texts by a vocabulary; remembers pre-tokens between calls."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.ids, self.count = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row, and how many each text has."""
        if self.held > MEMORY:
            self.forget()
        number, known = self.number, len(self.number)
        rows = []
        for text in texts:
            found = self.pattern.findall(text) if text else []
            for x in set(found).difference(number):
                number[x] = len(number)
            rows.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        if len(number) > known:
            self._learn([x.encode() for x in list(number)[known:]])
        start = np.cumsum(self.count) - self.count
        sizes = np.array([len(x) for x in rows], np.int64)
        pieces = np.concatenate(rows) if rows else np.empty(0, np.int32)
        count = self.count[pieces]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        index = np.repeat(start[pieces] - (ends - count), count)
        index += np.arange(total)
        per = np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))])
        return self.ids[index], per

    def _learn(self, new: list[bytes]) -> None:
        """Adds the ids of pre-tokens; one that is a token itself is that token."""
        whole = np.array([self.vocabulary.ranks.get(x, -1) for x in new], np.int64)
        other = np.flatnonzero(whole < 0)
        count = np.ones(len(new), np.int64)
        size = np.fromiter(map(len, new), np.int64, len(new))
        alone = {i: merge_long(self.vocabulary, np.frombuffer(new[i], np.uint8)) for i in other[size[other] > LONG].tolist()}
        other = other[size[other] <= LONG]
        parts = [new[i] for i in other.tolist()]
        ids, many = merge_all(self.vocabulary, np.frombuffer(b"".join(parts), np.uint8), size[other]) if parts else (np.empty(0, np.int32), [])
        count[other] = many
        count[list(alone)] = [len(x) for x in alone.values()]
        ends = np.cumsum(count)
        out = np.empty(int(ends[-1]), np.int32)
        short = whole < 0
        short[list(alone)] = False
        out[np.repeat(short, count)] = ids
        known = whole >= 0
        out[np.repeat(known, count)] = whole[known]
        for i, x in alone.items():
            out[ends[i] - len(x) : ends[i]] = x
        self.ids, self.count = np.concatenate([self.ids, out]), np.concatenate([self.count, count])
        self.held += int(size.sum()) + out.nbytes + ENTRY * len(new)


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a rank file (base64 token and rank on each line) on the driver: some 50,000 lines."""
    with open(path) as file:
        return Vocabulary(file.readlines())


def encode(
    docs: DataFrame, path: str, pattern: str, keep: list[str], text_col: str = "text", ids: bool = True, digests: bool = False
) -> DataFrame:
    """``docs``' columns ``keep`` with ``n_tokens``, the ``ids`` themselves, and digests if asked for:
    ``ids_sha256`` of the ids as little-endian 32-bit integers and ``decoded_sha256`` of the bytes that
    the ids decode to.
    """
    shared = Shared(docs.sparkSession, Encoder(load_vocabulary(path), pattern))  # size fixed by the file
    source, columns = numbered(docs, keep, F.col(text_col).alias("_text"))
    made = ["n_tokens", *(["ids"] if ids else []), *(["ids_sha256", "decoded_sha256"] if digests else [])]
    types = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = ", ".join([*columns, *(f"{c} {types[c]}" for c in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        vocabulary = encoder.vocabulary
        for batch in in_slices(batches, len(keep), HELD_CHARS):
            flat, per = encoder.encode(batch.column(len(keep)).to_pylist())
            ends = np.cumsum(per)
            out = [pa.array(per)]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat)))
            if digests:
                little = flat.astype("<u4")
                data, length = vocabulary.decode(flat)
                byte_ends = np.concatenate(([0], np.cumsum(length)))[ends].tolist()
                sha = lambda a, stops: [hashlib.sha256(a[x:y].tobytes()).hexdigest() for x, y in zip([0, *stops[:-1]], stops, strict=True)] if stops else []
                out += [pa.array(sha(little, ends.tolist()), pa.string()), pa.array(sha(data, byte_ends), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[*batch.schema.names[: len(keep)], *made])

    return renamed(source.mapInArrow(run, schema), keep, made)


def decode(encoded: DataFrame, path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` and ``bytes``, what each row's ids decode to; null ids decode to no bytes."""
    shared = Shared(encoded.sparkSession, load_vocabulary(path))
    source, columns = numbered(encoded, keep, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            data, length = shared.value.decode(column.flatten().to_numpy())
            ends = np.cumsum(column.value_lengths().to_numpy())
            stops = np.concatenate(([0], np.cumsum(length)))[ends].tolist()
            values = [data[x:y].tobytes() for x, y in zip([0, *stops[:-1]], stops, strict=True)] if stops else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(values, pa.binary())], names=[*batch.schema.names[: len(keep)], "bytes"])

    return renamed(source.mapInArrow(run, ", ".join([*columns, "bytes binary"])), keep, ["bytes"])
