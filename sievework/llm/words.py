"""Words and rolling hashes of whole Arrow columns of text, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash

#: Bytes of text whose arrays are held at once; a longer text is held alone.
HELD_BYTES = 400_000
#: Polynomials modulo 2**64 tell spans of up to this many bytes apart well; those of a thousand and more have known collisions.
LONG_WORD = 256
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit words whose output bits look independent."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse, grown as they are needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64)))) for b in (BASE, INVERSE))


class Rolling:
    """Prefix polynomial hashes modulo 2**64 of a row of numbers: the hash of any span in two look-ups."""

    def __init__(self, values: np.ndarray, powers: Powers):
        powers.need(len(values) + 1)
        self.down = powers.down
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers.up[: len(values)], out=self.sums[1:])

    def span(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def slices(column: pa.Array, held: int = HELD_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold up to ``held`` bytes, or one row."""
    ends = np.cumsum(np.nan_to_num(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(float)))
    i = 0
    while i < len(column):
        limit = (ends[i - 1] if i else 0) + held
        j = max(i + 1, int(np.searchsorted(ends, limit, "right")))
        yield i, j
        i = j


class Words:
    """The words of the texts of an Arrow column (null: none): where they start and end in its bytes."""

    def __init__(self, column: pa.Array):
        column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
        n = len(column)
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
        self.data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        self.text = at
        space = SPACE[self.data]
        edge = np.empty(len(space), bool)
        if len(space):
            filled = at[:-1][at[1:] > at[:-1]]
            edge[0] = True
            edge[1:] = space[:-1]
            edge[filled] = True
            self.start = np.flatnonzero(~space & edge)
            edge[-1] = True
            edge[:-1] = space[1:]
            edge[at[1:][at[1:] > at[:-1]] - 1] = True
            self.stop = np.flatnonzero(~space & edge) + 1
        else:
            self.start = self.stop = np.empty(0, np.int64)
        #: Words before each text, and after the last.
        self.first = np.searchsorted(self.start, at)

    def hashes(self, powers: Powers) -> np.ndarray:
        """A 64-bit hash of each word."""
        rolling = Rolling(self.data.astype(np.uint64) + np.uint64(1), powers)
        size = self.stop - self.start
        hashed = scramble(rolling.span(self.start, self.stop) + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD):  # texts without spaces: few, however long
            hashed[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i] : self.stop[i]])
        return hashed
