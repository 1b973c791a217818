"""Anchors of texts: places that every long enough common substring has in common.

A gram of ``GRAM`` bytes is an anchor where its hash is the least of some ``window`` grams in a row.  The choice depends on those bytes
alone, so two texts that share ``GRAM + window - 1`` bytes share an anchor in them, wherever the shared stretch stands in either.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 32
#: Bytes of a text whose arrays are held at once; a longer one is read in overlapping parts.
PART = 1 << 20
_ODD = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of a row of bytes, by doubling their length five times."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD)
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(_ODD, 2 * size + 1, 2**64)) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _running(h: np.ndarray, window: int, of: np.ufunc, last: int) -> np.ndarray:
    """Least (or greatest) of every ``window`` numbers in a row: blocks of a window each, from their starts and to their ends."""
    n = len(h) - window + 1
    padded = np.concatenate([h, np.full(-len(h) % window, last, np.uint64)]).reshape(-1, window)
    ahead = of.accumulate(padded, axis=1).ravel()
    back = of.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(back[:n], ahead[window - 1 : window - 1 + n])


def anchors(data: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one text, in order; none in fewer bytes than ``GRAM + window - 1``."""
    whole, reach = np.frombuffer(data, np.uint8), GRAM + window - 1
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for start in range(0, max(len(whole) - reach + 1, 0), PART):
        h = gram_hashes(whole[start : start + PART + reach - 1])
        least = _running(h, window, np.minimum, 2**64 - 1)
        edge = np.zeros(window - 1, np.uint64)
        chosen = np.flatnonzero(_running(np.concatenate([edge, least, edge]), window, np.maximum, 0) == h)
        places.append(chosen + start)
        hashes.append(h[chosen])
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def text_anchors(df: DataFrame, keys: Sequence[str], text: str, window: int) -> DataFrame:
    """``(keys..., seed, place)``: the anchors of each row's text, places in bytes from 0; null texts have none.  No text is shuffled."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                at, h = anchors(batch.column(len(keys))[i].as_py() or b"", window)
                if len(at):
                    own = [c.take(pa.array(np.full(len(at), i))) for c in batch.columns[: len(keys)]]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(h.view(np.int64)), pa.array(at)], names=[*keys, "seed", "place"])

    rows = df.select(*keys, F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "seed long, place long"]))
