"""Names of a dictionary found in text: leftmost, longest, each word used once.

``find_names`` joins the word n-grams of texts with the dictionary's aliases by their hashes, so neither has to fit anywhere;
``find_phrases`` scans each text with a trie in every worker, for dictionaries of checked size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.common import BROADCAST_ROWS, Shared, stored
from sievework.functions.fold import fold_text

#: Aliases that a worker may hold; more are refused, so that what is broadcast stays bounded.
MOST_ALIASES = 2_000_000
_joined = re.compile(r"[ \-'’.]+")


def build_phrase_index(labels: DataFrame, generic: Sequence[str] = (), least_name: int = 4, least_synonym: int = 5) -> DataFrame:
    """Aliases fit for matching from ``labels(kind, name, alias, is_name, priority)``.

    Short ones and generic words go; ``alias`` is folded already.
    """
    long = F.length("alias") >= F.when(F.col("is_name"), least_name).otherwise(least_synonym)
    usable = labels.where(long & ~F.col("alias").isin(list(generic)) if generic else long)
    return usable.select("kind", "name", "alias", "priority").distinct()


class _Trie:
    """Word trie; a terminal holds the best (priority, kind, name) of its alias."""

    def __init__(self, rows: Sequence[tuple[str, str, str, int]]):
        self.root: dict = {}
        for kind, name, alias, priority in rows:
            node = self.root
            for word in re.findall(r"[a-z0-9]+", alias):
                node = node.setdefault(word, {})
            if node is not self.root:
                node[""] = min(node.get("", (priority, kind, name)), (priority, kind, name))

    def scan(self, text: str) -> list[dict]:
        folded = fold_text(text, "text")
        spans = [(m[0], m.start(), m.end()) for m in re.finditer(r"[a-z0-9]+", folded)]
        out, i = [], 0
        while i < len(spans):
            node, j, best = self.root.get(spans[i][0]), i, None
            while node is not None:
                if "" in node:
                    best = (j, node[""])
                j += 1
                if j >= len(spans) or not _joined.fullmatch(folded, spans[j - 1][2], spans[j][1]):
                    break
                node = node.get(spans[j][0])
            if best is None:
                i += 1
            else:
                out.append({"kind": best[1][1], "name": best[1][2], "pos": i})
                i = best[0] + 1
        return out


def find_phrases(df: DataFrame, text: str, index: DataFrame, column: str = "matches") -> DataFrame:
    """``df`` with an array of (kind, name, pos): the names that the text mentions, in order.

    ``index`` is collected once and shared with the workers; it is counted first.
    """
    rows = index.select("kind", "name", "alias", "priority").limit(MOST_ALIASES + 1).collect()
    if len(rows) > MOST_ALIASES:
        raise ValueError(f"the dictionary has more than {MOST_ALIASES} aliases; split it by kind")
    shared = Shared(df.sparkSession, _Trie([tuple(r) for r in rows]))

    @F.pandas_udf("array<struct<kind:string,name:string,pos:int>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shared.value.scan(t or ""))

    return df.withColumn(column, run(F.col(text)))


def phrase_tokens(folded: Column) -> Column:
    """Words of folded text in order, with a line break where what stands between two words cannot join them to one name."""
    broken = F.regexp_replace(F.coalesce(folded, F.lit("")), r"[^a-z0-9 \-'’.]", "\n")
    return F.regexp_extract_all(broken, F.lit(r"([a-z0-9]+|\n)"), 1)


#: Bytes of text, and words of it, whose arrays are held at once.
HELD, CHUNK = 1 << 20, 1 << 16
#: Places of the filter that n-grams pass before they are sent to the join: 8 MB of bits, whatever the dictionary.
PLACES = 1 << 26
_KIND = np.zeros(256, np.uint8)  # 0 ends a name, 1 stands in a word, 2 joins words
_KIND[[*range(48, 58), *range(97, 123)]] = 1
_KIND[list(b" -'.")] = 2
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Phrases:
    """The words of folded texts, hashed: where each text's begin, and the n-grams of any length within names' reach."""

    def __init__(self, texts: Sequence[str]):
        parts = [t.encode().replace("’".encode(), b"'") for t in texts]
        data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        kind = _KIND[data]
        word = np.concatenate(([False], kind == 1, [False]))
        self.start, stop = np.flatnonzero(word[1:-1] & ~word[:-2]), np.flatnonzero(word[1:-1] & ~word[2:]) + 1
        self.ends = np.cumsum(kind == 0, dtype=np.int32)[self.start]  # names' ends before each word: equal for words of one run
        self.text = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), self.start, "right")
        self.first = np.searchsorted(self.text, np.arange(len(parts)))
        self.hashes = [np.empty(len(self.start), np.uint64) for _ in _BASES]
        for i in range(0, len(self.start), CHUNK):
            a, b = self.start[i : i + CHUNK], stop[i : i + CHUNK]
            size = b - a
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            values = data[np.repeat(a, size) + within].astype(np.uint64) + np.uint64(1)
            for held, base in zip(self.hashes, _BASES, strict=True):
                up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(int(size.max()), base, np.uint64))))
                held[i : i + CHUNK] = _mixed(np.add.reduceat(values * up[within], np.cumsum(size) - size) + size.astype(np.uint64))

    def grams(self, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The first words of all n-grams that no name's end cuts, and the grams' two hashes."""
        many = max(len(self.start) - n + 1, 0)
        at = np.flatnonzero(self.ends[:many] == self.ends[n - 1 :][:many])
        out = []
        for h, base in zip(self.hashes, _BASES, strict=True):
            g = h[at]
            for j in range(1, n):
                g = g * np.uint64(base) + h[at + j]
            out.append(_mixed(g))
        return at, out


def _hashed(aliases: DataFrame) -> DataFrame:
    """``aliases(phrase, ...)`` with the two hashes of their phrase as ``h, h2``."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aliases.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = _Phrases(batch.column(0).to_pylist())
            count = np.diff(np.append(phrases.first, len(phrases.start)))
            found = [np.zeros(len(batch), np.uint64) for _ in _BASES]
            for n in np.unique(count[count > 0]).tolist():
                at, hashes = phrases.grams(n)
                whole = np.isin(at, phrases.first[count == n])
                for held, h in zip(found, hashes, strict=True):
                    held[phrases.text[at[whole]]] = h[whole]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(h.view(np.int64)) for h in found)], names=[*batch.schema.names, "h", "h2"])

    return aliases.mapInArrow(run, f"{kinds}, h long, h2 long")


def _filter(aliases: DataFrame) -> Shared:
    """Bits of the places that some alias has: a fixed number of cells is collected."""
    placed = aliases.select(F.pmod(F.col("h"), F.lit(PLACES)).alias("place"))  # PLACES divides 2^64, so signs do not matter
    cells = placed.groupBy(F.shiftright("place", 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits"))
    bits = np.zeros(PLACES // 64, np.int64)
    for batch in cells.toArrow().to_batches():
        bits[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return Shared(aliases.sparkSession, bits.view(np.uint64))


def _small(aliases: DataFrame) -> Shared | None:
    """The hashes of all aliases, sorted, if they are at most ``BROADCAST_ROWS`` (16 MB); None if they are more, or two share the first hash."""
    if aliases.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return None
    found = aliases.select("h", "h2").toArrow()
    h, h2 = (found[c].to_numpy().view(np.uint64) for c in ("h", "h2"))
    order = np.argsort(h)
    return Shared(aliases.sparkSession, (h[order], h2[order])) if len(np.unique(h)) == len(h) else None


def _spans(texts: DataFrame, keys: int, lengths: Sequence[int], bare: bool, small: Shared | None, bits: Shared | None) -> DataFrame:
    """``(keys..., start, size, h, h2)`` of the n-grams of ``texts(keys..., text)``; ``bare`` texts are folded first.

    With ``small`` these are the names themselves, swept where the text is read; with ``bits`` all that pass the filter.
    """
    names = texts.columns[:keys]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[:keys]), "start int, size int, h long, h2 long"])

    def equal(h: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if small is None:
            spot = (h % np.uint64(PLACES)).astype(np.int64)
            return (bits.value[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
        first, second = small.value
        at = np.minimum(np.searchsorted(first, h), len(first) - 1)
        return (first[at] == h) & (second[at] == h2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(keys)), 0).to_numpy()
            ends, i = np.cumsum(sizes), 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + HELD, "right")))
                some = [t or "" for t in batch.column(keys).slice(i, j - i).to_pylist()]
                phrases, found = _Phrases([fold_text(t, "text") for t in some] if bare else some), []
                for n in lengths:
                    at, (h, h2) = phrases.grams(n)
                    hit = equal(h, h2)
                    found.append((at[hit], np.full(int(hit.sum()), n), h[hit], h2[hit]))
                at, size, h, h2 = (np.concatenate(x) for x in zip(*found, strict=True))
                if small is not None:
                    order = np.lexsort((-size, at))
                    order = order[_swept(at[order], size[order])]  # no name reaches into another text
                    at, size, h, h2 = at[order], size[order], h[order], h2[order]
                text = phrases.text[at]
                own = [c.take(pa.array(i + text)) for c in batch.columns[:keys]]
                made = [pa.array((at - phrases.first[text]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(h2.view(np.int64))]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[*names, "start", "size", "h", "h2"])
                i = j

    return texts.mapInArrow(run, schema)


def _swept(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of spans in order of their starts, longest first, those that overlap none taken before."""
    end, taken = 0, []
    for i, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        if start >= end:
            taken.append(i)
            end = start + size
    return np.array(taken, np.int64)


def _leftmost_longest(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each text's spans the leftmost, of those that start together the longest, and none that overlaps one before: one sweep over sorted spans."""
    placed = found.repartition(*keys).sortWithinPartitions(*keys, "start", F.col("size").desc())

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, end = None, 0
        for batch in batches:
            starts, sizes = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("start", "size"))
            own = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))), strict=True))
            taken = np.zeros(len(batch), bool)
            for i, (key, start, size) in enumerate(zip(own, starts, sizes, strict=True)):
                if key != text:
                    text, end = key, 0
                if start >= end:
                    taken[i], end = True, start + size
            yield batch.filter(pa.array(taken))

    return placed.mapInArrow(sweep, placed.schema)


def find_names(df: DataFrame, keys: Sequence[str], text: str, index: DataFrame, folded: bool = False) -> DataFrame:
    """``(keys..., pos, kind, name)``: the names that each text mentions; ``pos`` is the number of words before one.

    For dictionaries of any size: distinct aliases are stored once, with two 64-bit hashes.  Texts are cut into hashed n-grams of the lengths that aliases
    have, where they are read.  The hashes of up to a counted bound of aliases are sent there, and texts are swept there too.  Beyond it a filter of fixed
    size lets those n-grams through that some alias may equal; these meet the aliases by both hashes and are swept text by text, so only keys, places and hashes are
    shuffled.  Names join the matches that are left.
    ``keys`` tell texts apart; ``folded`` says that texts are folded.  Of equal aliases the one of least priority, kind and name counts.  Null and empty texts
    mention nothing.
    """
    words = F.regexp_extract_all("alias", F.lit("([a-z0-9]+)"), 1)
    best = F.min(F.struct("priority", "kind", "name")).alias("best")
    aliases = index.select(F.array_join(words, " ").alias("phrase"), F.size(words).alias("size"), "priority", "kind", "name").where("size > 0")
    aliases = stored(_hashed(aliases.groupBy("phrase", "size").agg(best).select("phrase", "size", "best.kind", "best.name")).drop("phrase"))
    lengths = [r["size"] for r in aliases.select("size").distinct().orderBy("size").collect()]  # at most as many as the longest alias has words
    names = [f"_k{i}" for i in range(len(keys))]
    if not lengths:
        return df.limit(0).select(*keys, F.lit(0).alias("pos"), F.lit("").alias("kind"), F.lit("").alias("name"))
    texts = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(text).alias("_text"))
    small = _small(aliases)
    taken = _spans(texts, len(keys), lengths, not folded, small, None if small else _filter(aliases))
    if small is None:
        hits = taken.join(aliases.select("h", "h2"), ["h", "h2"], "left_semi").select(*names, "start", "size", "h", "h2")
        taken = _leftmost_longest(hits, names)
    on = ["h"] if small else ["h", "h2"]  # the first hash tells a small dictionary's aliases apart
    taken = taken.select(*names, "start", *on).join(aliases.select(*on, "kind", "name"), on)
    return taken.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], F.col("start").alias("pos"), "kind", "name")


def name_lists(found: DataFrame, keys: Sequence[str], column: str = "matches") -> DataFrame:
    """The rows of ``find_names`` as one array of (pos, kind, name) per text, in order."""
    return found.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "name"))).alias(column))


def facts(matches: Column, kind: str) -> Column:
    """Distinct names of one kind, in order of first mention."""
    return F.array_distinct(F.transform(F.filter(matches, lambda m: m["kind"] == kind), lambda m: m["name"]))


def mentioned(alias: Column, folded: Column, least: int = 4) -> Column:
    """Whether folded text holds a folded alias as whole words."""
    padded = lambda c: F.concat(F.lit(" "), F.regexp_replace(c, "[^a-z0-9]+", " "), F.lit(" "))
    return (F.length(alias) >= least) & F.contains(padded(folded), padded(alias))
