"""Toxicity scores of text restored by a noisy-channel decoder.

1. Character model: trigram counts of lower-cased letters over all documents, summed in the tasks
   and then by a group; its alphabet is a-z, one class for other letters, and the word's edge, so the
   table has a fixed size.
2. Restoring: a stretch of text that looks disguised (symbols or digits between letters, letters
   set apart, letters repeated three times or more) becomes a lattice.  A symbol may be any letter it
   stands for, a separator vanishes, a repeated letter may stay or vanish, each at a price; Viterbi
   finds the likeliest letters under the trigram model.  Letters set apart are also read without their first or last,
   which may be words of their own (``a p o o p``), where at most ``LONGEST`` are left.
3. Score: words and word beginnings that are frequent in toxic training texts and rare in others carry
   the log of that ratio; a logistic regression on a text's evidence gives the score.

Learning takes at most ``SAMPLE`` labelled rows, those of least hashed id.  A term must be in at least
1 % of the toxic rows of the sample, which bounds the terms by the length of texts.  The scored text is always
whole.

Defined results: a null or empty text has no evidence and gets the score of a text without any; every text gets the
base rate of 0 where no label exists.  Rows labelled more than once count as toxic if any label says so.  Repeated
rows get equal scores.  An empty table gives an empty result.  Extra columns are ignored.  Very long texts are restored and scored whole.  Of readings
of equal value the one met first counts; labelled rows of equal hash are taken by id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import Shared, stored
from sievework.llm.packing import numbered, renamed

#: Labelled rows that learning takes at most.
SAMPLE = 40_000
#: Share of toxic sample rows that must hold a term, and the least log ratio of its frequencies.
COMMON, RATIO = 0.01, 1.0
#: Lengths of word beginnings that are terms beside whole words.
BEGINNINGS = (4, 5, 6, 7)
#: Letters of the longest word that is looked for beside one-letter words.
LONGEST = 24
#: Characters of disguised spans and of the objects around them that a worker remembers.
MEMORY, ENTRY = 40_000_000, 200

# Letters that symbols and digits stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~'`,/\\ "
#: Prices, as natural logs: a letter as it is, a symbol for a letter, a separator or a symbol that vanishes, a letter
#: that repeats the last and vanishes, in a run of three or more and in a pair.
AS_IS, STANDS_FOR, PARTED, DROPPED, DRAWN_OUT, DOUBLED = 0.0, -1.5, -0.5, -12.0, -1.0, -9.0

_signs = re.escape("".join(c for c in LEET if not c.isdigit()))
_parts = re.escape(SEPARATORS)
_triple = re.compile(r"([^\W\d_])\1\1")
#: Runs of letters, digits and LEET signs, with separators within; and what is left of one without signs that also punctuate.
_runs = re.compile(rf"[\w{_signs}]+(?:[.*~\-]+[\w{_signs}]+)*")
_pieces = re.compile(r"(?:[^\W_]|[@$€£¡])+")
_single = rf"(?:[^\W_]|[{_signs}])"
_spaced = re.compile(rf"(?<![^\W_]){_single}(?:[{_parts}\s]++{_single}){{2,}}(?![^\W_])")
_symbols = re.compile(_single)
_words = re.compile(r"[^\W\d_]+")

EDGE, OTHER, LETTERS = 0, 27, 28


def _symbol(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else OTHER


class CharacterModel:
    """Interpolated trigram log probabilities over the 28 symbols."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + LETTERS)
        p2 = (two + 2 * p1) / (two.sum(1, keepdims=True) + 2)
        p3 = (three + 4 * p2[None]) / (three.sum(2, keepdims=True) + 4)
        self.log = np.log(p3).tolist()

    def restore(self, seen: str) -> str:
        """The likeliest letters behind a disguised span."""
        return self.decode(seen)[0]

    def decode(self, seen: str) -> tuple[str, float]:
        """The likeliest letters behind a disguised span and their log value: Viterbi over (last two letters)."""
        states: dict = {(EDGE, EDGE, ""): (0.0, None)}  # last two symbols and the last character read; letters are linked
        for i, c in enumerate(seen):
            new: dict = {}
            again = DRAWN_OUT if c * 3 in seen[max(0, i - 2) : i + 3] else DOUBLED

            def put(key: tuple, value: float, text: tuple | None) -> None:
                if key not in new or new[key][0] < value:
                    new[key] = (value, text)

            for (a, b, last), (value, text) in states.items():
                if c.isalpha():
                    x = _symbol(c)
                    put((b, x, c), value + AS_IS + self.log[a][b][x], (text, c))
                    if c == last:
                        put((a, b, c), value + again, text)
                else:
                    if c in SEPARATORS or c in LEET:
                        put((a, b, last), value + (PARTED if c in SEPARATORS else DROPPED), text)
                    for letter in LEET.get(c, ""):
                        x = _symbol(letter)
                        put((b, x, letter), value + STANDS_FOR + self.log[a][b][x], (text, letter))
                        if letter == last:
                            put((a, b, letter), value + STANDS_FOR + again, text)
            states = new or states
        ended = lambda s: s[1][0] + self.log[s[0][0]][s[0][1]][EDGE]
        best = max(states.items(), key=ended)
        text, letters = best[1][1], []
        while text:
            text, letter = text
            letters.append(letter)
        return "".join(reversed(letters)), ended(best)


def _without_ends(spaced: str) -> list[str]:
    """A spaced span, and it without a first or last symbol that may be a word of its own, if that leaves a word."""
    at = [m.start() for m in _symbols.finditer(spaced)]
    cut = [(i, j) for i in (0, 1) for j in (0, 1) if i + j and 3 <= len(at) - i - j <= LONGEST]
    return [spaced, *(spaced[at[i] : at[len(at) - 1 - j] + 1] for i, j in cut)]


class Restorer:
    """Finds disguised spans of a text and restores them; remembers spans it has seen."""

    def __init__(self, model: CharacterModel):
        self.model, self.known, self.held = model, {}, 0

    def restored(self, seen: str) -> str:
        if (got := self.known.get(seen)) is None:
            got = self.model.restore(seen)
            self.held += len(seen) + len(got) + ENTRY
            if self.held > MEMORY:
                self.known.clear()
                self.held = 0
            else:
                self.known[seen] = got
        return got

    def words(self, text: str | None) -> tuple[set[str], int]:
        """Distinct words of the restored text, those as written included, and how many it has."""
        low = (text or "").lower()
        plain = _words.findall(low)
        found = set(plain)
        odd = set(_runs.findall(low)) - found
        odd.update([piece for run in odd for piece in _pieces.findall(run)])
        for spaced in _spaced.findall(low):
            for part in _without_ends(" ".join(spaced.split())):
                odd.add(part)
                found.add("".join(_words.findall(part)))  # doubled letters as written
        found.discard("")
        found.update([self.restored(seen) for seen in odd - found if _words.search(seen)])
        points = np.frombuffer(low.encode("utf-32-le"), np.uint32)
        drawn = np.flatnonzero((points[2:] == points[1:-1]) & (points[1:-1] == points[:-2]))
        if any(low[i].isalpha() for i in drawn.tolist()):
            found.update([self.restored(w) for w in found if _triple.search(w)])
        return found, len(plain)


def terms(words: set[str]) -> set[str]:
    """Words and their beginnings; a beginning ends in an asterisk."""
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of the trigrams of all texts' words; the result has LETTERS ** 3 cells whatever the input."""
    table = np.full(128, OTHER, np.uint8)
    table[[ord(c) for c in map(chr, range(128)) if not c.isalpha()]] = EDGE
    table[97:123] = table[65:91] = np.arange(1, 27)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            joined = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), pa.compute.fill_null(batch.column(0), "")), " ")
            data = np.frombuffer(joined[0].as_buffer(), np.uint8)
            for i in range(0, len(data), 1 << 22):
                part = data[max(0, i - 2) : i + (1 << 22)]
                # Of a letter beyond ASCII the first byte counts, the others go.
                part = part[(part & 0xC0) != 0x80]
                s = np.where(part < 128, table[np.minimum(part, 127)], OTHER).astype(np.int64)
                s = np.concatenate(([EDGE, EDGE], s, [EDGE])) if i == 0 else s
                before = np.where(s[1:-1] == EDGE, EDGE, s[:-2])  # at a word's start there is only its edge
                key = (before * LETTERS + s[1:-1]) * LETTERS + s[2:]
                key = key[(s[1:-1] != EDGE) | (s[2:] != EDGE)]
                total += np.bincount(key, minlength=LETTERS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    counts = np.zeros(LETTERS**3, np.int64)
    for r in docs.select(text_col).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return counts


class Scorer:
    """Weights of terms and of the regression on a text's evidence."""

    def __init__(self, model: CharacterModel, weights: dict[str, float], line: list[float]):
        self.model, self.weights, self.line = model, weights, line
        self.starts = {t.rstrip("*")[: min(BEGINNINGS)] for t in weights}

    def evidence(self, words: set[str], n: int) -> list[float]:
        """Of a text: a constant, the strongest evidence, the rest of it, and the length.

        A word counts with its strongest term.
        """
        found = []
        weights, starts, n_start = self.weights, self.starts, min(BEGINNINGS)
        for w in words:
            if w[:n_start] not in starts:
                continue
            best = weights.get(w, 0.0)
            for k in BEGINNINGS:
                if len(w) <= k:
                    break
                x = weights.get(w[:k] + "*", 0.0)
                if x > best:
                    best = x
            if best:
                found.append(best)
        found.sort(reverse=True)
        return [1.0, *(found[:2] + [0.0, 0.0])[:2], min(sum(found[2:]), 30.0), 100.0 * len(found) / (n + 20.0), math.log1p(n)]

    def score(self, words: set[str], n: int) -> float:
        if not self.line:
            return 0.0
        z = sum(a * b for a, b in zip(self.line, self.evidence(words, n), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression with a little ridge, by Newton's method."""
    scale = np.abs(x).max(0) + 1e-9
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return (w / scale).tolist()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """A scorer from documents and ``labels(id_col, label_col)``, of which at most ``sample`` rows are taken."""
    model = CharacterModel(count_trigrams(docs, text_col))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "_id")
    texts = stored(texts.select("text", F.col("_toxic").cast("int").alias("toxic")))  # read three times below

    def count_terms(only: set[str] | None):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(model)
            counts: Counter = Counter()
            rows = 0
            for batch in batches:
                for text in batch.column(0):
                    found = terms(restorer.words(text.as_py())[0])
                    counts.update(found if only is None else found & only)
                    rows += 1
            counts[""] = rows
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

        return each

    def counted(toxic: int, only: set[str] | None) -> DataFrame:
        return texts.where(F.col("toxic") == toxic).select("text").mapInArrow(count_terms(only), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    hot = counted(1, None)
    n1 = (hot.where("term = ''").first() or {"n": 0})["n"]
    if not n1:
        return Scorer(model, {}, [])
    toxic = {r["term"]: r["n"] for r in hot.where((F.col("n") >= max(3.0, COMMON * n1)) & (F.col("term") != "")).collect()}
    clean = {r["term"]: r["n"] for r in counted(0, set(toxic)).collect()}
    n0 = clean.get("", 0)
    weights = {t: math.log((n + 0.5) / (n1 + 1)) - math.log((clean.get(t, 0) + 0.5) / (n0 + 1)) for t, n in toxic.items()}
    scorer = Scorer(model, {t: w for t, w in weights.items() if w >= RATIO}, [])

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            rows = [scorer.evidence(*restorer.words(text.as_py())) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    rows = texts.mapInArrow(evidence, "x array<double>, toxic int").collect()  # at most ``sample`` rows of six numbers
    scorer.line = _logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return scorer


def score(docs: DataFrame, scorer: Scorer, keep: list[str], text_col: str = "text") -> DataFrame:
    """``docs``' columns ``keep`` with ``score``."""
    shared = Shared(docs.sparkSession, scorer)  # its terms are bounded, see above
    source, types = numbered(docs, keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        restorer = Restorer(held.model)
        for batch in batches:
            found = [held.score(*restorer.words(text.as_py())) for text in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, pa.float64())], names=[*batch.schema.names[: len(keep)], "score"])

    return renamed(source.mapInArrow(run, ", ".join([*types, "score double"])), keep, ["score"])
