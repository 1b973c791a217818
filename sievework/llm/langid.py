"""Language identification by compression with zstandard raw-content dictionaries.

Each language's dictionary is text of that language, taken from a bounded sample of labelled
rows.  A text is lower-cased, reduced to its letters with single spaces between runs of them, and compressed,
whole, in blocks with each dictionary; the language whose dictionary gives the fewest bytes is
predicted.  A text whose smallest and second smallest sizes are close is rejected.  A block
that is short is written four times over, because zstandard stores what it can hardly shrink.

The sample: for each language the rows with the least hash in each of ``slots`` hash slots; of each up to
``excerpt`` characters in ``PIECES`` pieces spread evenly over the whole text, so at most ``slots * excerpt`` characters
per language however large the table.  Prediction sees the whole text and nothing else.

Defined results: letters are the characters of Unicode's category L, with the marks that follow them.  A null text, or one
without a letter, is ``und`` with score 0 and rejected; so is every text where no row is labelled.  Of languages with
equal sizes the one with more labelled rows wins.  Repeated rows get equal results, and count once in the sample.  An empty table gives an empty result.  A kept column named like one made here gives way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.common import Shared, bounded_broadcast
from sievework.llm.packing import in_slices, numbered, renamed

SLOTS, EXCERPT, PIECES = 128, 1500, 5
LEVEL, BLOCK, SHORT = 5, 4096, 400
#: Texts whose runner-up is less than this share larger are rejected.
MARGIN = 0.01
_apart = regex.compile(r"[^\p{L}\p{M}]+").sub
_letter = regex.compile(r"\p{L}").search


def letters(text: str | None) -> bytes:
    """Lower-cased letters of a text and their marks, one space between runs of them; empty without a letter."""
    low = _apart(" ", (text or "").lower()).strip()
    return low.encode() if _letter(low) else b""


def held_out(id_col: str) -> Column:
    """Whether a row is kept out of learning: crc32 of its id as text is 2 modulo 4 (null id: no)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def spread(text: Column, chars: int, pieces: int = PIECES) -> Column:
    """Up to ``chars`` characters of a text: all of it, or pieces spread evenly from its start to its end, a line each."""
    each = chars // pieces
    step = (F.length(text) - each) / F.lit(float(max(pieces - 1, 1)))
    some = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substr(text, F.floor(i * step).cast("int") + 1, F.lit(each)))
    return F.when(F.length(text) <= chars, text).otherwise(F.array_join(some, "\n"))


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", slots: int = SLOTS, excerpt: int = EXCERPT) -> list[tuple[str, bytes]]:
    """Dictionary text of each language, the language with most rows first.

    Two scans: the least hash of each slot, then the excerpts of those rows, met by a join.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0))
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    slot = F.pmod(F.shiftright("h", 7), F.lit(slots)).alias("slot")
    least = known.groupBy("lang", slot).agg(F.min("h").alias("h"), F.count("*").alias("n")).collect()  # slots rows per language
    if not least:
        return []
    rows: dict[str, int] = {}
    for r in least:
        rows[r["lang"]] = rows.get(r["lang"], 0) + r["n"]
    wanted = labelled.sparkSession.createDataFrame([(r["lang"], r["h"], r["slot"]) for r in least], "lang string, h long, slot long")
    picked = known.join(bounded_broadcast(wanted), ["lang", "h"]).select("lang", "slot", spread(F.col("text"), excerpt).alias("text"))
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in picked.distinct().collect():  # one row per slot and language
        texts.setdefault(r["lang"], []).append((r["slot"], letters(r["text"])))
    return [(lang, b"\n".join(t for _, t in sorted(texts[lang]))) for lang in sorted(texts, key=lambda x: (-rows[x], x))]


class Compressors:
    """One compressor per language."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.each = []
        for lang, text in dictionaries:
            held = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.each.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)))

    def judge(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """Language, score and whether the text is accepted."""
        data = letters(text)
        if not data or not self.each:
            return "und", 0.0, False
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        blocks = [(b + b" ") * 4 if len(b) < SHORT else b for b in blocks]
        sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in self.each]
        best = min(sizes)
        at = sizes.index(best)
        second = min((s for i, s in enumerate(sizes) if i != at), default=2 * best)
        return self.each[at][0], 1.0 - 2.0 ** -min(second - best, 50), second - best >= margin * best and second > best


def identify(
    docs: DataFrame, dictionaries: list[tuple[str, bytes]], keep: list[str], text_col: str = "text", margin: float = MARGIN
) -> DataFrame:
    """``docs``' columns ``keep`` with ``lang_pred, score, accepted`` for each row's whole text."""
    source, types = numbered(docs, keep, F.col(text_col).alias("_text"))
    made = ["lang_pred", "score", "accepted"]
    shared = Shared(docs.sparkSession, dictionaries)  # at most SLOTS * EXCERPT bytes for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Compressors(shared.value).judge
        for batch in in_slices(batches, len(keep)):
            found = [judge(text.as_py(), margin) for text in batch.column(len(keep))]
            out = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[*batch.schema.names[: len(keep)], *made])

    return renamed(source.mapInArrow(run, ", ".join([*types, "lang_pred string, score double, accepted boolean"])), keep, made)
