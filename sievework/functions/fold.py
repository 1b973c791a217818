"""The four text folds, exact by Arrow UDF, and a twin made of built-in functions for Latin text.

They differ on purpose: ``ingest`` folds case fully (sharp s becomes ss), ``text`` and ``token`` only
lower, ``token`` keeps white space, and ``label`` also opens hyphens and writes Saint in full.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("ingest", "text", "label", "token")


def _bare(text: str) -> str:
    """``text`` decomposed, without its combining marks."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _one_space(text: str) -> str:
    return " ".join(text.split())


_hyphen_within = re.compile("(?<=\\S)[-\u2010\u2011](?=\\S)")
_short_saint = re.compile(r"\bst(e?)\b\.?")


def fold_text(text: str, kind: str) -> str:
    """One string folded; the UDF applies this to a batch."""
    bare = _bare(text)
    if kind == "ingest":
        return _one_space(bare.casefold())
    if kind == "token":
        return bare.lower()
    if kind == "text":
        return _one_space(bare).lower()
    return _one_space(_short_saint.sub(r"saint\1", _hyphen_within.sub(" ", bare.lower())))


def fold(column: Column, kind: str = "text") -> Column:
    """``column`` folded; null stays null."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {', '.join(KINDS)}")

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else fold_text(t, kind))

    return run(column)


def _latin() -> tuple[str, str]:
    """Letters of the Latin blocks that fold to one ASCII letter, and those letters."""
    pairs = [(chr(c), _bare(chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_latin(column: Column, keep_space: bool = False) -> Column:
    """The ``text`` fold (``token`` with ``keep_space``) for composed Latin text, inside codegen.

    Equal to ``fold`` where every accented letter is a single code point of U+00C0 to U+024F; ligatures
    and compatibility forms stay as they are.
    """
    bare = F.lower(F.translate(column, *_latin()))
    return bare if keep_space else F.trim(F.regexp_replace(bare, r"\s+", " "))
