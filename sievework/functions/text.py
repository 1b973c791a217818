"""Text predicates and token functions as column expressions; word lists are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.urls import longest_segment

WORDS = r"[a-z0-9]+"


def words(folded: Column) -> Column:
    """Runs of a-z and 0-9 of folded text."""
    return F.regexp_extract_all(F.coalesce(folded, F.lit("")), F.lit(f"({WORDS})"), 1)


def significant_tokens(folded: Column, stopwords: Sequence[str] = (), least: int = 4) -> Column:
    """Words of folded text that are long enough and no stopwords, in order, each once."""
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    return F.array_distinct(F.filter(words(folded), lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w)))


def contains_any(folded: Column, tokens: Column) -> Column:
    """Whether some token is a substring; no tokens: true."""
    return (F.size(tokens) == 0) | F.exists(tokens, lambda t: F.contains(folded, t))


def contains_all(folded: Column, tokens: Column) -> Column:
    """Whether every token is a substring; no tokens: false."""
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: F.contains(folded, t))


def url_only_tokens(tokens: Column, url_folded: Column, body_folded: Column, chars: int = 600) -> Column:
    """Tokens that the URL has and the first characters of the body have not."""
    head = F.substring(body_folded, 1, chars)
    return F.filter(tokens, lambda t: F.contains(url_folded, t) & ~F.contains(head, t))


def slug_words(url: Column, fold=F.lower) -> Column:
    """Distinct words of the longest path segment, folded."""
    return F.array_distinct(words(fold(longest_segment(url))))


def value_conflict(slug: Column, value: Column, conflicts: dict[str, Sequence[str]], own: Column) -> Column:
    """Whether the slug names what conflicts with ``value`` and is not among the item's own words."""
    hit = F.lit(False)
    for name, against in conflicts.items():
        against = F.array(*[F.lit(w) for w in against])
        hit = hit | ((value == name) & (F.size(F.array_except(F.array_intersect(slug, against), own)) > 0))
    return F.coalesce(hit, F.lit(False))


def is_search_echo(body: Column, pattern: str, group: int = 1) -> Column:
    """Whether the whole body echoes a query that is all lower case; ``pattern`` captures the query."""
    query = F.regexp_extract(F.trim(body), f"^(?:{pattern})$", group)
    return F.coalesce((query != "") & (query == F.lower(query)), F.lit(False))


def is_list_page(body: Column, least: int = 8, share: float = 0.7) -> Column:
    """Whether most words start upper case: a listing rather than prose."""
    found = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"([\p{L}][\p{L}'’\-]*)"), 1)
    upper = F.filter(found, lambda w: F.rlike(w, F.lit(r"^\p{Lu}")))
    return (F.size(found) >= least) & (F.size(upper) >= F.size(found) * share)


def clean_text(text: Column, phrases: Sequence[str] = (), sentences: Sequence[str] = ()) -> Column:
    """Text without stock phrases (any case) and without what the sentence patterns match, on one line."""
    out = text
    for phrase in phrases:
        quoted = "".join(f"\\{c}" if not c.isalnum() and c != " " else c for c in phrase)
        out = F.regexp_replace(out, f"(?i){quoted}", " ")
    for pattern in sentences:
        out = F.regexp_replace(out, f"(?i){pattern}", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def price_only(text: Column) -> Column:
    """Whether a text is empty or nothing but digits, currency signs and punctuation."""
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(r"^[\d\s.,:;/()%+\-\x{20AC}\x{00A3}\x{24}]*$"))


def keep_body(original: Column, cleaned: Column, least: int = 40, ratio: float = 0.4) -> Column:
    """Whether a cleaned body is long enough, lost little, and is more than a price."""
    long = F.length(cleaned) >= least
    return long & (F.length(cleaned) / F.greatest(F.lit(1), F.length(original)) >= ratio) & ~price_only(cleaned)


def truncate(text: Column, chars: int = 2000) -> Column:
    """The first characters of a text, null if it is blank."""
    cut = F.substring(text, 1, chars)
    return F.when(F.trim(cut) != "", cut)


def number(text: Column) -> Column:
    """A number written with or without thousands commas, null if it is none."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")
