"""Entries of reference data linked to outside candidates by label, class and description, scored.

Labels meet by equality of forms, so no pair is made of what merely shares a word.  What a candidate's label, less a word
at its end or start or less a suffix, adds to a score depends on the candidate alone, so each form keeps its best candidate per relation: an entry meets
one row per relation, however many candidates share its name.  Names, synonyms and labels are folded.

Ties go to the least ``ord``, then the least candidate; null classes, descriptions and synonyms are empty; entries without a candidate stay, with note
``none``.  ``found(entry, candidate)`` may add pairs of a search, whose candidates are scored whatever their labels are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points: any grape candidate, its label equal, its label a synonym, the name at an end of the label, a mutation of another.
GRAPE, EQUAL, SYNONYM, WITHIN, MUTATION, GRAPE_OK = 10, 20, 15, 3, -5, 25
#: Points: a class of wine regions, an administrative class, a description of wine, a suffix after the name.
WINE, ADMIN, DESCRIBED, SUFFIXED, REGION_OK = 30, 15, 5, 3, 30
# Words by which a class or a description tells what a candidate is.
REGION_CLASS_WORDS, REGION_WORDS = ("wine", "vineyard", "appellation"), ("wine", "viticultural")
DESCRIBED_WORDS = ("wine", "appellation", "viticultural")
GRAPE_PHRASES = ("varietal", "variety of grape", "wine grape")


def _text(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def _labels(c: str) -> Column:
    return F.lower(F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), " "))


def _any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def _is_a(ids: Sequence[str]) -> Column:
    held = F.concat(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("classes", "supers")])
    return F.arrays_overlap(held, F.array(*map(F.lit, ids)).cast("array<string>"))


def _forms(label: Column) -> Column:
    """(form, relation) of a label: itself, and what stands before and after each of its spaces."""
    words = F.split(label, " ")
    places = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    part = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    of = lambda form, relation: F.struct(form.alias("form"), F.lit(relation).alias("relation"))
    return F.concat(F.array(of(label, "equal")), F.transform(places, lambda i: of(part(F.lit(1), i), "within")), F.transform(places, lambda i: of(part(i + 1, F.size(words)), "within")))


def _best(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the candidate of the highest score, then of least ``ord``, then the least."""
    return rows.groupBy(*keys).agg(F.min(F.struct((-F.col("score")).alias("less"), "ord", "candidate")).alias("b")).select(*keys, (-F.col("b.less")).alias("score"), "b.ord", "b.candidate")


def _noted(entries: DataFrame, scored: DataFrame, ok: int, review: str) -> DataFrame:
    top = _best(scored, ["entry"]).select("entry", "candidate", "score")
    note = F.when(F.col("candidate").isNull(), "none").when(F.col("score") >= ok, "ok").otherwise(review)
    return entries.select("entry").join(top, "entry", "left").withColumn("note", note)


def link_grapes(entries: DataFrame, candidates: DataFrame, grape: Sequence[str], mutation: Sequence[str] = (), found: DataFrame | None = None) -> DataFrame:
    """The best grape of each of ``entries(entry, name, synonyms)``: ``entry, candidate, score, note``.

    ``candidates(candidate, label, description, classes, supers, class_labels, ord)``; ``grape`` and ``mutation`` are ids of classes.
    """
    desc, kinds = _text("description"), _labels("class_labels")
    told = (_any(desc, ["grape"]) & _any(desc, ["wine"])) | F.endswith(desc, F.lit("grape variety")) | F.startswith(desc, F.lit("grape variety")) | desc.isin(*GRAPE_PHRASES)
    sport = F.arrays_overlap(F.coalesce("classes", F.array().cast("array<string>")), F.array(*map(F.lit, mutation)).cast("array<string>")) | F.contains(desc, F.lit("mutation"))
    own = F.lit(GRAPE) + F.when(sport, MUTATION).otherwise(0)
    sound = candidates.where(_is_a(grape) | _any(kinds, ["grape", "vitis"]) | told).select("candidate", "label", "ord", own.alias("own"))
    forms = _best(sound.select("candidate", "ord", F.col("own").alias("score"), F.explode(_forms(F.col("label"))).alias("f")).select("*", "f.*"), ["form", "relation"])
    synonyms = F.array_except(F.coalesce("synonyms", F.array().cast("array<string>")), F.array("name"))
    wanted = entries.select("entry", F.col("name").alias("form"), F.explode(F.array(*[F.struct(F.lit(r).alias("relation"), F.lit(w).alias("more")) for r, w in (("equal", EQUAL), ("within", WITHIN))])).alias("x"))
    wanted = wanted.select("entry", "form", "x.*").union(entries.select("entry", F.explode(synonyms).alias("form"), F.lit("equal").alias("relation"), F.lit(SYNONYM).alias("more")))
    scored = wanted.join(forms, ["form", "relation"]).select("entry", "candidate", "ord", (F.col("score") + F.col("more")).alias("score"))
    if found is not None:
        pairs = found.select("entry", "candidate").join(sound, "candidate").join(entries.select("entry", "name", F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms")), "entry")
        ends = F.startswith("label", F.concat("name", F.lit(" "))) | F.endswith("label", F.concat(F.lit(" "), "name"))
        more = F.when(F.col("label") == F.col("name"), EQUAL).when(F.array_contains("synonyms", F.col("label")), SYNONYM).when(ends, WITHIN).otherwise(0)
        scored = scored.union(pairs.select("entry", "candidate", "ord", (F.col("own") + F.coalesce(more, F.lit(0))).alias("score")))
    return _noted(entries, scored, GRAPE_OK, "inexact label")


def link_regions(entries: DataFrame, candidates: DataFrame, wine: Sequence[str], suffixes: Sequence[str], admin_words: Sequence[str]) -> DataFrame:
    """The best place of each of ``entries(entry, name, classification)``: ``entry, candidate, score, note``.

    A label is the name, or the name and one of ``suffixes``.  A wine region counts by a class of ``wine``, its classes' names or its description; an
    administrative one, by ``admin_words`` in its classes' names, counts only for entries without a classification; nothing else does.
    """
    desc, kinds = _text("description"), _labels("class_labels")
    region = _is_a(wine) | _any(kinds, REGION_CLASS_WORDS) | _any(desc, REGION_WORDS)
    tier = F.when(region, "wine").when(_any(kinds, [*admin_words, "valley"]), "admin")
    own = F.when(region, WINE).otherwise(ADMIN) + F.when(_any(desc, DESCRIBED_WORDS), DESCRIBED).otherwise(0)
    of = lambda form, more: F.struct(form.alias("form"), F.lit(more).alias("more"))
    cut = [F.when(F.endswith("label", F.lit(s)), of(F.expr(f"substring(label, 1, length(label) - {len(s)})"), SUFFIXED)) for s in suffixes]
    forms = F.array_compact(F.array(of(F.col("label"), 0), *cut))
    sound = candidates.withColumn("tier", tier).where("tier IS NOT NULL").select("candidate", "ord", "tier", own.alias("own"), F.explode(forms).alias("f"))
    best = _best(sound.select("candidate", "ord", "tier", "f.form", (F.col("own") + F.col("f.more")).alias("score")), ["form", "tier"])
    fits = (F.col("tier") == "wine") | F.col("classification").isNull()
    scored = entries.select("entry", "classification", F.col("name").alias("form")).join(best, "form").where(fits)
    return _noted(entries, scored.select("entry", "candidate", "ord", "score"), REGION_OK, "no wine class")
