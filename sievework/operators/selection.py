"""Choice and rendering of a product's context: rank, diversity, blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast, stored


def source_family(source: Column) -> Column:
    """A source label without its number, trimmed and lower-cased."""
    return F.lower(F.trim(F.regexp_replace(source, r"\s*#\d+$", "")))


def fact_rank(n_grapes: Column, n_regions: Column, score: Column, most: int = 3) -> list[Column]:
    """Sort order: names some grapes but no list of them, names a region, scores high."""
    some = F.when((n_grapes >= 1) & (n_grapes <= most), 1).otherwise(0)
    place = F.when((n_grapes <= most) & (n_regions > 0), 1).otherwise(0)
    return [some.desc(), place.desc(), score.desc()]


def pick_diverse(df: DataFrame, group: Sequence[str], family: str, rank: Sequence[Column], first: Column | None = None, n: int = 5) -> DataFrame:
    """The best ``n`` of each group in three passes, with ``pass`` and ``pick_no``.

    First the best row of each family for which ``first`` holds, then the best of each other family,
    then the rest by rank.  A row with ``n`` better ones in its family is never picked, so both windows keep their first ``n``
    rows alone, and Spark cuts to those in every task before it shuffles: a group of any size sends at most ``n`` rows per task and family, and no
    task gets more than that of it.  Give it the columns that decide and join the rest to the picks with ``join_picks``.
    """
    in_family = F.row_number().over(Window.partitionBy(*group, family).orderBy(*rank))
    ranked = df.withColumn("_in", in_family).where(F.col("_in") <= n)
    turn = F.when((F.col("_in") == 1) & (first if first is not None else F.lit(False)), 1).when(F.col("_in") == 1, 2).otherwise(3)
    ranked = ranked.withColumn("pass", turn)
    pick = F.row_number().over(Window.partitionBy(*group).orderBy("pass", *rank))
    return ranked.withColumn("pick_no", pick).where(F.col("pick_no") <= n).drop("_in")


def join_picks(picked: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``picked`` with the other columns of ``rows``, of which ``key`` tells one from another: their bodies travel only if they are picked."""
    held = stored(picked)
    rest = rows.select(*key, *[c for c in rows.columns if c not in held.columns])
    wanted = rest.join(bounded_broadcast(held.select(*key)), list(key), "left_semi")
    return held.join(wanted, list(key))


def survivors(scored: DataFrame, threshold: int = 70) -> DataFrame:
    """Snippets that no gate dropped and that score at least the threshold."""
    return scored.where(F.col("dropped_reason").isNull() & (F.col("match_score") >= threshold))


def build_context(picked: DataFrame, group: Sequence[str], order: str = "pick_no", source: str = "source", score: str = "match_score", body: str = "body") -> DataFrame:
    """Per group the picked blocks as an array in order, and the text they render to."""
    block = F.struct(F.col(order).alias("no"), F.col(source).alias("source"), F.col(score).cast("int").alias("score"), F.col(body).alias("body"))
    made = picked.groupBy(*group).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    shown = F.transform("blocks", lambda b: F.concat(F.lit("["), b.source, F.lit(" | match="), b.score.cast("string"), F.lit("]\n"), b.body))
    return made.withColumn("web_context", F.array_join(shown, "\n\n"))


def context_blocks(context: Column) -> Column:
    """Blocks of a rendered context: array of (source, body); text before the first has a null source."""
    parts = F.split(F.coalesce(context, F.lit("")), r"(?m)^(?=\[.+? \| match=\d+\]$)")
    parts = F.filter(parts, lambda p: F.trim(p) != "")
    head = r"^\[(.+?) \| match=\d+\]\n?"
    return F.transform(
        parts,
        lambda p: F.struct(
            F.when(F.rlike(p, F.lit(head)), F.regexp_extract(p, head, 1)).alias("source"), F.trim(F.regexp_replace(F.regexp_replace(p, head, ""), r"\s+$", "")).alias("body")
        ),
    )


def context_counts(blocks: Column) -> tuple[Column, Column]:
    """Number of blocks, and of distinct source families."""
    return F.size(blocks), F.size(F.array_distinct(F.transform(blocks, lambda b: source_family(F.coalesce(b.source, F.lit(""))))))


def scored_view(scored: DataFrame, group: Sequence[str], pos: str = "pos", score: str = "match_score") -> DataFrame:
    """Snippets by score descending, unscored last, input order among equals; ``view_no`` is the place."""
    order = [F.coalesce(F.col(score), F.lit(-1)).desc(), F.col(pos)]
    return scored.withColumn("view_no", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
