"""Rule cascade with audit, its counts, and the searches and sorts over its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("category", "vendor", "name", "keyword", "uncategorised")


def normalise(df: DataFrame, numeric: Sequence[str] = (), numeric_prefixes: Sequence[str] = ()) -> DataFrame:
    """Numbers parsed (unparsable: null), other columns trimmed (null: empty)."""
    from sievework.functions.text import number

    is_number = lambda c: c in numeric or any(c.startswith(p) for p in numeric_prefixes)
    return df.select(*[(number(F.col(c).cast("string")) if is_number(c) else F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in df.columns])


def valid_id(col: Column) -> Column:
    """Whether a string is a UUID: with or without hyphens, in braces, or with a ``urn:uuid:`` before it."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(col, F.lit("")), "urn:|uuid:", ""), r"^[{}]+|[{}]+$", "")
    return F.rlike(F.regexp_replace(bare, "-", ""), F.lit("^[0-9a-fA-F]{32}$"))


def split_valid_ids(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows with a valid id, and the others."""
    return df.where(valid_id(F.col(id_col))), df.where(~valid_id(F.col(id_col)))


def keyword_pattern(term: str) -> str:
    """Pattern that finds a folded term as whole words, with any white space between them."""
    quoted = [r"\s+".join("".join(c if c.isalnum() else f"\\{c}" for c in w) for w in term.split())]
    return rf"(?<![a-z0-9]){quoted[0]}(?![a-z0-9])"


def rule_cascade(df: DataFrame, rules: Sequence[tuple[str, str, str]], category: str, vendor: str, name: str, fold=F.lower) -> DataFrame:
    """``df`` with ``decision STRUCT<keep, stage, reason, match, grp>``.

    ``rules`` are (stage, group, term) in order of precedence; stages are ``category`` (kept),
    ``vendor``, ``name`` and ``keyword`` (excluded).  A category, if there is one, ends the cascade.
    Terms are folded already.  The rule list is compiled into one expression: no join and no shuffle.
    """
    cat, ven, nam = (fold(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in (category, vendor, name))

    def of(stage: str) -> list[tuple[str, str]]:
        return [(g, t) for s, g, t in rules if s == stage]

    def decision(keep: bool, stage: str, reason: Column, match: Column, group: Column) -> Column:
        return F.struct(F.lit(keep).alias("keep"), F.lit(stage).alias("stage"), reason.alias("reason"), match.alias("match"), group.alias("grp"))

    none = F.lit(None).cast("string")
    white = [t for _, t in of("category")]
    out = F.when((cat != "") & cat.isin(white), decision(True, "category", F.lit("category is whitelisted"), cat, none))
    out = out.when(cat != "", decision(False, "category", F.concat(F.lit("category not whitelisted: "), cat), cat, none))
    for _, term in of("vendor"):
        hit = (ven == term) | F.startswith(ven, F.lit(f"{term} "))
        out = out.when(hit, decision(False, "vendor", F.lit(f"vendor is blacklisted: {term}"), F.lit(term), none))
    for _, term in of("name"):
        out = out.when(nam == term, decision(False, "name", F.lit(f"name is excluded: {term}"), F.lit(term), none))
    for group, term in of("keyword"):
        hit = F.rlike(nam, F.lit(keyword_pattern(term)))
        out = out.when(hit, decision(False, "keyword", F.lit(f"name has keyword: {term} ({group})"), F.lit(term), F.lit(group)))
    out = out.otherwise(decision(True, "uncategorised", F.lit("no rule applies"), none, none))
    return df.withColumn("decision", out)


def split_decided(decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows with ``ingest_pass``; excluded rows with ``excluded_by`` and ``excluded_reason``."""
    kept = decided.where("decision.keep").withColumn("ingest_pass", F.col("decision.stage")).drop("decision")
    out = decided.where("NOT decision.keep")
    return kept, out.withColumns({"excluded_by": F.col("decision.stage"), "excluded_reason": F.col("decision.reason")}).drop("decision")


def decision_summary(decided: DataFrame, order: str) -> DataFrame:
    """Counts by stage, by stage and match, and by stage and group in one pass, with the first row of each.

    ``level`` says which; sort by count descending, then first row, for the reference order.
    """
    flat = decided.select(F.col(order).alias("_o"), "decision.*")
    grouped = flat.groupingSets([["keep", "stage"], ["keep", "stage", "match"], ["keep", "stage", "grp"]], "keep", "stage", "match", "grp")
    counts = grouped.agg(F.grouping_id().alias("_g"), F.count("*").alias("n"), F.min("_o").alias("first_row"))
    level = F.when(F.col("_g") == 3, "stage").when(F.col("_g") == 1, "match").otherwise("group")
    return counts.select(level.alias("level"), "keep", "stage", "match", "grp", "n", "first_row").where(
        "level = 'stage' OR (level = 'match' AND match IS NOT NULL) OR (level = 'group' AND grp IS NOT NULL)"
    )


def waterfall(decided: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Rows that enter, end at and leave each stage."""
    spark = decided.sparkSession
    at = spark.createDataFrame([(i, s) for i, s in enumerate(stages)], "pos int, stage string")
    n = decided.groupBy(F.col("decision.stage").alias("stage")).agg(F.count("*").alias("n"))
    all_after = Window.orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    joined = at.join(F.broadcast(n), "stage", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.select("pos", "stage", F.sum("n").over(all_after).alias("entering"), F.col("n").alias("ending"), (F.sum("n").over(all_after) - F.col("n")).alias("leaving"))


def search(df: DataFrame, text: str, cols: Sequence[str], equals: dict[str, str] | None = None) -> DataFrame:
    """Rows that hold ``text`` in any of ``cols`` (arrays too), in any case, and equal ``equals``."""
    kinds = dict(df.dtypes)
    hay = F.concat_ws(" ", *[F.array_join(c, " ") if kinds[c].startswith("array") else F.col(c).cast("string") for c in cols])
    out = df.where(F.contains(F.lower(hay), F.lit(text.strip().lower())))
    for c, v in (equals or {}).items():
        out = out.where(F.col(c) == v)
    return out


def event_filter(events: DataFrame, hidden: Sequence[str] = ("wine_start",)) -> DataFrame:
    """Events but those of the hidden types; an event without a type stays."""
    return events.where(~F.coalesce(F.col("type").isin(list(hidden)), F.lit(False)))


def sort_nulls_last(df: DataFrame, col: str, ascending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """Sorted by a column, nulls last in both directions."""
    return df.orderBy(F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last(), *tie)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, with their number ``rn``."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= n)


def suggest(options: DataFrame, col: str, draft: str, n: int = 12) -> DataFrame:
    """The first options that contain the draft, in any case."""
    return options.where(F.contains(F.lower(col), F.lit(draft.lower()))).orderBy(col).limit(n)
