"""URL filters: host-suffix and path-prefix expressions matched by hash prefix, then by full digest.

Every URL is expanded into the expressions that some rule could equal: the host suffixes with as
many labels as rule hosts have, times the path prefixes as long as rule paths are.  Expressions
join the rules on the first 32 bits of their SHA-256, a hit counts only if the full digest agrees,
and of several rules that fit the longest decides; of equally long ones that with the longer host, whose path is then the shorter.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule.
An empty rule table gives every URL the default verdict.  Repeated rows are judged row by row.
Extra columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.common import BROADCAST_ROWS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the short hash on which expressions and rules are joined.
PREFIX_DIGITS = 8


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    raw = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def _shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Label counts of rule hosts and lengths of rule paths: a few numbers, bounded by a URL's length."""
    row = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    return row["labels"], row["lengths"]


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Array of the host-suffix and path-prefix expressions that rules of these shapes can equal."""
    parts = F.split(host, r"\.")
    made = [
        F.when(
            (host != "") & (F.size(parts) >= n) & (F.length(path) >= m),
            F.concat(F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."), F.substring(path, 1, m)),
        )
        for n in labels
        for m in lengths
    ]
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<string>")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Judge every row of ``pages`` by ``rules(verdict, host, path)``.

    Returns ``id_col, host, path, rule, verdict``.  Rules up to ``broadcast_rows`` are broadcast
    after a count; larger tables are joined by shuffle, from the distinct expressions, so that a
    host with a third of all URLs meets the rules once.
    """
    labels, lengths = _shapes(rules)
    known = rules.select(
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"), F.length("host").alias("host_len")
    ).dropDuplicates(["rule", "rule_verdict"])
    known = known.withColumn("digest", F.sha2("rule", 256)).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))

    host, path = url_host_path(F.col(url_col))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    tried = judged.withColumn("expr", F.explode_outer(expressions(F.col("host"), F.col("path"), labels, lengths)))
    tried = tried.withColumn("expr_digest", F.sha2("expr", 256)).withColumn(
        "short", F.substring("expr_digest", 1, PREFIX_DIGITS)
    )
    if known.limit(broadcast_rows + 1).count() <= broadcast_rows:
        met = tried.join(F.broadcast(known), "short", "left")
    else:
        hits = (
            tried.select("short", "expr_digest")
            .distinct()
            .join(known, "short")
            .where("expr_digest = digest")
            .drop("short", "expr_digest")
        )
        met = tried.drop("short").join(hits, tried["expr_digest"] == hits["digest"], "left")
    fits = F.when(
        F.col("digest") == F.col("expr_digest"),
        F.struct(F.length("rule").alias("n"), "host_len", F.col("rule_verdict").alias("verdict"), "rule"),
    )
    # The rows of one URL sit in one task, so the partial aggregate already reduces them to one.
    best = met.groupBy("row", id_col, "host", "path").agg(F.max(fits).alias("best"))
    return best.select(
        id_col,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
