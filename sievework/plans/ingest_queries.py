"""Queries of the ingest side: rules, counts, searches, sorts, numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.common import table
from sievework.operators import rules

#: A cascade for the parts table: types that stay, leading vendor words, whole names, keywords in groups.
PART_RULES = [
    ("category", "", "economy"), ("category", "", "small"), ("vendor", "", "cold"), ("vendor", "", "green"), ("name", "", "hot rod"),
    ("name", "", "blue bolt"), ("keyword", "metal", "rod"), ("keyword", "metal", "bolt"), ("keyword", "other", "gear"),
]


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    category = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type"))
    return part.select("p_partkey", F.col("p_name").alias("name"), category.alias("category"), "p_size", "p_retailprice")


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_cascade(parts(spark, sf_dir), PART_RULES, "category", "name", "name")


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _cascade_sql() -> str:
    of = lambda s: [(g, t) for st, g, t in PART_RULES if st == s]
    white = _quoted([t for _, t in of("category")])
    cases = [(f"cat <> '' AND cat IN ({white})", "TRUE", "category", "'category is whitelisted'", "cat", "NULL"),
             ("cat <> ''", "FALSE", "category", "'category not whitelisted: ' || cat", "cat", "NULL")]
    cases += [(f"nam = '{t}' OR starts_with(nam, '{t} ')", "FALSE", "vendor", f"'vendor is blacklisted: {t}'", f"'{t}'", "NULL") for _, t in of("vendor")]
    cases += [(f"nam = '{t}'", "FALSE", "name", f"'name is excluded: {t}'", f"'{t}'", "NULL") for _, t in of("name")]
    cases += [(rf"regexp_matches(nam, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')", "FALSE", "keyword", f"'name has keyword: {t} ({g})'", f"'{t}'", f"'{g}'") for g, t in of("keyword")]
    cases.append(("TRUE", "TRUE", "uncategorised", "'no rule applies'", "NULL", "NULL"))
    column = lambda i: "CASE " + " ".join(f"WHEN {c[0]} THEN {c[i] if i != 2 else repr(c[2])}" for c in cases) + " END"
    return f"""
WITH p AS (SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS category, p_size, p_retailprice FROM part),
f AS (SELECT *, lower(trim(category)) AS cat, lower(trim(name)) AS nam FROM p),
d AS (SELECT p_partkey, name, category, p_size, p_retailprice, {column(1)} AS keep, {column(2)} AS stage, {column(3)} AS reason,
  CAST({column(4)} AS VARCHAR) AS match, CAST({column(5)} AS VARCHAR) AS grp FROM f)
"""


CASCADE = _cascade_sql()


def rule_cascade(spark, sf_dir):
    return decided(spark, sf_dir).select("p_partkey", "decision.*")


def ingest_summary(spark, sf_dir):
    return rules.decision_summary(decided(spark, sf_dir), "p_partkey")


def ingest_waterfall(spark, sf_dir):
    return rules.waterfall(decided(spark, sf_dir))


def split_kept_excluded(spark, sf_dir):
    kept, out = rules.split_decided(decided(spark, sf_dir))
    none = F.lit(None).cast("string")
    a = kept.select("p_partkey", "ingest_pass", none.alias("excluded_by"), none.alias("excluded_reason"))
    return a.unionByName(out.select("p_partkey", none.alias("ingest_pass"), "excluded_by", "excluded_reason"))


def sorted_kept(spark, sf_dir):
    kept, _ = rules.split_decided(decided(spark, sf_dir))
    blank = kept.withColumn("category", F.nullif("category", F.lit("")))
    return rules.sort_nulls_last(blank, "category", False, ["name", "p_partkey"]).select("p_partkey", "name", "category").limit(50)


def excluded_search(spark, sf_dir):
    _, out = rules.split_decided(decided(spark, sf_dir))
    return rules.search(out, "ROD", ["name", "excluded_reason"], {"excluded_by": "keyword"}).select("p_partkey", "name", "excluded_reason")


def suggest_names(spark, sf_dir):
    return rules.suggest(table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct(), "name", "Ro")


def norm_numeric(spark, sf_dir):
    shown = table(spark, sf_dir, "customer").select("c_custkey", F.format_number("c_acctbal", 2).alias("balance"), F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("segment"))
    return rules.normalise(shown, ["balance", "c_custkey"]).select(F.col("c_custkey").cast("long").alias("c_custkey"), "balance", "segment")


def valid_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    h = F.md5(F.col("c_custkey").cast("string"))
    dashed = F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))
    turn = F.col("c_custkey") % 5
    made = F.when(turn == 0, h).when(turn == 1, dashed).when(turn == 2, F.concat(F.lit("{"), dashed, F.lit("}"))).when(turn == 3, F.concat(F.lit("urn:uuid:"), dashed)).otherwise(F.substring(h, 1, 31))
    good, bad = rules.split_valid_ids(c.select("c_custkey", made.alias("id")))
    return good.select("c_custkey", F.lit(True).alias("valid")).union(bad.select("c_custkey", F.lit(False)))


def top_customers(spark, sf_dir):
    return rules.top_n(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey", "c_acctbal", "rn")


QUERIES = {f.__name__: f for f in (rule_cascade, ingest_summary, ingest_waterfall, split_kept_excluded, sorted_kept, excluded_search, suggest_names, norm_numeric, valid_ids, top_customers)}

SQL = {
    "rule_cascade": CASCADE + "SELECT p_partkey, keep, stage, reason, match, grp FROM d",
    "ingest_summary": CASCADE + """
SELECT 'stage' AS level, keep, stage, NULL AS match, NULL AS grp, count(*) AS n, min(p_partkey) AS first_row FROM d GROUP BY keep, stage
UNION ALL SELECT 'match', keep, stage, match, NULL, count(*), min(p_partkey) FROM d WHERE match IS NOT NULL GROUP BY keep, stage, match
UNION ALL SELECT 'group', keep, stage, NULL, grp, count(*), min(p_partkey) FROM d WHERE grp IS NOT NULL GROUP BY keep, stage, grp""",
    "ingest_waterfall": CASCADE + """
, s(pos, stage) AS (VALUES (0, 'category'), (1, 'vendor'), (2, 'name'), (3, 'keyword'), (4, 'uncategorised')),
c AS (SELECT s.pos, s.stage, (SELECT count(*) FROM d WHERE d.stage = s.stage) AS n FROM s)
SELECT a.pos, a.stage, CAST((SELECT sum(n) FROM c b WHERE b.pos >= a.pos) AS BIGINT) AS entering, a.n AS ending,
  CAST((SELECT coalesce(sum(n), 0) FROM c b WHERE b.pos > a.pos) AS BIGINT) AS leaving FROM c a""",
    "split_kept_excluded": CASCADE + """SELECT p_partkey, CASE WHEN keep THEN stage END AS ingest_pass, CASE WHEN NOT keep THEN stage END AS excluded_by,
  CASE WHEN NOT keep THEN reason END AS excluded_reason FROM d""",
    "sorted_kept": CASCADE + "SELECT p_partkey, name, nullif(category, '') AS category FROM d WHERE keep ORDER BY nullif(category, '') DESC NULLS LAST, name, p_partkey LIMIT 50",
    "excluded_search": CASCADE + "SELECT p_partkey, name, reason AS excluded_reason FROM d WHERE stage = 'keyword' AND contains(lower(name || ' ' || reason), 'rod')",
    "suggest_names": "SELECT DISTINCT p_name AS name FROM part WHERE contains(lower(p_name), 'ro') ORDER BY name LIMIT 12",
    "norm_numeric": "SELECT c_custkey, round(c_acctbal, 2) AS balance, c_mktsegment AS segment FROM customer",
    "valid_ids": "SELECT c_custkey, c_custkey % 5 <> 4 AS valid FROM customer",
    "top_customers": "SELECT c_nationkey, c_custkey, c_acctbal, rn FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::INT AS rn FROM customer) WHERE rn <= 3",
}
