"""The registered queries of the operators, each over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.common import table
from sievework.llm import bpe, embed, fingerprint, langid, lm_score, mixing, quality, simhash, substring, toxicity, url_filter, vector_codes, whitening

#: The rules that the URL query judges by: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


OP1_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
SELECT page_id, host, path,
  (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM r
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
  coalesce((SELECT max_by(verdict, length(rhost || rpath)) FROM r
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM p
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ["doc_id"], ids=False, digests=True)


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


def op5_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_dedup(table(spark, sf_dir, "embeddings"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id"))
    good = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~langid.held_out("doc_id"))
    return lm_score.cross_entropy_difference(docs, good, ["doc_id", "held_out"])


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], digest=True)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are covered at radius R + t / 2, which finds the links that R + t finds (proven in ``simhash``, and tested) with a twentieth of the copies."""
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id"))
    dictionaries = langid.learn(docs.where("NOT held_out"))
    found = langid.identify(docs, dictionaries, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id"))
    labels = table(spark, sf_dir, "labels").where(~langid.held_out("doc_id"))
    found = toxicity.score(docs, toxicity.learn(docs, labels), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    first = F.round(F.element_at(F.when(F.size("positions") > 0, F.col("positions")), 1), 9)
    return planned.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).orderBy("position", "doc_id")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS k, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS o,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), per AS (
  SELECT k, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY substr(k, 1, 1), k) - 1) % 3 AS turn FROM sized GROUP BY k
), w AS (
  SELECT k, s, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CASE turn WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS a FROM per
), l AS (
  SELECT *, (sum(s) OVER () - coalesce(sum(3.0::DOUBLE * s) OVER (ORDER BY 3.0::DOUBLE * s / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3.0::DOUBLE * s / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w
), t AS (
  SELECT k, s, a, least(3.0::DOUBLE * s, max(lev) OVER () * weight) AS target FROM l
), placed AS (
  SELECT doc_id, size, s, a, target, coalesce(sum(size) OVER (PARTITION BY k ORDER BY o, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + size / 2.0::DOUBLE AS mid FROM sized JOIN t USING (k)
), c AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE (mid <= target)::INT + (mid + s <= target)::INT + (mid + 2 * s <= target)::INT END AS copies,
         mid / nullif(target, 0) AS u FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target, CAST(copies * size AS BIGINT) AS taken,
  CASE WHEN copies > 0 THEN round(CASE WHEN a = 0 THEN u ELSE (a - 1 + sqrt((1 - a) * (1 - a) + 4 * a * u)) / (2 * a) END, 9) END AS position
FROM c
"""


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    found = quality.score(docs, model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _round_sql(k: int) -> str:
    """Assigning of all parts to the codebooks ``b{k}``, and the codebooks after it."""
    return f"""a{k} AS MATERIALIZED (
  SELECT vec_id, part, min({{'dist': p.sq + b.sq - 2 * list_dot_product(p.xs, b.xs), 'entry': entry}}) AS best
  FROM p JOIN b{k} b USING (part) GROUP BY ALL
), m{k} AS MATERIALIZED (
  SELECT part, entry, list(CAST(floor(total / n) AS DOUBLE) ORDER BY pos) AS xs FROM (
    SELECT part, best.entry AS entry, pos, sum(xs[pos]) AS total, count(*) AS n
    FROM a{k} JOIN p USING (vec_id, part), range(1, len(xs) + 1) AS r(pos) GROUP BY ALL
  ) GROUP BY ALL
), b{k + 1} AS MATERIALIZED (
  SELECT part, entry, x.xs, list_dot_product(x.xs, x.xs) AS sq
  FROM (SELECT b.part, b.entry, coalesce(m.xs, b.xs) AS xs FROM b{k} b LEFT JOIN m{k} m USING (part, entry)) x
), """


#: Sums and squares are whole numbers that doubles hold exactly; lists are cut into parts by their length.
OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c AS (
  SELECT vec_id, part, x[part * len(x) // 4 + 1 : (part + 1) * len(x) // 4] AS xs FROM v, range(4) AS r(part)
), p AS MATERIALIZED (
  SELECT *, list_dot_product(xs, xs) AS sq FROM c
), b0 AS MATERIALIZED (
  SELECT part, entry, xs, sq FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256
), {"".join(_round_sql(k) for k in range(5))}s AS (
  SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.dist) AS BIGINT) AS error FROM a4 GROUP BY vec_id
), h AS (
  SELECT sha256(string_agg(CAST(CAST(xs[pos] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM b4, range(1, len(xs) + 1) AS r(pos)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM s JOIN v USING (vec_id), h
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_bpe": op2_bpe,
    "op3_fingerprint": op3_fingerprint,
    "op4_simhash": op4_simhash,
    "op5_embed": op5_embed,
    "op6_lm_score": op6_lm_score,
    "op7_substring": op7_substring,
    "op8_langid": op8_langid,
    "op9_toxicity": op9_toxicity,
    "op10_mix": op10_mix,
    "op11_quality": op11_quality,
    "op12_whitening": op12_whitening,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL = {"op1_url_filter": OP1_SQL, "op10_mix": OP10_SQL, "op13_vector_codes": OP13_SQL}
