"""Queries of the taxonomy, evidence and reference-data side."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import spread, table
from sievework.operators import evidence, linking, refdata, taxonomy


def _edges(spark, sf_dir):
    """Region, nation and customer as one tree with ids of their own kind."""
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent_id"), F.col("c_name").alias("name"))
    return r.union(n).union(c)


def taxonomy_closure(spark, sf_dir):
    return taxonomy.closure(_edges(spark, sf_dir))


def path_to_root(spark, sf_dir):
    return taxonomy.path_to_root(taxonomy.closure(_edges(spark, sf_dir))).select("id", F.array_join("parents", ">").alias("parents"))


def tree_listing(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return refdata.tree_listing(edges, taxonomy.closure(edges)).select("id", F.col("depth").cast("long").alias("depth"), "path", "below")


def sub_regions(spark, sf_dir):
    edges = _edges(spark, sf_dir).withColumn("is_canonical", F.rlike("name", F.lit("[02468]$")))
    return taxonomy.children(edges, "r1").select("id", "name")


def _nation_dims(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("string").alias("scope"))
    label = F.when(F.col("n_nationkey") % 5 == 0, F.lit("shared name")).otherwise(F.lower("n_name"))
    return nation.select(label.alias("label_fold"), F.col("n_nationkey").alias("entity"), F.col("n_name").alias("name"), "scope", (F.col("n_nationkey") % 7 != 3).alias("is_canonical"), F.lit(0).alias("rank"))


def resolve_labels(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    noisy = F.concat(F.lit("  "), F.initcap("n_name"), F.when(F.col("n_nationkey") % 2 == 0, " AVA").otherwise(" (x)"), F.lit(" "))
    asked = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", noisy.alias("label"))
    folded = asked.withColumn("label", taxonomy.strip_classification(F.lower(F.trim("label"))))
    out = taxonomy.resolve_labels(folded, "label", _nation_dims(spark, sf_dir))
    return out.select("s_suppkey", "label", "entity", "canonical", "known")


def pick_homonym(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select("c_custkey", F.lit("shared name").alias("label"), (F.col("c_custkey") % 5).cast("string").alias("want"))
    out = taxonomy.resolve_labels(asked, "label", _nation_dims(spark, sf_dir), "want")
    return out.select("c_custkey", "entity", "canonical", F.array_join("alternatives", "|").alias("alternatives"))


def region_variants(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" / ", "p_name", F.concat(F.lower("p_type"), F.lit(" aoc"))).alias("label"))
    return spread(part).select("p_partkey", F.array_join(taxonomy.region_variants(F.col("label")), "|").alias("variants"))


def resolve_category(spark, sf_dir):
    aliases = {"economy": "low", "small": "low", "promo": "mid", "medium": "mid", "large": "high"}
    return table(spark, sf_dir, "part").select("p_partkey", taxonomy.resolve_category(F.lower("p_type"), aliases).alias("category"))


def canonical_batch(spark, sf_dir):
    """Customers propose their nation and a guessed region; regions are the places, nations their countries."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    # Countries are the regions of the star schema, places are nations, and customers' segments serve as grapes.
    countries = region.select(F.lower("r_name").alias("label_fold"), F.col("r_regionkey").cast("string").alias("entity"), F.col("r_name").alias("name"), F.lit("").alias("scope"), F.lit(True).alias("is_canonical"), F.lit(0).alias("rank"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("label_fold"), F.col("n_nationkey").cast("string").alias("entity"), F.col("n_name").alias("name"), F.col("r_name").alias("scope"), (F.col("n_nationkey") % 7 != 3).alias("is_canonical"), F.lit(0).alias("rank"))
    seg = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    grapes = seg.select(F.lower("c_mktsegment").alias("label_fold"), F.col("c_mktsegment").alias("entity"), F.col("c_mktsegment").alias("name"), F.lit("").alias("scope"), (F.col("c_mktsegment") != "MACHINERY").alias("is_canonical"), F.lit(0).alias("rank"))
    tree = taxonomy.closure(nation.select(F.col("n_nationkey").cast("string").alias("id"), F.lit(None).cast("string").alias("parent_id")).union(
        nation.where("n_nationkey >= 20").select(F.col("n_nationkey").cast("string"), (F.col("n_nationkey") - 20).cast("string"))))
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    guessed = customer.join(region.select(F.col("r_regionkey").cast("long").alias("_g"), F.lower("r_name").alias("g_name")), F.col("c_custkey") % 5 == F.col("_g"))
    place = F.when(F.col("c_custkey") % 13 == 0, "nowhere").otherwise(F.lower("n_name"))
    proposals = guessed.select(
        "c_custkey", F.when(F.col("c_custkey") % 11 == 0, "atlantis").when(F.col("c_custkey") % 3 > 0, F.col("g_name")).alias("country"), F.array(place).alias("region"),
        F.array(F.lower("c_mktsegment")).alias("grapes"), F.lit(None).cast("boolean").alias("is_blend"), F.lit(False).alias("organic"), F.lit(90).alias("confidence"), F.lit("red").alias("category"),
    )
    out = taxonomy.canonicalise(proposals, "c_custkey", countries, places, grapes, tree, {"red": "red"}, ["blend"])
    return out.select("c_custkey", "ok", F.array_join("issues", ",").alias("issues"), F.col("normalized.country").alias("country"), F.array_join("normalized.region", ";").alias("region"), F.array_join("normalized.grapes", ";").alias("grapes"))


def languages(docs):
    """The languages that documents have, as one array: a few short codes."""
    return F.array(*[F.lit(r["lang"]) for r in docs.select("lang").where("lang IS NOT NULL").distinct().collect()]).cast("array<string>")


def corroboration_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    claims = table(spark, sf_dir, "benchmark").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{6,})"), 1))).alias("claim")).distinct()
    groups = claims.withColumn("lang", F.explode(languages(docs)))
    aliases = claims.select("claim", F.concat("claim", F.lit("s")).alias("alias"))
    blocks = docs.select("lang", F.col("source").alias("family"), F.lower("text").alias("body"))
    return evidence.corroboration(groups, blocks, aliases, "lang")


def evidence_status(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", (F.col("n_chars") % 100).alias("confidence"))
    no = F.lit(False)
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", (F.col("doc_id") % 17 != 0).alias("has_context"), (F.col("doc_id") % 13 != 0).alias("submitted"), (F.col("doc_id") % 4).alias("n_sources"), "confidence",
        F.when(F.col("doc_id") % 5 > 0, F.array(F.struct(F.col("lang").alias("name"), (F.col("doc_id") % 3).alias("n")))).otherwise(F.array().cast("array<struct<name:string,n:bigint>>")).alias("grapes"),
        no.alias("named_whole"), (F.col("doc_id") % 7 == 0).alias("called_blend"), (F.col("doc_id") % 19 == 0).alias("incomplete_blend"), F.coalesce(F.col("toxic") == 1, no).alias("white_only"),
        no.alias("name_upgrade"), (F.col("doc_id") % 23 == 0).alias("name_conflict"), no.alias("source_upgrade"), (F.col("doc_id") % 29 == 0).alias("coarse"), no.alias("longer"),
        F.when(F.col("doc_id") % 31 == 0, F.array("source")).otherwise(F.array().cast("array<string>")).alias("unsupported"),
    )
    return evidence.evidence_rules(rows, 50).select("doc_id", F.array_join("reasons", ",").alias("reasons"), "confidence", "status")


def finer_regions(spark, sf_dir):
    """Customers claim their region; orders of a nation are the sources that name it."""
    tree = taxonomy.closure(_edges(spark, sf_dir).where("id NOT LIKE 'c%'"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("n"), "c_nationkey").alias("nation"))
    regions = tree.where("distance = 1").select(F.col("descendant").alias("nation"), F.col("ancestor").alias("region"))
    claims = cust.join(regions, "nation").select("c_custkey", "region")
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_distinct("o_orderpriority").alias("n_sources"))
    counts = cust.join(orders, "c_custkey").select("c_custkey", F.col("nation").alias("region"), "n_sources")
    leaves = evidence.submitted_leaves(claims, "c_custkey", "region", tree)
    finer = evidence.finer_regions(leaves, "c_custkey", "region", tree, counts)
    return finer.join(evidence.region_from_sources(finer, "c_custkey", tree), "c_custkey", "left").select("c_custkey", "region", "finer", "n", "replacement")


def _faulty(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 6 == 0, 99).otherwise(F.col("n_regionkey")).alias("n_regionkey"))
    return n.union(n.where("n_nationkey % 4 = 0"))


def unique_checks(spark, sf_dir):
    return refdata.check_unique(_faulty(spark, sf_dir), ["n_name"], "nation_name").union(refdata.check_unique(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "segment"))


def fk_checks(spark, sf_dir):
    return refdata.check_references(_faulty(spark, sf_dir), "n_name", ["n_regionkey"], table(spark, sf_dir, "region"), ["r_regionkey"], "nation_region")


def label_collisions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return refdata.check_label_collisions(part.select(F.col("p_brand").alias("scope"), F.upper("p_name").alias("label"), F.col("p_partkey").alias("owner")))


def cycle_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    edges = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 == 0, F.when(F.col("c_custkey") % 20 == 0, F.col("c_custkey") + 10).otherwise(F.col("c_custkey") - 10)).otherwise(F.col("c_custkey") - 1).alias("parent_id"))
    return refdata.check_cycles(edges.where("id % 100 < 40 OR id % 10 > 0").where("parent_id > 0")).select("rule", "key")


def synonym_arbitration(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.lower("p_name").alias("fold"), (F.col("p_size") % 3).alias("tier"))
    return refdata.arbitrate(part, ["p_brand"], "fold", ["tier", "p_partkey"])


def admit_placeholders(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.concat_ws(" ", "p_size", "p_name")).alias("label"))
    known, new = part.where("p_partkey % 3 = 0"), part.where("p_partkey % 3 > 0")
    return refdata.admit(new, known.select("p_partkey"), known.where("p_partkey % 2 = 0").select("label").distinct(), "p_partkey", "label", ["rod", "gear"]).select("p_partkey", "label")


def _linked(entries, cands):
    of = lambda df, *ids: df.select(*ids, F.split("p_name", " ")[1].alias("word"), "p_name", "p_brand")
    rows = of(entries, F.col("p_partkey").alias("entry")).withColumn("suffix", F.when(F.col("word") == "rod", 3).otherwise(0))
    found = refdata.link_on_shared(rows, of(cands, F.col("p_partkey").alias("candidate"), F.col("p_size").alias("ord")), "word", {"p_name": 20, "p_brand": 15}, "suffix")
    return found.select("entry", "candidate", "score", "note")


def entity_link(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return _linked(part.where("p_partkey % 20 = 0"), part.where("p_partkey % 20 = 1"))


def entity_link_all(spark, sf_dir):
    """Every part with the best other part."""
    part = table(spark, sf_dir, "part")
    return _linked(part, part)


def slice_merge(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_nationkey", "s_name", "s_acctbal", F.concat(F.lit("Q"), "s_suppkey").alias("qid"), "s_suppkey")
    base = s.where("s_suppkey % 5 > 0").drop("s_suppkey")
    new = s.where("s_suppkey % 3 = 0").select("s_nationkey", F.when(F.col("s_suppkey") % 2 == 0, F.concat("s_name", F.lit(" new"))).otherwise(F.col("s_name")).alias("s_name"),
                                              F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("was"), (F.col("s_acctbal") + 1).alias("s_acctbal"), F.lit(None).cast("string").alias("qid"))
    return refdata.merge_slice(base, new, ["s_nationkey", "s_name"], "s_name", "was", ["s_acctbal", "qid"], ["qid"]).select("s_nationkey", "s_name", F.round("s_acctbal", 2).alias("s_acctbal"), "qid", "change")


def snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 11 > 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return refdata.snapshot_diff(o.where("o_orderkey % 13 > 0"), new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


def build_stats(spark, sf_dir):
    flagged = lambda t, k: table(spark, sf_dir, t).withColumn("is_canonical", F.col(k) % 2 == 0)
    return refdata.build_stats({"region": flagged("region", "r_regionkey"), "nation": flagged("nation", "n_nationkey"), "part": flagged("part", "p_partkey")})


def tree_intervals(spark, sf_dir):
    """Customers in chains of 1,000, with their suppliers' and parts' keys as leaves of the chains' middle: interval labels of every node."""
    c = F.col("c_custkey")
    chain = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), c).alias("id"), F.when(c % 1000 > 0, F.concat(F.lit("c"), c - 1)).alias("parent_id"))
    leaves = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.lit("c77").alias("parent_id"))
    rows = taxonomy.tree_intervals(chain.union(leaves))
    return rows.select("id", "root", "depth", (taxonomy.subtree_size(F.col("pre"), F.col("post")) - 1).alias("n_below"))


def below_tops(spark, sf_dir):
    """Everything below the customers of low balance, in chains of 1,000."""
    c = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer")
    labels = taxonomy.tree_intervals(rows.select(c.alias("id"), F.when(c % 1000 > 0, c - 1).alias("parent_id")))
    return taxonomy.below_any(labels, rows.where("c_acctbal < -700").select(c.alias("top")))


def _label_rows(spark, sf_dir):
    """Parts as entries by their names, and as candidates by labels made of them."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    name, turned = F.lower("p_name"), F.concat_ws(" ", F.element_at(F.split(F.lower("p_name"), " "), 2), F.element_at(F.split(F.lower("p_name"), " "), 1))
    label = F.when(k % 7 == 0, name).when(k % 7 == 1, F.concat(name, F.lit(" doc"))).when(k % 7 == 2, F.concat(F.lit("old "), name)).when(k % 7 == 3, turned).when(k % 7 == 4, F.concat(name, F.lit(" wine region"))).otherwise(F.lower("p_brand"))
    desc = F.when(k % 5 == 0, "a wine grape mutation").when(k % 5 == 1, "grape variety").when(k % 5 == 2, "wine area").otherwise("a ship")
    kinds = F.when(k % 3 == 0, F.array(F.lit("comune"))).when(k % 3 == 1, F.array(F.lit("Vitis")))
    none = F.lit(None).cast("array<string>")
    entries = p.select(k.alias("entry"), name.alias("name"), F.when(k % 2 == 0, F.array(turned)).alias("synonyms"), F.when(k % 4 == 0, "DOC").alias("classification"))
    return entries, p.select(F.concat(F.lit("q"), k).alias("candidate"), label.alias("label"), desc.alias("description"), F.when(F.col("p_size") > 45, F.array(F.lit("W"), F.lit("S"))).alias("classes"), none.alias("supers"), kinds.alias("class_labels"), F.col("p_size").alias("ord"))


def link_grapes(spark, sf_dir):
    return linking.link_grapes(*_label_rows(spark, sf_dir), ["G"], ["S"]).select("entry", "candidate", F.col("score").cast("int").alias("score"), "note")


def link_regions(spark, sf_dir):
    return linking.link_regions(*_label_rows(spark, sf_dir), ["W"], [" doc", " wine region"], ["comune"]).select("entry", "candidate", F.col("score").cast("int").alias("score"), "note")


QUERIES = {f.__name__: f for f in (
    tree_intervals, below_tops, link_grapes, link_regions, taxonomy_closure, path_to_root, tree_listing, sub_regions, resolve_labels, pick_homonym, region_variants, resolve_category, canonical_batch, corroboration_counts, evidence_status,
    finer_regions, unique_checks, fk_checks, label_collisions, cycle_check, synonym_arbitration, admit_placeholders, entity_link, entity_link_all, slice_merge, snapshot_diff, build_stats,
)}

EDGES = """WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS id, NULL AS parent_id, r_name AS name FROM region
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
t AS (SELECT id AS ancestor, id AS descendant, 0 AS distance FROM e UNION ALL SELECT t.ancestor, e.id, t.distance + 1 FROM t JOIN e ON e.parent_id = t.descendant)
"""
DIMS = """d AS (SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'shared name' ELSE lower(n_name) END AS label_fold, n_nationkey AS entity, n_name AS name, n_regionkey::VARCHAR AS scope, n_nationkey % 7 <> 3 AS is_canonical FROM nation)"""
FAULTY = "f AS (SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 6 = 0 THEN 99 ELSE n_regionkey END AS n_regionkey FROM nation UNION ALL SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 6 = 0 THEN 99 ELSE n_regionkey END FROM nation WHERE n_nationkey % 4 = 0)"

LABEL_ROWS = """WITH p AS (SELECT p_partkey AS k, p_size AS ord, lower(p_name) AS name, split_part(lower(p_name), ' ', 2) || ' ' || split_part(lower(p_name), ' ', 1) AS turned, lower(p_brand) AS brand FROM part),
c AS (SELECT *, 'q' || k AS candidate, CASE k % 7 WHEN 0 THEN name WHEN 1 THEN name || ' doc' WHEN 2 THEN 'old ' || name WHEN 3 THEN turned WHEN 4 THEN name || ' wine region' ELSE brand END AS label FROM p),
"""

SQL = {
    "tree_intervals": """WITH m AS (SELECT max(c_custkey) AS mx, (SELECT count(*) FROM part) AS np FROM customer)
SELECT 'c' || c_custkey AS id, 'c' || (c_custkey - c_custkey % 1000) AS root, c_custkey % 1000 AS depth, least(999 - c_custkey % 1000, mx - c_custkey) + CASE WHEN c_custkey <= 77 THEN np ELSE 0 END AS n_below FROM customer, m
UNION ALL SELECT 'p' || p_partkey, 'c0', 78, 0 FROM part""",
    "below_tops": "SELECT a.c_custkey AS top, b.c_custkey AS id, b.c_custkey - a.c_custkey AS distance FROM customer a JOIN customer b ON a.c_custkey // 1000 = b.c_custkey // 1000 AND a.c_custkey < b.c_custkey WHERE a.c_acctbal < -700",
    "link_grapes": LABEL_ROWS + """s AS (SELECT candidate, label, ord, 10 - 5 * (ord > 45 OR k % 5 = 0)::INT AS own FROM c WHERE k % 3 = 1 OR k % 5 < 2),
w AS (SELECT DISTINCT name, turned, k % 2 = 0 AS syn FROM p),
j AS (SELECT w.name, syn, candidate, ord, own + CASE WHEN label = name THEN 20 WHEN syn AND label = turned THEN 15 WHEN starts_with(label, name || ' ') OR ends_with(label, ' ' || name) THEN 3 END AS score FROM w, s),
b AS (SELECT name, syn, arg_min(candidate, (-score, ord, candidate)) AS candidate, max(score)::INT AS score FROM j WHERE score IS NOT NULL GROUP BY 1, 2)
SELECT k AS entry, candidate, score, CASE WHEN candidate IS NULL THEN 'none' WHEN score >= 25 THEN 'ok' ELSE 'inexact label' END AS note FROM p LEFT JOIN b ON b.name = p.name AND syn = (k % 2 = 0)""",
    "link_regions": LABEL_ROWS + """s AS (SELECT candidate, label, ord, ord > 45 OR k % 5 IN (0, 2) AS wine, CASE WHEN ord > 45 OR k % 5 IN (0, 2) THEN 30 ELSE 15 END + 5 * (k % 5 IN (0, 2))::INT AS own FROM c WHERE ord > 45 OR k % 5 IN (0, 2) OR k % 3 = 0),
w AS (SELECT DISTINCT name, k % 4 = 0 AS doc FROM p),
j AS (SELECT w.name, doc, candidate, ord, own + CASE WHEN label = name THEN 0 WHEN label IN (name || ' doc', name || ' wine region') THEN 3 END AS score FROM w, s WHERE wine OR NOT doc),
b AS (SELECT name, doc, arg_min(candidate, (-score, ord, candidate)) AS candidate, max(score)::INT AS score FROM j WHERE score IS NOT NULL GROUP BY 1, 2)
SELECT k AS entry, candidate, score, CASE WHEN candidate IS NULL THEN 'none' WHEN score >= 30 THEN 'ok' ELSE 'no wine class' END AS note FROM p LEFT JOIN b ON b.name = p.name AND doc = (k % 4 = 0)""",
    "taxonomy_closure": EDGES + "SELECT * FROM t",
    "path_to_root": EDGES + "SELECT descendant AS id, coalesce(string_agg(ancestor, '>' ORDER BY distance) FILTER (distance > 0), '') AS parents FROM t GROUP BY 1",
    "tree_listing": EDGES + ", b AS (SELECT ancestor AS id, count(*) - 1 AS below FROM t GROUP BY 1) SELECT descendant AS id, max(distance)::BIGINT AS depth, string_agg(e.name, ' / ' ORDER BY distance DESC) AS path, any_value(below) AS below FROM t JOIN e ON e.id = t.ancestor JOIN b ON b.id = t.descendant GROUP BY 1",
    "sub_regions": "SELECT 'n' || n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 1 AND regexp_matches(n_name, '[02468]$')",
    "resolve_labels": "WITH " + DIMS + """, a AS (SELECT s_suppkey, lower(n_name) AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, label, entity, name AS canonical, entity IS NOT NULL AS known FROM a LEFT JOIN d ON label = label_fold""",
    "pick_homonym": "WITH " + DIMS + """, w AS (SELECT * FROM d WHERE label_fold = 'shared name'), k AS (SELECT c_custkey, (c_custkey % 5)::VARCHAR AS want FROM customer),
n AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY (scope = want) DESC, is_canonical DESC, entity) AS rn FROM k, w),
b AS (SELECT c_custkey, entity, name, scope FROM n WHERE rn = 1)
SELECT b.c_custkey, b.entity, b.name AS canonical, coalesce((SELECT string_agg(DISTINCT w.name || ', ' || w.scope, '|' ORDER BY w.name || ', ' || w.scope) FROM w WHERE w.scope <> b.scope AND w.is_canonical), '') AS alternatives FROM b""",
    "region_variants": r"""SELECT p_partkey, p_name || ' / ' || lower(p_type) || ' aoc|' || p_name || ' / ' || lower(p_type) || '|' || p_name || '|' || lower(p_type) || ' aoc|' || lower(p_type) AS variants FROM part""",
    "resolve_category": "SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN 'low' WHEN 'small' THEN 'low' WHEN 'promo' THEN 'mid' WHEN 'medium' THEN 'mid' WHEN 'large' THEN 'high' END AS category FROM part",
    "canonical_batch": """WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 > 0 THEN g.r_name END AS country, c_custkey % 11 = 0 AS unknown_c, c_custkey % 13 = 0 AS unknown_r,
  n_nationkey, n_name, r.r_name AS own, n_nationkey % 7 <> 3 AS canon, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey JOIN region g ON g.r_regionkey = c_custkey % 5),
c AS (SELECT *, NOT unknown_r AS has_r FROM p)
SELECT c_custkey, concat_ws(',', CASE WHEN unknown_c THEN 'unknown_country' END, CASE WHEN unknown_r THEN 'unknown_region' END, CASE WHEN has_r AND NOT canon THEN 'non_canonical_region' END,
  CASE WHEN has_r AND country IS NOT NULL AND country <> own THEN 'region_country_mismatch' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'placeholder_grape' END) AS issues,
  NOT (unknown_c OR unknown_r OR (has_r AND NOT canon) OR (has_r AND country IS NOT NULL AND country <> own) OR c_mktsegment = 'MACHINERY') AS ok,
  coalesce(country, CASE WHEN has_r THEN own END) AS country,
  CASE WHEN has_r AND canon THEN n_name || CASE WHEN n_nationkey >= 20 THEN ';' || (SELECT n2.n_name FROM nation n2 WHERE n2.n_nationkey = c.n_nationkey - 20) ELSE '' END ELSE '' END AS region,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS grapes FROM c""",
    "corroboration_counts": r"""WITH cl AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS claim FROM benchmark), g AS (SELECT lang, claim FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL), cl),
b AS (SELECT DISTINCT lang, source, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents), a AS (SELECT claim, claim AS word FROM cl UNION SELECT claim, claim || 's' FROM cl),
h AS (SELECT lang, claim, count(DISTINCT source) AS n FROM b JOIN a USING (word) GROUP BY 1, 2)
SELECT lang, claim, coalesce(n, 0) AS n_sources FROM g LEFT JOIN h USING (lang, claim)""",
    "evidence_status": """WITH r AS (SELECT doc_id, lang, source, n_chars % 100 AS c, doc_id % 17 <> 0 AS ctx, doc_id % 13 <> 0 AS sub, doc_id % 4 = 1 AS single, doc_id % 5 > 0 AS g, doc_id % 3 AS n, doc_id % 7 = 0 AS blend, coalesce(toxic = 1, FALSE) AS white FROM documents LEFT JOIN labels USING (doc_id)),
x AS (SELECT *, CASE WHEN NOT ctx THEN 'no_context' WHEN NOT sub THEN 'no_submit' ELSE concat_ws(',', CASE WHEN single THEN 'single_source' END, CASE WHEN g AND n = 0 THEN 'unsupported_grape:' || lang END,
  CASE WHEN g AND n = 1 AND NOT single AND blend THEN 'uncorroborated_grape:' || lang END, CASE WHEN doc_id % 19 = 0 THEN 'incomplete_blend' END, CASE WHEN white THEN 'white_grapes_only' END,
  CASE WHEN doc_id % 23 = 0 THEN 'name_region_conflict' END, CASE WHEN doc_id % 29 = 0 THEN 'coarse_region' END, CASE WHEN doc_id % 31 = 0 THEN 'unsupported_region:' || source END,
  CASE WHEN NOT g THEN 'no_grapes' END, CASE WHEN c < 50 THEN 'low_confidence' END) END AS reasons, CASE WHEN single THEN least(c, 69) ELSE c END AS confidence FROM r)
SELECT doc_id, reasons, confidence, CASE WHEN sub AND ctx AND g AND reasons = '' AND confidence >= 50 THEN 'model' ELSE 'needs_review' END AS status FROM x""",
    "finer_regions": """SELECT c_custkey, 'r' || n_regionkey AS region, 'n' || n_nationkey AS finer, count(DISTINCT o_orderpriority) AS n, CASE WHEN count(DISTINCT o_orderpriority) >= 2 THEN 'n' || n_nationkey END AS replacement
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, n_regionkey, n_nationkey""",
    "unique_checks": "WITH " + FAULTY + """ SELECT 'nation_name' AS rule, 'error' AS severity, n_name AS key, 'appears ' || count(*) || ' times' AS message FROM f GROUP BY n_name HAVING count(*) > 1
UNION ALL SELECT 'segment', 'error', c_nationkey || '|' || c_mktsegment, 'appears ' || count(*) || ' times' FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1""",
    "fk_checks": "WITH " + FAULTY + " SELECT 'nation_region' AS rule, 'error' AS severity, n_name AS key, 'unknown ' || n_regionkey AS message FROM f WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)",
    "label_collisions": "SELECT 'label_collision' AS rule, 'error' AS severity, p_brand || '|' || lower(p_name) AS key, 'claimed by ' || min(p_partkey) || ' and ' || max(p_partkey) AS message FROM part GROUP BY p_brand, lower(p_name) HAVING count(DISTINCT p_partkey) > 1",
    "cycle_check": """WITH RECURSIVE e AS (SELECT id, parent_id FROM (SELECT c_custkey AS id, CASE WHEN c_custkey % 20 = 0 THEN c_custkey + 10 WHEN c_custkey % 10 = 0 THEN c_custkey - 10 ELSE c_custkey - 1 END AS parent_id FROM customer) WHERE (id % 100 < 40 OR id % 10 > 0) AND parent_id > 0),
w AS (SELECT id AS start, parent_id AS cur, 1 AS d FROM e UNION ALL SELECT w.start, e.parent_id, d + 1 FROM w JOIN e ON e.id = w.cur WHERE d < 40)
SELECT DISTINCT 'cycle' AS rule, start::VARCHAR AS key FROM w WHERE cur = start""",
    "synonym_arbitration": "SELECT p_partkey, p_brand, fold, tier FROM (SELECT p_partkey, p_brand, lower(p_name) AS fold, p_size % 3 AS tier, row_number() OVER (PARTITION BY p_brand, lower(p_name) ORDER BY p_size % 3, p_partkey) AS rn FROM part) WHERE rn = 1",
    "admit_placeholders": r"""WITH k AS (SELECT DISTINCT p_size || ' ' || lower(p_name) AS l FROM part WHERE p_partkey % 6 = 0)
SELECT p_partkey, p_size || ' ' || lower(p_name) AS label FROM part WHERE p_partkey % 3 > 0 AND p_size || ' ' || lower(p_name) NOT IN (SELECT l FROM k) AND regexp_replace(p_size || ' ' || lower(p_name), '\s+(rod|gear)$', '') NOT IN (SELECT l FROM k)""",
    "entity_link": """WITH m AS (SELECT a.p_partkey AS entry, b.p_partkey AS candidate, b.p_size AS ord, CASE WHEN a.p_name = b.p_name THEN 20 ELSE 0 END + CASE WHEN a.p_brand = b.p_brand THEN 15 ELSE 0 END + CASE WHEN split_part(a.p_name, ' ', 2) = 'rod' THEN 3 ELSE 0 END AS score
FROM part a JOIN part b ON split_part(a.p_name, ' ', 2) = split_part(b.p_name, ' ', 2) WHERE a.p_partkey % 20 = 0 AND b.p_partkey % 20 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY score DESC, ord, candidate) AS rn FROM m)
SELECT p_partkey AS entry, candidate, score, CASE WHEN candidate IS NULL THEN 'none' WHEN score < 20 THEN 'review' ELSE 'ok' END AS note FROM part LEFT JOIN r ON entry = p_partkey AND rn = 1 WHERE p_partkey % 20 = 0""",
    "entity_link_all": """WITH m AS (SELECT a.p_partkey AS entry, b.p_partkey AS candidate, b.p_size AS ord, CASE WHEN a.p_name = b.p_name THEN 20 ELSE 0 END + CASE WHEN a.p_brand = b.p_brand THEN 15 ELSE 0 END + CASE WHEN split_part(a.p_name, ' ', 2) = 'rod' THEN 3 ELSE 0 END AS score
FROM part a JOIN part b ON split_part(a.p_name, ' ', 2) = split_part(b.p_name, ' ', 2) AND a.p_partkey <> b.p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY score DESC, ord, candidate) AS rn FROM m)
SELECT p_partkey AS entry, candidate, score, CASE WHEN candidate IS NULL THEN 'none' WHEN score < 20 THEN 'review' ELSE 'ok' END AS note FROM part LEFT JOIN r ON entry = p_partkey AND rn = 1""",
    "slice_merge": """WITH b AS (SELECT s_suppkey, s_nationkey, s_name, s_acctbal, 'Q' || s_suppkey AS qid FROM supplier WHERE s_suppkey % 5 > 0),
n AS (SELECT s_nationkey, s_name AS old, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' new' ELSE s_name END AS new, s_acctbal + 1 AS bal FROM supplier WHERE s_suppkey % 3 = 0)
SELECT coalesce(b.s_nationkey, n.s_nationkey) AS s_nationkey, coalesce(new, b.s_name) AS s_name, round(coalesce(bal, b.s_acctbal), 2) AS s_acctbal, qid,
  CASE WHEN new IS NULL THEN 'kept' WHEN b.s_name IS NULL THEN 'added' WHEN new <> b.s_name THEN 'renamed' ELSE 'replaced' END AS change FROM b FULL JOIN n ON b.s_nationkey = n.s_nationkey AND b.s_name = n.old""",
    "snapshot_diff": """WITH a AS (SELECT * FROM orders WHERE o_orderkey % 13 > 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 11 > 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' WHEN s <> o_orderstatus THEN 'changed' ELSE 'kept' END AS change,
  CASE WHEN s <> o_orderstatus THEN 'o_orderstatus' ELSE '' END AS columns FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
    "build_stats": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n, sum(({k} % 2 = 0)::INT)::BIGINT AS canonical FROM {t}" for t, k in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("part", "p_partkey"))),
}
