"""Queries of evidence, scoring gates, look-ups and reference-data upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import table
from sievework.functions import text
from sievework.operators import analytics, dictionary, evidence, refdata, review, rules, scoring, selection, taxonomy
from sievework.plans.graph_queries import languages


def _noun():
    return F.split("p_name", " ")[1]


def _place(name):
    return F.lower(F.replace(name, F.lit("_"), F.lit(" ")))


def _tree(spark, sf_dir):
    """Regions and nations as one tree."""
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"))
    return taxonomy.closure(r.union(n))


def _ordered_parts(spark, sf_dir):
    """Each order with the part whose key its own key leaves modulo 200: parts of every scale."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 200).alias("p_partkey")).join(part, "p_partkey")


# -- taxonomy


def strip_classification(spark, sf_dir):
    name, turn = F.col("p_name"), F.col("p_partkey") % 6
    label = (
        F.when(turn == 0, F.concat(name, F.lit(" - doc"))).when(turn == 1, F.concat(name, F.lit(" doc aoc igt dop igp"))).when(turn == 2, F.concat(F.lit("appellation "), name, F.lit(" controlee")))
        .when(turn == 3, F.concat(F.lit("d.o. "), name, F.lit(" (spain) docg"))).when(turn == 4, F.concat(F.lit("grand cru vin de pays "), name, F.lit(" – aoc (a) (b)"))).otherwise(name)
    )
    return table(spark, sf_dir, "part").select("p_partkey", taxonomy.strip_classification(label).alias("bare"))


def deep_closure(spark, sf_dir):
    """Customers in chains of 100."""
    c = F.col("c_custkey")
    edges = table(spark, sf_dir, "customer").select(c.alias("id"), F.when(c % 100 > 0, c - 1).alias("parent_id"))
    return taxonomy.closure(edges).select("ancestor", "descendant", F.col("distance").cast("long").alias("distance"))


def deep_cycles(spark, sf_dir):
    """Customers in chains of 1,000, each of which ends in a ring of three."""
    c = F.col("c_custkey")
    edges = table(spark, sf_dir, "customer").select(c.alias("id"), F.when(c % 1000 == 0, c + 2).otherwise(c - 1).alias("parent_id"))
    return refdata.check_cycles(edges).select("rule", "key")


def below_node(spark, sf_dir):
    return taxonomy.descendants(_tree(spark, sf_dir), "r1")


def region_candidates(spark, sf_dir):
    """Labels that name a nation and its region; regions are country names, so they are tried last."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dims = nation.select(F.lower("n_name").alias("label_fold"), F.concat(F.lit("n"), "n_nationkey").alias("entity"))
    lands = table(spark, sf_dir, "region").select(F.lower("r_name").alias("label_fold"), F.concat(F.lit("r"), "r_regionkey").alias("entity"))
    turn = F.col("c_custkey") % 4
    n, r = F.lower("n_name"), F.lower("r_name")
    label = F.when(turn == 0, F.concat(n, F.lit(", "), r)).when(turn == 1, F.concat(r, F.lit(" / "), n, F.lit(" doc"))).when(turn == 2, r).otherwise("nowhere, at all")
    asked = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", label.alias("label"))
    each = taxonomy.region_candidates(asked.select("label").distinct(), "label", dims.union(lands), lands)
    return asked.join(each, "label").select("c_custkey", "entity")


def lookup_labels(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    of = lambda label, rank: nation.select(label.alias("label_fold"), F.concat(F.lit("n"), "n_nationkey").alias("entity"), F.col("n_name").alias("name"), F.lit("x").alias("scope"), (F.col("n_nationkey") % 7 != 3).alias("is_canonical"), F.lit(rank).alias("rank"))
    top = region.select(F.lower("r_name").alias("label_fold"), F.concat(F.lit("r"), "r_regionkey").alias("entity"), F.col("r_name").alias("name"), F.lit("x").alias("scope"), F.lit(True).alias("is_canonical"), F.lit(0).alias("rank"))
    dims = of(F.lower("n_name"), 0).union(of(F.concat(F.lit("land "), "n_nationkey"), 1)).union(top)
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("land "), "s_nationkey")).otherwise("nowhere").alias("label"))
    out = taxonomy.lookup(asked, "label", dims, _tree(spark, sf_dir))
    return out.select("s_suppkey", "known", "canonical", "is_placeholder", F.array_join("parents", ">").alias("parents"), F.array_join("synonyms", "|").alias("synonyms"))


def list_regions(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("scope"), (F.col("n_nationkey") % 7 != 3).alias("is_canonical"))
    return taxonomy.list_names(n, scope="1")


def list_by_edges(spark, sf_dir):
    """Segments that customers of a nation have: names reached through edges."""
    c = table(spark, sf_dir, "customer")
    named = c.select(F.col("c_mktsegment").alias("id"), F.col("c_mktsegment").alias("name"), F.lit(True).alias("is_canonical")).distinct()
    edges = c.select(F.col("c_nationkey").alias("left_id"), F.col("c_mktsegment").alias("right_id"))
    return taxonomy.list_names(named, edges=edges, region=3)


def label_dims(spark, sf_dir):
    """Names, synonyms and codes of nations as one table of folded labels."""
    from sievework.sources import catalog

    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("scope"), F.lit(True).alias("is_canonical"),
        F.when(F.col("n_nationkey") % 2 == 0, F.array(F.concat(F.lit("Land "), "n_nationkey"))).alias("synonyms"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("C"), "n_nationkey")).alias("code"),
    )
    return catalog.label_dims(n, "region", F.lower).select("kind", "label_fold", "entity", "rank")


# -- evidence


def mentioned_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[dictionary.mentioned(F.lit(a), F.lower(F.coalesce("text", F.lit("")))).alias(f"has_{a}") for a in ("that", "with", "und")])


def unsupported_claims(spark, sf_dir):
    """Words of the benchmark, each second one written backwards, that no document of a language has."""
    docs = table(spark, sf_dir, "documents")
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{6,})"), 1)))
    claims = table(spark, sf_dir, "benchmark").select("item_id", word.alias("claim")).select(F.when(F.col("item_id") % 2 == 0, F.reverse("claim")).otherwise(F.col("claim")).alias("claim")).distinct()
    groups = claims.withColumn("lang", F.explode(languages(docs)))
    blocks = docs.select("lang", F.col("source").alias("family"), F.lower("text").alias("body"))
    return evidence.unsupported(evidence.corroboration(groups, blocks, claims.select("claim", F.col("claim").alias("alias")), "lang")).select("lang", "claim")


def shares_named(spark, sf_dir):
    o = F.col("o_orderkey")
    body = F.when(o % 4 == 0, F.concat(o % 100, F.lit("% merlot and more"))).when(o % 4 == 1, F.concat(F.lit("merlot ("), o % 100, F.lit(".5 %)"))).when(o % 4 == 2, "merlot is good, 13% alcohol").otherwise("no share of merlot")
    return table(spark, sf_dir, "orders").select("o_orderkey", evidence.has_share(body, F.lit("merlot")).alias("has_share"))


#: Grapes by all their names, and what may stand around one of them.
GRAPE_NAMES = (("merlot",), ("st. laurent", "saint laurent"), ("l'aigle", "aigle (red)"), ("garnacha tinta", "grenache", "a+b*"))
SHARE_TEXTS = (
    "{} is 20% of it", "20% of {} and more", "12,5 % {}", "{} 8%", "{} (30.5 %)", "{}: 7%", "20% of {}s", "x{} 20%", "{}, 20%", "100 of {}", "{} - 20%", "1234% {}", "", "20%{}", "{}20%",
)


def shares_by_alias(spark, sf_dir):
    """Whether a text gives a grape a share by any of its names: signs in names, plurals, parts of words, decimals."""
    o = F.col("o_orderkey")
    at = lambda values, n: F.element_at(F.array(*values), (n + 1).cast("int"))
    names = at([F.array(*map(F.lit, x)) for x in GRAPE_NAMES], o % len(GRAPE_NAMES))
    spelled = F.element_at("names", (F.floor(o / 4) % F.size("names") + 1).cast("int"))
    text = F.replace(at(list(map(F.lit, SHARE_TEXTS)), F.floor(o / 16) % len(SHARE_TEXTS)), F.lit("{}"), spelled)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", names.alias("names")).withColumn("body", text)
    return rows.select("o_orderkey", evidence.share_named(F.col("body"), F.col("names")).alias("has_share"))


def blends_named_whole(spark, sf_dir):
    """A customer's orders as snippets that name one to three of two grapes."""
    o = F.col("o_orderkey")
    names = F.when(o % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(o % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.array(F.lit("a"), F.lit("b")).alias("claimed"), names.alias("named"), (o % 5 > 0).alias("part"), (o % 7 == 0).alias("shares"))
    return evidence.blend_named_whole(rows, "o_custkey", "claimed", "named", "part", "shares")


def called_blends(spark, sf_dir):
    d = F.col("doc_id")
    said = F.concat(F.lower(F.coalesce("text", F.lit(""))), F.when(d % 5 == 0, " an assemblage.").when(d % 5 == 1, " unblended").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", evidence.calls_it_a_blend(said).alias("blend"))


def white_only(spark, sf_dir):
    p = F.col("p_partkey")
    category = F.when(p % 4 == 0, "red").when(p % 4 == 1, "rose").when(p % 4 == 2, "white")
    colours = F.when(p % 3 == 0, F.array(F.lit("white"), F.lit("white"))).when(p % 3 == 1, F.array(F.lit("white"), F.lit("red"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select("p_partkey", evidence.white_grapes_only(category, colours, F.array(_noun()), ["rod"]).alias("white_only"))


def origin_named(spark, sf_dir):
    """Eight ways to name a place, one after the other, on every order."""
    place = _place("n_name")
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "nation"), F.col("o_orderkey") % 25 == F.col("n_nationkey")).withColumn("place", place)
    turn, p = F.col("o_orderkey") % 8, F.col("place")
    dash = F.replace(p, F.lit(" "), F.lit("-"))
    hay = (
        F.when(turn == 0, F.concat(F.lit("a red wine from "), p)).when(turn == 1, F.concat(F.lit("bodega based in oyon. a red wine from "), p)).when(turn == 2, F.concat(F.lit("our cellar is located in "), p))
        .when(turn == 3, F.concat(F.lit("38 km from "), p)).when(turn.isin(4, 5), F.concat(F.lit("estate "), p, F.lit(" wins"))).when(turn == 6, F.concat(F.lit("the "), dash, F.lit(" alta is fine"))).otherwise(F.concat(F.lit("made in "), dash, F.lit(", spain")))
    )
    name = F.when(turn == 4, F.concat(F.lit("estate "), p, F.lit(" reserve"))).when(turn == 5, F.concat(F.lit("estate "), p)).when(turn > 5, F.concat(p, F.lit(" alta"))).otherwise("some wine")
    return o.select("o_orderkey", evidence.named_as_origin(p, hay, name).alias("origin"))


def longer_regions(spark, sf_dir):
    """Orders claim a part's noun; up to three sources name the part's whole name or the noun alone."""
    rows = _ordered_parts(spark, sf_dir).withColumn("noun", _noun())
    part = table(spark, sf_dir, "part")
    labels = part.select(F.lit("x").alias("scope"), F.col("p_name").alias("entity")).union(part.select(F.lit("x"), _noun())).distinct().select("scope", "entity", F.col("entity").alias("alias"), F.lit(True).alias("is_canonical"))
    tree = taxonomy.closure(labels.select(F.col("entity").alias("id"), F.lit(None).cast("string").alias("parent_id")))
    o = F.col("o_orderkey")
    said = F.array(
        F.struct(F.lit("f1").alias("family"), F.concat(F.lit("made with "), "p_name").alias("body")),
        F.struct(F.lit("f2").alias("family"), F.when(o % 2 == 0, F.concat(F.lit("again "), "p_name")).otherwise(F.concat(F.lit("just a "), "noun", F.lit(" here"))).alias("body")),
        F.struct(F.lit("f3").alias("family"), F.when(o % 3 == 0, F.concat(F.lit("the "), "noun", F.lit(" alone"))).otherwise("nothing").alias("body")),
    )
    blocks = rows.select("o_orderkey", F.explode(said).alias("b")).select("o_orderkey", "b.*")
    leaves, names = rows.select("o_orderkey", F.col("noun").alias("region")), rows.select("o_orderkey", F.lit("some name").alias("name"))
    return evidence.longer_regions(leaves, "o_orderkey", "region", labels, tree, blocks, names)


def unsupported_regions(spark, sf_dir):
    """Customers claim a region; their orders name nations."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("r"), F.col("c_custkey") % 5).alias("region"))
    counts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("n"), F.col("o_orderkey") % 25).alias("region"), F.lit(1).alias("n_sources")).distinct()
    return evidence.unsupported_regions(c, "c_custkey", "region", _tree(spark, sf_dir), counts)


def name_region(spark, sf_dir):
    """Names that hold a nation and a region: the nation, if it lies in that region."""
    c = table(spark, sf_dir, "customer")
    nation = c.select("c_custkey", F.concat(F.lit("n"), "c_nationkey").alias("region"))
    return evidence.name_region(nation.union(c.select("c_custkey", F.concat(F.lit("r"), F.col("c_custkey") % 5))), "c_custkey", "region", _tree(spark, sf_dir))


def region_from_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k, own = F.col("c_custkey"), F.concat(F.lit("n"), "c_nationkey")
    claimed = F.when(k % 4 == 0, F.concat(F.lit("r"), "n_regionkey")).when(k % 4 == 1, own).when(k % 4 == 3, F.concat(F.lit("n"), (F.col("c_nationkey") + 1) % 25))
    rows = c.select("c_custkey", claimed.alias("claimed"), F.when(k % 9 > 0, own).alias("from_name"))
    return evidence.region_from_name(rows, "claimed", "from_name", _tree(spark, sf_dir))


def reviewed_tags(spark, sf_dir):
    """Customers claim their region or nation; names and two sources name either, neither, or another: the whole review in one pass."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", _place("n_name").alias("place"), F.lower("r_name").alias("land"))
    tree = taxonomy.closure(placed.select(F.col("place").alias("id"), F.col("land").alias("parent_id")).union(region.select(F.lower("r_name"), F.lit(None).cast("string"))))
    labels = placed.select(F.col("land").alias("scope"), F.col("place").alias("entity")).union(region.select(F.lower("r_name"), F.lower("r_name"))).select("scope", "entity", F.col("entity").alias("alias"), F.lit(True).alias("is_canonical"))
    other = placed.select(((F.col("n_nationkey") + 24) % 25).alias("c_nationkey"), F.col("place").alias("other"))
    cust = table(spark, sf_dir, "customer").join(placed, F.col("c_nationkey") == F.col("n_nationkey")).join(other, "c_nationkey")
    turn, place, land = F.col("c_custkey") % 6, F.col("place"), F.col("land")
    name = F.when(turn == 0, F.concat(F.lit("wine of "), place)).when(turn == 4, F.concat(F.lit("wine of "), "other")).otherwise("plain wine")
    rows = cust.select(
        F.col("c_custkey").alias("row"), name.alias("name"), F.lit("red").alias("category"), F.lit(None).cast("string").alias("scope"), (turn != 5).alias("submitted"), F.lit(False).alias("is_blend"),
        (60 + F.col("c_custkey") % 40).alias("confidence"), F.array(F.lit("malbec")).alias("grapes"), F.array(F.lit("red")).alias("colours"),
        F.when(turn.isin(2, 4), F.array(place, land)).otherwise(F.array(land)).alias("regions"), F.lit(False).alias("named_whole"),
    )
    said = F.when(turn.isin(1, 4), F.concat(F.lit("the "), place, F.lit(" malbec"))).when(turn == 3, F.concat(F.lit("malbec of "), land)).otherwise("a malbec")
    families = F.when(turn == 3, F.array(F.lit("f1"))).otherwise(F.array(F.lit("f1"), F.lit("f2")))
    blocks = cust.select(F.col("c_custkey").alias("row"), F.explode(families).alias("family"), said.alias("body"))
    grapes = spark.range(1).select(F.lit("malbec").alias("claim"), F.lit("cot noir").alias("alias"))
    out = review.review(rows, blocks, grapes, labels, tree)
    return out.select(F.col("row").alias("c_custkey"), F.array_join("regions", "|").alias("regions"), F.array_join("reasons", ",").alias("reasons"), "confidence", "status")


def replaced_regions(spark, sf_dir):
    new = evidence.replace_region(F.array("p_brand", _noun(), F.lit("widget"), F.lit("wid")), F.array(F.col("p_name"), F.lit("goods")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(new, "|").alias("regions"))


def organic_confirmed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", evidence.organic_confirmed(F.col("text"), F.col("source"), ["and the", " que ", "src3"]).alias("organic"))


# -- scoring gates


def _slug(p):
    return F.concat(F.lit("http://shop.com/a/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.when(p % 4 != 1, "-white").otherwise(""))


def colour_conflict(spark, sf_dir):
    p = F.col("p_partkey")
    own = F.when(p % 4 == 2, F.array(_noun(), F.lit("white"))).otherwise(F.array(_noun()))
    hit = text.value_conflict(text.slug_words(_slug(p)), F.when(p % 4 == 3, "white").otherwise("red"), {"red": ["white", "rose"]}, own)
    return table(spark, sf_dir, "part").select("p_partkey", hit.alias("conflict"))


def search_echo(spark, sf_dir):
    p = F.col("p_partkey")
    body = F.when(p % 3 == 0, F.concat(F.lit("results for "), "p_name")).when(p % 3 == 1, F.concat(F.lit("results for "), F.initcap("p_name"))).otherwise(F.concat(F.lit("we have results for "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.is_search_echo(body, "results for (.+)").alias("echo"))


def content_gates(spark, sf_dir):
    p = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(p % 7 == 0, "earlier").alias("dropped_reason"), F.when(p % 3 == 0, F.concat(F.lit("results for "), "p_name")).otherwise("a body").alias("body"), _slug(p).alias("url"), F.lit("red").alias("category"), F.array(_noun()).alias("own"))
    return scoring.content_gates(rows, "results for (.+)", {"red": ["white"]}, "own").select("p_partkey", "dropped_reason")


def name_coverage(spark, sf_dir):
    p = F.col("p_partkey")
    body = F.when(p % 3 == 0, F.concat(F.lit("Hot Rod Cold Gear Old Anvil New Plate "), F.initcap("p_name"))).when(p % 3 == 1, F.concat(F.lit("this is the "), "p_name")).otherwise(_noun())
    return table(spark, sf_dir, "part").select("p_partkey", scoring.name_coverage(F.split("p_name", " "), F.lower(body), body).alias("covered"))


def url_only_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    found = text.url_only_tokens(F.array(F.lit("the"), F.lit("der"), F.lit("que"), F.lit("zzz")), F.concat(F.lit("http://x.com/the-der-que-"), "doc_id"), F.lower(F.coalesce("text", F.lit(""))))
    return d.select("doc_id", F.array_join(found, ",").alias("tokens"))


def scored_snippets(spark, sf_dir):
    """Orders as snippets of their part: two that score and three that a gate each drops."""
    o = F.col("o_orderkey")
    rows = _ordered_parts(spark, sf_dir)
    body = F.when(o % 5 == 0, F.concat(F.lit("the "), "p_name", F.lit(" is here"))).when(o % 5 == 1, F.concat(F.lit("only "), _noun(), F.lit(" here"))).when(o % 5 == 2, F.concat(F.lit("results for "), "p_name")).when(o % 5 == 3, F.col("p_name")).otherwise("nothing of it")
    url = F.when(o % 5 == 3, "http://s.com/x-white").otherwise("http://s.com/x")
    df = rows.select(
        F.col("p_partkey").alias("product_id"), o.alias("pos"), F.col("p_name").alias("name"), F.lit("red").alias("category"), F.split("p_name", " ").alias("tokens"), F.split("p_name", " ").alias("own"),
        F.lower(body).alias("hay"), body.alias("body"), url.alias("url"), F.lit("s").alias("source"), F.lit(1).alias("n_grapes"), F.lit(0).alias("n_regions"))
    every, _ = scoring.score_and_assemble(df, [scoring.lexical_scorer], "results for (.+)", {"red": ["white"]})
    return every.select(F.col("pos").alias("o_orderkey"), "dropped_reason", F.col("match_score").cast("long").alias("match_score"))


def ranked_facts(spark, sf_dir):
    o = F.col("o_orderkey")
    rank = [*selection.fact_rank(o % 6, o % 2, F.floor("o_totalprice") % 10), o]
    return rules.top_n(table(spark, sf_dir, "orders"), ["o_custkey"], rank, 3).select("o_custkey", "o_orderkey", "rn")


def truncated_bodies(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate(F.col("text"), 500).alias("body")).where("body IS NOT NULL").select("doc_id", F.length("body").cast("long").alias("n"), F.md5("body").alias("body_md5"))


# -- runs


def best_score(spark, sf_dir):
    o = F.col("o_orderkey")
    return analytics.best_score(table(spark, sf_dir, "orders").select("o_custkey", F.when(o % 3 > 0, o % 101).alias("match_score")), "o_custkey")


def phase_states(spark, sf_dir):
    c = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(c % 4 > 0, c % 3).alias("n_snippets"), F.when(c % 5 > 0, c % 2 == 0).alias("has_context"), F.when(c % 7 > 0, c % 3 == 1).alias("submitted"))
    return analytics.phase_status(rows).select("c_custkey", "search", "score", "tag")


def wine_search(spark, sf_dir):
    """Status equality and a substring over text and array columns."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", F.array(F.lower("p_type"), _noun()).alias("regions"), F.when(F.col("p_partkey") % 2 == 0, "model").otherwise("human").alias("tag_status"))
    return rules.search(part, " ECO", ["p_name", "p_brand", "regions"], {"tag_status": "model"}).select("p_partkey")


def event_filter(spark, sf_dir):
    return rules.event_filter(table(spark, sf_dir, "events").withColumnRenamed("event_type", "type"), ["view", "click"]).select("event_id", "type")


# -- reference data


def required_ids(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    rows = s.select("s_name", F.when(k % 4 == 0, "Q1").when(k % 4 == 1, "none").alias("pin"), F.when(k % 8 == 1, "a book").alias("source"))
    lock = s.where("s_suppkey % 3 = 0").select("s_name", F.concat(F.lit("Q"), k).alias("qid"))
    return refdata.check_required(rows, "s_name", "pin", lock, "source")


def picked_countries(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment") == "FURNITURE").alias("sovereign"))
    return refdata.pick_country(c, "c_nationkey", "sovereign", "c_custkey").select("c_nationkey", "c_custkey")


def linked_edges(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    edges = c.select(F.lower("n_name").alias("a"), F.when(F.col("c_custkey") % 4 == 0, "nowhere").otherwise(F.lower("r_name")).alias("b"))
    left, right = n.select(F.lower("n_name").alias("label_fold"), F.col("n_nationkey").alias("entity")), r.select(F.lower("r_name").alias("label_fold"), F.col("r_regionkey").alias("entity"))
    return refdata.link_edges(edges, left, right, "a", "b")


def filled_colours(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("colour"))
    new = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select("p_partkey", F.lit("red").alias("colour"))
    return refdata.fill_null(part, new, "p_partkey", "colour")


def _lock(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    lock = s.where("s_suppkey % 5 > 0").select("s_name", F.when(k % 4 > 0, F.concat(F.lit("Q"), k)).alias("qid"), F.when(k % 3 == 0, "review").otherwise("ok").alias("note"))
    return lock, s.where("s_suppkey % 7 > 0").select("s_name")


def lock_prune(spark, sf_dir):
    return refdata.lock_prune(*_lock(spark, sf_dir), "s_name")


def lock_report(spark, sf_dir):
    return refdata.lock_report(*_lock(spark, sf_dir), "s_name")


def merged_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("owner"), F.col("p_name").alias("label"), F.col("p_partkey").alias("seq"))
    return refdata.merge_names(part.where("seq % 3 = 0"), part.where("seq % 3 > 0").withColumn("label", F.upper("label"))).select("owner", "label", "tier", "seq")


def slice_check(spark, sf_dir):
    """Suppliers whose key is a multiple of three as a slice, held against the others."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").withColumn("land", F.col("s_nationkey").cast("string"))
    rows = s.where("s_suppkey % 3 = 0").select(
        F.when(k % 9 == 0, "Twin").when(k % 15 == 3, "Grand cru x").otherwise(F.col("s_name")).alias("name"), "land", F.when(k % 6 == 0, "Nobody").alias("parent"),
        F.when(k % 12 == 3, F.array(F.concat(F.lit("Supplier#"), F.lpad(k + 1, 9, "0")))).alias("synonyms"), F.when(k % 5 > 0, "a book").alias("source"),
        F.when(k % 12 == 0, F.col("s_name")).alias("was"), F.array(F.when(k % 2 == 0, "merlot").otherwise("zzz")).alias("grapes"),
    ).withColumnRenamed("land", "country")
    others = s.where("s_suppkey % 3 > 0").select(F.col("s_name").alias("name"), F.col("land").alias("country"))
    others = others.union(s.where("s_suppkey % 9 = 0").select(F.lit("Twin"), F.lit("0")))
    found = refdata.check_slice(rows, others, ["grand cru", "aoc"], spark.createDataFrame([("merlot",)], "label string"))
    return found.groupBy("rule", "severity", "key").agg(F.count("*").alias("n"))


def field_checks(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        "s_name", F.when(k % 4 > 0, F.concat(F.when(k % 3 == 0, "q").otherwise("Q"), k)).alias("qid"), F.when(k % 5 == 0, "fra").otherwise("FR").alias("iso"), F.when(k % 7 == 0, "blue").otherwise("red").alias("colour"))
    return refdata.check_fields(rows, "s_name", {"qid": r"Q\d+", "iso": "[A-Z]{2}", "colour": "red|white|rose"}).select("rule", "key", "message")


def found_labels(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.lower("p_name").alias("fold"))
    return refdata.label_find(part, part.where("p_type = 'ECONOMY'").select("fold"), "fold").select("p_partkey", "fold")


def sibling_slices(spark, sf_dir):
    return refdata.siblings(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("slug"), F.col("c_nationkey").alias("country")))


def label_union(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    file = lambda tag, where: part.where(where).select("p_name", F.lit(tag).alias("file")).distinct()
    return refdata.label_union([file("a", "p_partkey % 5 = 0"), file("b", "p_partkey % 2 = 0"), file("c", "true")], ["p_name"])


def synonym_changes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    old, new = part.select("p_partkey", F.split("p_name", " ").alias("syn")), part.select("p_partkey", F.array(_noun(), F.col("p_brand")).alias("syn"))
    out = refdata.synonym_changes(old, new, ["p_partkey"], "syn")
    return out.select("p_partkey", F.array_join("gained", "|").alias("gained"), F.array_join("lost", "|").alias("lost"))


QUERIES = {f.__name__: f for f in (
    strip_classification, deep_closure, deep_cycles, below_node, region_candidates, lookup_labels, list_regions, list_by_edges, label_dims, mentioned_words, unsupported_claims, shares_named, shares_by_alias, blends_named_whole,
    called_blends, white_only, origin_named, longer_regions, unsupported_regions, name_region, region_from_name, reviewed_tags, replaced_regions, organic_confirmed, colour_conflict, search_echo, content_gates, name_coverage,
    url_only_tokens, scored_snippets, ranked_facts, truncated_bodies, best_score, phase_states, wine_search, event_filter, required_ids, picked_countries, linked_edges, filled_colours, lock_prune, lock_report,
    merged_names, slice_check, field_checks, found_labels, sibling_slices, label_union, synonym_changes,
)}

TREE = """t AS (SELECT 'r' || r_regionkey AS ancestor, 'r' || r_regionkey AS descendant, 0 AS distance FROM region UNION ALL SELECT 'n' || n_nationkey, 'n' || n_nationkey, 0 FROM nation
UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, 1 FROM nation)"""
PARTS = "x AS (SELECT o_orderkey, p_partkey, p_name, split_part(p_name, ' ', 2) AS noun FROM orders JOIN part ON p_partkey = o_orderkey % 200)"

SQL = {
    "strip_classification": "SELECT p_partkey, p_name AS bare FROM part",
    "deep_closure": "SELECT a.c_custkey AS ancestor, b.c_custkey AS descendant, b.c_custkey - a.c_custkey AS distance FROM customer a JOIN customer b ON a.c_custkey // 100 = b.c_custkey // 100 AND a.c_custkey <= b.c_custkey",
    "deep_cycles": "SELECT 'cycle' AS rule, c_custkey::VARCHAR AS key FROM customer WHERE c_custkey % 1000 < 3 AND c_custkey - c_custkey % 1000 + 2 <= (SELECT max(c_custkey) FROM customer)",
    "below_node": "SELECT 'n' || n_nationkey AS id FROM nation WHERE n_regionkey = 1",
    "region_candidates": "SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS entity FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 < 3",
    "lookup_labels": """SELECT s_suppkey, s_suppkey % 3 > 0 AS known, CASE WHEN s_suppkey % 3 > 0 THEN n_name END AS canonical, CASE WHEN s_suppkey % 3 > 0 THEN n_nationkey % 7 = 3 END AS is_placeholder,
  CASE WHEN s_suppkey % 3 > 0 THEN r_name END AS parents, CASE WHEN s_suppkey % 3 > 0 THEN 'land ' || n_nationkey END AS synonyms FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "list_regions": "SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 1 AND n_nationkey % 7 <> 3",
    "list_by_edges": "SELECT DISTINCT c_mktsegment AS id, c_mktsegment AS name FROM customer WHERE c_nationkey = 3",
    "label_dims": """SELECT 'region' AS kind, lower(n_name) AS label_fold, n_nationkey AS entity, 0 AS rank FROM nation UNION ALL SELECT 'region', 'land ' || n_nationkey, n_nationkey, 1 FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT 'region', 'c' || n_nationkey, n_nationkey, 2 FROM nation WHERE n_nationkey % 3 = 0""",
    "mentioned_words": r"""WITH b AS (SELECT doc_id, ' ' || regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM documents) SELECT doc_id, contains(t, ' that ') AS has_that, contains(t, ' with ') AS has_with, FALSE AS has_und FROM b""",
    "unsupported_claims": r"""WITH cl AS (SELECT DISTINCT CASE WHEN item_id % 2 = 0 THEN reverse(w) ELSE w END AS claim FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS w FROM benchmark)),
b AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS claim FROM documents)
SELECT lang, claim FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL), cl EXCEPT SELECT lang, claim FROM b""",
    "shares_by_alias": """WITH g(k, names) AS (VALUES """ + ", ".join(f"({i}, [" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "])" for i, names in enumerate(GRAPE_NAMES)) + """),
t(j, form) AS (VALUES """ + ", ".join(f"({i}, '{x}')" for i, x in enumerate(SHARE_TEXTS)) + r"""),
b AS (SELECT o_orderkey, names, replace(form, '{}', names[(o_orderkey // 4) % len(names) + 1]) AS body FROM orders JOIN g ON k = o_orderkey % 4 JOIN t ON j = (o_orderkey // 16) % """ + str(len(SHARE_TEXTS)) + r"""),
n AS (SELECT o_orderkey, body, regexp_escape(unnest(names)) AS n FROM b)
SELECT o_orderkey, bool_or(regexp_matches(body, '\d{1,3}([.,]\d+)?\s?%\s*(of\s+)?' || n || '([^a-z0-9]|$)') OR regexp_matches(body, '(^|[^a-z0-9])' || n || '\s*[:(]?\s*\d{1,3}([.,]\d+)?\s?%')) AS has_share FROM n GROUP BY 1""",
    "shares_named": "SELECT o_orderkey, o_orderkey % 4 < 2 AS has_share FROM orders",
    "blends_named_whole": "SELECT o_custkey, bool_or(o_orderkey % 5 = 0 AND (o_orderkey % 3 = 0 OR (o_orderkey % 3 = 2 AND o_orderkey % 7 = 0))) AS named_whole FROM orders GROUP BY o_custkey",
    "called_blends": r"SELECT doc_id, doc_id % 5 = 0 OR regexp_matches(lower(coalesce(text, '')), '\b(blend|blended|assemblage)\b') AS blend FROM documents",
    "white_only": "SELECT p_partkey, p_partkey % 3 = 0 AND (p_partkey % 4 = 0 OR (p_partkey % 4 = 1 AND split_part(p_name, ' ', 2) <> 'rod')) AS white_only FROM part",
    "origin_named": "SELECT o_orderkey, o_orderkey % 8 IN (0, 1, 5, 7) AS origin FROM orders",
    "longer_regions": "WITH " + PARTS + """, c AS (SELECT o_orderkey, noun, p_name, 1 + (o_orderkey % 2 = 0)::BIGINT AS n, CASE WHEN length(noun) >= 4 THEN (o_orderkey % 2 = 1)::BIGINT + (o_orderkey % 3 = 0)::BIGINT ELSE 0 END AS leaf_n FROM x)
SELECT o_orderkey, noun AS region, p_name AS longer, n, leaf_n FROM c WHERE n >= 2 OR n >= leaf_n""",
    "unsupported_regions": "SELECT c_custkey, 'r' || c_custkey % 5 AS region FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders JOIN nation ON n_nationkey = o_orderkey % 25 WHERE o_custkey = c_custkey AND n_regionkey = c_custkey % 5)",
    "name_region": "SELECT c_custkey, 'n' || c_nationkey AS region FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = c_custkey % 5",
    "region_from_name": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'r' || n_regionkey WHEN 1 THEN 'n' || c_nationkey WHEN 3 THEN 'n' || (c_nationkey + 1) % 25 END AS claimed, CASE WHEN c_custkey % 9 > 0 THEN 'n' || c_nationkey END AS from_name,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'agree' WHEN c_custkey % 4 = 3 THEN 'conflict' ELSE 'upgrade' END AS name_verdict FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "reviewed_tags": """WITH c AS (SELECT c_custkey, c_custkey % 6 AS turn, 60 + c_custkey % 40 AS conf, lower(replace(n.n_name, '_', ' ')) AS place, lower(r_name) AS land, lower(replace(o.n_name, '_', ' ')) AS other
  FROM customer JOIN nation n ON c_nationkey = n.n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN nation o ON (c_nationkey + 1) % 25 = o.n_nationkey),
x AS (SELECT *, CASE WHEN turn = 5 THEN 'no_submit' ELSE concat_ws(',', CASE turn WHEN 3 THEN 'single_source' WHEN 4 THEN 'name_region_conflict:' || other WHEN 2 THEN 'unsupported_region:' || place
  WHEN 0 THEN NULL END, CASE WHEN conf < 80 THEN 'low_confidence' END) END AS reasons, CASE WHEN turn = 3 THEN least(conf, 69) ELSE conf END AS confidence FROM c)
SELECT c_custkey, CASE WHEN turn IN (3, 5) THEN land ELSE place || '|' || land END AS regions, reasons, confidence, CASE WHEN reasons = '' AND confidence >= 80 THEN 'model' ELSE 'needs_review' END AS status FROM x""",
    "replaced_regions": "SELECT p_partkey, p_name || '|goods|' || p_brand || CASE WHEN split_part(p_name, ' ', 2) <> 'widget' THEN '|widget' ELSE '' END || '|wid' AS regions FROM part",
    "organic_confirmed": "SELECT doc_id, contains(h, 'and the') OR contains(h, ' que ') OR contains(h, 'src3') AS organic FROM (SELECT doc_id, lower(concat_ws(' ', text, source)) AS h FROM documents)",
    "colour_conflict": "SELECT p_partkey, p_partkey % 4 = 0 AS conflict FROM part",
    "search_echo": "SELECT p_partkey, p_partkey % 3 = 0 AS echo FROM part",
    "content_gates": "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'earlier' WHEN p_partkey % 3 = 0 THEN 'search_page' WHEN p_partkey % 4 <> 1 THEN 'colour_conflict' END AS dropped_reason FROM part",
    "name_coverage": "SELECT p_partkey, p_partkey % 3 = 1 AS covered FROM part",
    "url_only_tokens": "SELECT doc_id, array_to_string([t FOR t IN ['the', 'der', 'que'] IF NOT contains(substr(lower(coalesce(text, '')), 1, 600), t)], ',') AS tokens FROM documents",
    "scored_snippets": "WITH " + PARTS + """ SELECT o_orderkey, CASE o_orderkey % 5 WHEN 2 THEN 'search_page' WHEN 3 THEN 'colour_conflict' WHEN 4 THEN 'producer_absent' END AS dropped_reason,
  CASE o_orderkey % 5 WHEN 0 THEN 100 WHEN 1 THEN 50 ELSE 0 END::BIGINT AS match_score FROM x""",
    "ranked_facts": """SELECT o_custkey, o_orderkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderkey % 6 BETWEEN 1 AND 3) DESC, (o_orderkey % 6 <= 3 AND o_orderkey % 2 > 0) DESC, floor(o_totalprice)::BIGINT % 10 DESC, o_orderkey)::INT AS rn FROM orders) WHERE rn <= 3""",
    "truncated_bodies": "SELECT doc_id, length(substr(text, 1, 500)) AS n, md5(substr(text, 1, 500)) AS body_md5 FROM documents WHERE trim(substr(text, 1, 500)) <> ''",
    "best_score": "SELECT o_custkey, coalesce(max(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 101 END), 0) AS best_score FROM orders GROUP BY 1",
    "phase_states": """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 3 > 0 THEN 'ok' ELSE 'empty' END AS search, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'ok' ELSE 'no_context' END AS score,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'ok' WHEN c_custkey % 5 = 0 OR c_custkey % 2 = 0 THEN 'no_submit' ELSE 'no_context' END AS tag FROM customer""",
    "wine_search": "SELECT p_partkey FROM part WHERE p_partkey % 2 = 0 AND contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'eco')",
    "event_filter": "SELECT event_id, event_type AS type FROM events WHERE event_type NOT IN ('view', 'click')",
    "required_ids": """WITH r AS (SELECT s_name, s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'Q1' WHEN 1 THEN 'none' ELSE CASE WHEN s_suppkey % 3 = 0 THEN 'Q' || s_suppkey END END AS id FROM supplier)
SELECT 'missing_id' AS rule, 'error' AS severity, s_name AS key, CASE WHEN id IS NULL THEN 'no id' ELSE 'no id and no source' END AS message FROM r WHERE id IS NULL OR (id = 'none' AND k % 8 <> 1)""",
    "picked_countries": "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_custkey % 3 > 0 AND c_mktsegment = 'FURNITURE') DESC, c_custkey) AS rn FROM customer) WHERE rn = 1",
    "linked_edges": "SELECT DISTINCT n_nationkey AS left_id, n_regionkey AS right_id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 > 0",
    "filled_colours": "SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_type WHEN p_partkey % 2 = 0 THEN 'red' END AS colour FROM part",
    "lock_prune": "SELECT s_name, CASE WHEN s_suppkey % 4 > 0 THEN 'Q' || s_suppkey END AS qid, CASE WHEN s_suppkey % 3 = 0 THEN 'review' ELSE 'ok' END AS note FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 > 0",
    "lock_report": """SELECT s_name, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 4 = 0 THEN 'unresolved' ELSE 'review' END AS why FROM supplier
WHERE s_suppkey % 7 > 0 AND (s_suppkey % 5 = 0 OR s_suppkey % 4 = 0 OR s_suppkey % 3 = 0)""",
    "merged_names": """SELECT owner, label, tier, seq FROM (SELECT *, row_number() OVER (PARTITION BY lower(label) ORDER BY tier, seq, owner) AS rn FROM
(SELECT p_brand AS owner, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE upper(p_name) END AS label, (p_partkey % 3 > 0)::INT AS tier, p_partkey AS seq FROM part)) WHERE rn = 1""",
    "slice_check": """WITH s AS (SELECT *, s_suppkey AS k, s_nationkey::VARCHAR AS country FROM supplier),
r AS (SELECT k, country, CASE WHEN k % 9 = 0 THEN 'Twin' WHEN k % 15 = 3 THEN 'Grand cru x' ELSE s_name END AS name, CASE WHEN k % 12 = 0 THEN s_name END AS was FROM s WHERE k % 3 = 0),
o AS (SELECT s_name AS name, country FROM s WHERE k % 3 > 0 UNION ALL SELECT 'Twin', '0' FROM s WHERE k % 9 = 0),
m AS (SELECT name, country, 1 AS own FROM r UNION ALL SELECT o.name, o.country, 0 FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.country = o.country AND coalesce(r.was, r.name) = o.name)),
v AS (SELECT 'duplicate_label' AS rule, 'error' AS severity, name || '|' || country AS key FROM m GROUP BY name, country HAVING count(*) > 1 AND max(own) = 1
UNION ALL SELECT 'unknown_parent', 'error', name FROM r WHERE k % 6 = 0 UNION ALL SELECT 'class_word', 'warning', name FROM r WHERE name = 'Grand cru x'
UNION ALL SELECT 'synonym_is_name', 'warning', name FROM r WHERE k % 12 = 3 AND k + 1 <= (SELECT max(k) FROM s) UNION ALL SELECT 'unknown_grape', 'error', name FROM r WHERE k % 2 = 1
UNION ALL SELECT 'no_source', 'warning', name FROM r WHERE k % 5 = 0)
SELECT rule, severity, key, count(*) AS n FROM v GROUP BY ALL""",
    "field_checks": """SELECT 'format_qid' AS rule, s_name AS key, 'is q' || s_suppkey AS message FROM supplier WHERE s_suppkey % 4 > 0 AND s_suppkey % 3 = 0 UNION ALL SELECT 'format_iso', s_name, 'is fra' FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'format_colour', s_name, 'is blue' FROM supplier WHERE s_suppkey % 7 = 0""",
    "found_labels": "SELECT p_partkey, lower(p_name) AS fold FROM part WHERE lower(p_name) IN (SELECT lower(p_name) FROM part WHERE p_type = 'ECONOMY')",
    "sibling_slices": """WITH s AS (SELECT DISTINCT c_mktsegment AS slug, c_nationkey AS country FROM customer) SELECT DISTINCT a.slug, b.slug AS sibling FROM s a JOIN s b ON a.country = b.country AND a.slug <> b.slug""",
    "label_union": "SELECT p_name, min(CASE WHEN p_partkey % 5 = 0 THEN 'a' WHEN p_partkey % 2 = 0 THEN 'b' ELSE 'c' END) AS file FROM part GROUP BY 1",
    "synonym_changes": "SELECT p_partkey, p_brand AS gained, split_part(p_name, ' ', 1) AS lost FROM part",
}
