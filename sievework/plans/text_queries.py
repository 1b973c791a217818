"""Queries of the snippet side: folds, tokens, URLs, cleaning, splices, near-duplicates, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import table
from sievework.functions import fold, text, urls
from sievework.operators import dictionary, selection, snippets

STOPWORDS = ("that", "with", "this", "from", "have", "they")
PHRASES = ("released under the mit license", "all rights reserved", "sign up")
SENTENCES = (r"\S+@\S+\.\S+",)
SNIPPET_WORDS = ("alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliet")
TEMPLATES = [
    (0, "name", "*", "{name}"), (1, "name facts", "*", "{name} origin"), (2, "sku", "*", "{sku}"), (3, "sku name", "*", "{sku} {name}"), (4, "dist", "{dist}", "{name}"),
    (5, "dist sku", "{dist}", "{sku}"), (6, "review", "*", "{name} review"), (7, "made", "*", "who makes {name}"), (8, "size", "*", "{name} size"), (9, "blend", "*", "is {name} a blend?"),
]
SUPPLIERS = [("cold", "cold.example.com"), ("hot", "hot.example.com")]


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def fold_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(fold.fold(F.col("text"), "text")).alias("folded_md5"))


def fold_latin(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(fold.fold_latin(F.col("text"))).alias("folded_md5"))


def tokens_significant(spark, sf_dir):
    found = text.significant_tokens(fold.fold_latin(F.col("text")), STOPWORDS)
    return _docs(spark, sf_dir).select("doc_id", F.size(found).alias("n_tokens"), F.md5(F.array_join(found, " ")).alias("tokens_md5"))


def clean_body(spark, sf_dir):
    cleaned = text.clean_text(F.col("text"), PHRASES, SENTENCES)
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaned).alias("clean_md5"), text.keep_body(F.col("text"), cleaned).alias("keep"))


def price_only(spark, sf_dir):
    shown = F.when(F.col("turn") % 2 == 0, F.regexp_replace("text", r"[^0-9., ]", "")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.price_only(shown).alias("price_only"))


def list_page_ratio(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.is_list_page(F.col("text")).alias("is_list"))


def url_host(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.within_any(urls.host(u), ["example.com", "net"]).alias("blocked"))


def on_site(spark, sf_dir):
    scope = F.when(F.col("page_id") % 2 == 0, "*").otherwise("example.com")
    return table(spark, sf_dir, "pages").select("page_id", urls.on_site(F.col("url"), scope, ["net"]).alias("on_site"))


def url_dedupe(spark, sf_dir):
    cut = F.regexp_replace("url", r"\?.*$", "")
    pages = table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 7).alias("grp"), F.when(F.col("page_id") % 11 == 0, "").otherwise(cut).alias("url"))
    return snippets.url_dedupe(pages, ["grp"], ["page_id"]).select("page_id", "grp", "url")


def url_slug_words(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(text.slug_words(F.col("url")), " ").alias("slug"))


def query_plan(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_name").alias("supplier"),
                                               F.when(F.col("p_size") > 25, F.lpad(F.col("p_partkey").cast("string"), 9, "7")).otherwise(F.col("p_partkey").cast("string")).alias("sku"))
    return snippets.expand_queries(part, spark.createDataFrame(TEMPLATES, "plan_idx int, label string, scope string, query string"), SUPPLIERS)


def source_numbering(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "lang", (F.col("doc_id") % 50).alias("grp"), F.col("source").alias("label"))
    return snippets.number_sources(rows, ["grp"], "label", ["doc_id"]).select("doc_id", "grp", "source")


def drop_counters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("grp", F.col("page_id") % 10)
    h = urls.host(F.col("url"))
    return snippets.drop_counters(pages, ["grp"], urls.on_site(F.col("url"), F.lit("com")), urls.within_any(h, ["example.com"]))


def mostly_failed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return snippets.mostly_failed(e.where("event_type = 'view'").withColumn("label", F.col("event_id") % 3), e.where("event_type = 'error'"), "user_id")


def splice_trim(spark, sf_dir):
    cut = snippets.trim_splices(_docs(spark, sf_dir).select("doc_id", F.col("text").alias("body")), table(spark, sf_dir, "benchmark").select(F.col("text").alias("segment")), [], segments_needed=1)
    return cut.select("doc_id", "spliced", F.length("body").alias("n"))


def splice_trim_two(spark, sf_dir):
    """Texts that get no, one or two passages of the benchmark at their end, some of them single words of any length; two different ones make a splice."""
    passages = table(spark, sf_dir, "benchmark").select("item_id", F.when(F.col("item_id") % 3 == 0, F.regexp_replace("text", r"\s", "")).otherwise(F.col("text")).alias("segment"))
    n = passages.count()
    got = lambda i, name: passages.select(F.col("item_id").alias(i), F.col("segment").alias(name))
    docs = _docs(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("body"), F.when(F.col("doc_id") % 3 > 0, F.pmod("doc_id", F.lit(n))).alias("i"), F.when(F.col("doc_id") % 3 == 2, F.pmod(F.col("doc_id") * 7 + 1, F.lit(n))).alias("j"))
    docs = docs.join(got("i", "one"), "i", "left").join(got("j", "two"), "j", "left")
    rows = docs.select("doc_id", F.concat_ws("; ", "body", "one", "two").alias("body"))
    cut = snippets.trim_splices(rows, passages.select("segment"), [])
    return cut.select("doc_id", "spliced", F.length("body").alias("n"), F.md5("body").alias("body_md5"))


def gathered_snippets(spark, sf_dir):
    """Every rule from results to snippets in turn: pages as results of products, some of one URL, some blocked, some prices or empty, some with one text."""
    k = F.col("page_id")
    words = [F.concat(F.lit(w), F.translate((k / 40).cast("long").cast("string"), "0123456789", "abcdefghij")) for w in SNIPPET_WORDS]
    told = F.concat(F.concat_ws(" ", *words), F.when(k % 2 == 0, "  All rights reserved. ").otherwise(" "))
    body = F.when(k % 9 == 0, "12.99 $").when(k % 11 == 0, F.lit(None).cast("string")).when(k % 17 == 0, " ").otherwise(told)
    url = F.when(k % 5 == 0, F.regexp_replace("url", "[0-9]+.*$", "/")).otherwise(F.col("url"))
    rows = table(spark, sf_dir, "pages").select((k % 20).alias("product"), (k % 10).alias("plan_idx"), k.alias("pos"), F.concat(F.lit("q"), k % 3).alias("label"), F.lit("*").alias("scope"), url.alias("url"), body.alias("body"))
    return snippets.gather_snippets(rows, "product", PHRASES, SENTENCES, blocked=["net"], ad_hosts=["shop.example.com"]).select("product", "plan_idx", "pos", "source", "url", "domain", F.md5("body").alias("body_md5"))


def near_dup_pairs(spark, sf_dir):
    pairs = snippets.near_duplicate_pairs(_docs(spark, sf_dir), "doc_id", "text", 0.9)
    return pairs.select("id", "other", F.round("jaccard", 6).alias("jaccard"))


def near_dup_greedy(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "lang", "source", F.col("text").alias("body"))
    return snippets.near_duplicates(rows, ["lang", "source"], "body", ["doc_id"]).select("doc_id", "is_dup")


def pick_diverse(spark, sf_dir):
    docs = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = docs.select("doc_id", "lang", "source", (F.col("doc_id") % 20).alias("grp"), F.coalesce("quality", F.lit(0)).alias("quality"), "n_chars")
    rank = [F.col("quality").desc(), F.col("n_chars").desc(), F.col("doc_id")]
    picked = selection.pick_diverse(rows, ["lang", "grp"], "source", rank, F.col("source") == "src3")
    return picked.select("doc_id", "lang", "grp", "pass", "pick_no")


def build_context(spark, sf_dir):
    rows = _docs(spark, sf_dir).select((F.col("doc_id") % 40).alias("grp"), "doc_id", "source", (F.col("n_chars") % 100).alias("match_score"), F.col("text").alias("body"))
    rows = rows.where("match_score >= 70")
    picked = selection.pick_diverse(rows.drop("body"), ["grp"], "source", [F.col("match_score").desc(), F.col("doc_id")])
    return selection.build_context(selection.join_picks(picked, rows, ["doc_id"]), ["grp"]).select("grp", F.size("blocks").alias("n_blocks"), F.md5("web_context").alias("context_md5"))


def context_blocks(spark, sf_dir):
    rows = _docs(spark, sf_dir).select((F.col("doc_id") % 40).alias("grp"), "doc_id", F.concat(F.col("source"), F.lit(" #"), F.col("doc_id") % 3).alias("source"), (F.col("n_chars") % 100).alias("match_score"), F.lit("one line").alias("body"))
    picked = selection.pick_diverse(rows, ["grp"], "source", [F.col("match_score").desc(), F.col("doc_id")])
    made = selection.build_context(picked, ["grp"]).withColumn("parsed", selection.context_blocks(F.col("web_context")))
    n, families = selection.context_counts(F.col("parsed"))
    return made.select("grp", n.alias("n_blocks"), families.alias("n_families"))


def scored_view(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "source", F.when(F.col("doc_id") % 4 > 0, F.col("n_chars") % 100).alias("match_score"), F.col("doc_id").alias("pos"))
    return selection.scored_view(rows, ["source"]).select("doc_id", "source", "view_no")


def _names(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("alias")).where("length(alias) >= 6").distinct()
    return words.select(F.lit("term").alias("kind"), F.col("alias").alias("name"), "alias", F.lit(True).alias("is_name"), F.lit(0).alias("priority"))


def dictionary_facts(spark, sf_dir):
    found = dictionary.find_phrases(_docs(spark, sf_dir).select("doc_id", "text"), "text", dictionary.build_phrase_index(_names(spark, sf_dir)))
    return found.select("doc_id", F.size(dictionary.facts(F.col("matches"), "term")).alias("n_terms"), F.size("matches").alias("n_matches"))


def phrase_facts(spark, sf_dir):
    """Names of up to three words in all texts: the openings of documents, so the dictionary grows with them, and words of the benchmark."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    tokens = docs.select(dictionary.phrase_tokens(fold.fold(F.col("text"))).alias("t"))
    openings = tokens.select(F.explode(F.array(*[F.slice("t", 1, n) for n in (2, 3)])).alias("o")).where("NOT array_contains(o, '\n')").select(F.array_join("o", " ").alias("alias"))
    opening = openings.select(F.lit("opening").alias("kind"), F.upper("alias").alias("name"), "alias", F.lit(False).alias("is_name"), F.lit(1).alias("priority"))
    found = dictionary.find_names(docs, ["doc_id"], "text", dictionary.build_phrase_index(_names(spark, sf_dir).union(opening)))
    lists = dictionary.name_lists(found, ["doc_id"])
    named = docs.select("doc_id").join(lists, "doc_id", "left").withColumn("matches", F.coalesce("matches", F.array().cast("array<struct<pos:int,kind:string,name:string>>")))
    openings = F.size(dictionary.facts(F.col("matches"), "opening"))
    return named.select("doc_id", F.size("matches").alias("n_matches"), openings.alias("n_openings"), F.md5(F.array_join(F.transform("matches", lambda m: m["name"]), "|")).alias("names_md5"))


QUERIES = {f.__name__: f for f in (
    phrase_facts, fold_text, fold_latin, tokens_significant, clean_body, price_only, list_page_ratio, url_host, on_site, url_dedupe, url_slug_words, query_plan, source_numbering, drop_counters,
    mostly_failed, splice_trim, splice_trim_two, gathered_snippets, near_dup_pairs, near_dup_greedy, pick_diverse, build_context, context_blocks, scored_view, dictionary_facts,
)}

FOLD = r"trim(regexp_replace(lower(strip_accents(text)), '\s+', ' ', 'g'))"
HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '')"
PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)"
CLEAN = r"trim(regexp_replace(regexp_replace(" + "regexp_replace(" * len(PHRASES) + "text" + "".join(f", '{p}', ' ', 'gi')" for p in PHRASES) + r", '\S+@\S+\.\S+', ' ', 'gi'), '\s+', ' ', 'g'))"
PRICE = r"regexp_full_match({}, '[\d\s.,:;/()%+\-€£$]*')"
SETS = "(SELECT min(doc_id) AS id, w FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) AS w FROM documents) WHERE len(w) > 0 GROUP BY w)"

SQL = {
    "phrase_facts": r"""WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, regexp_extract_all(regexp_replace(""" + FOLD + r""", '[^a-z0-9 \-''’.]', chr(10), 'g'), '[a-z0-9]+|\n') AS w FROM documents),
a AS (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS alias, 0 AS pri FROM benchmark), b AS (SELECT alias, pri FROM a WHERE length(alias) >= 6),
o AS (SELECT array_to_string(w[1:n], ' ') AS alias, 1 AS pri FROM t, (VALUES (2), (3)) z(n) WHERE NOT list_contains(w[1:n], chr(10))),
d AS MATERIALIZED (SELECT alias, min(pri) AS pri FROM (SELECT * FROM b UNION ALL SELECT * FROM o WHERE length(alias) >= 5) WHERE regexp_matches(alias, '[a-z0-9]') GROUP BY 1),
u AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM t), v AS (SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS gram FROM u, (VALUES (1), (2), (3)) z(n) WHERE i + n <= len(w)),
m AS MATERIALIZED (SELECT doc_id, i, max(n) AS n FROM v JOIN d ON gram = alias GROUP BY ALL),
x AS MATERIALIZED (SELECT m.doc_id, m.i, m.n, y.i AS nxt FROM m ASOF LEFT JOIN m y ON m.doc_id = y.doc_id AND m.i + m.n <= y.i),
s AS (SELECT x.* FROM x WHERE (doc_id, i) IN (SELECT (doc_id, min(i)) FROM m GROUP BY doc_id) UNION ALL SELECT x.* FROM s JOIN x ON x.doc_id = s.doc_id AND x.i = s.nxt),
e AS (SELECT s.doc_id, s.i, pri, CASE pri WHEN 0 THEN alias ELSE upper(alias) END AS name FROM s JOIN t USING (doc_id) JOIN d ON alias = array_to_string(w[i + 1:i + s.n], ' ')),
g AS (SELECT doc_id, count(*)::INT AS n, count(DISTINCT name) FILTER (pri = 1)::INT AS k, md5(string_agg(name, '|' ORDER BY i)) AS h FROM e GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(k, 0) AS n_openings, coalesce(h, md5('')) AS names_md5 FROM documents LEFT JOIN g USING (doc_id)""",
    "fold_text": f"SELECT doc_id, md5({FOLD}) AS folded_md5 FROM documents",
    "fold_latin": f"SELECT doc_id, md5({FOLD}) AS folded_md5 FROM documents",
    "tokens_significant": f"""
SELECT doc_id, len(t)::INT AS n_tokens, md5(array_to_string(list_transform(list_sort(list_transform(list_distinct(t), lambda x: {{'p': list_position(t, x), 'w': x}})), lambda y: y.w), ' ')) AS tokens_md5
FROM (SELECT doc_id, list_transform(list_sort(list_transform(list_distinct(a), lambda x: {{'p': list_position(a, x), 'w': x}})), lambda y: y.w) AS t FROM (
  SELECT doc_id, list_filter(regexp_extract_all({FOLD}, '[a-z0-9]+'), lambda x: length(x) >= 4 AND NOT list_contains({list(STOPWORDS)}, x)) AS a FROM documents))""",
    "clean_body": f"SELECT doc_id, md5(c) AS clean_md5, length(c) >= 40 AND length(c) / greatest(1, length(text)) >= 0.4 AND NOT {PRICE.format('c')} AS keep FROM (SELECT doc_id, text, {CLEAN} AS c FROM documents)",
    "price_only": "SELECT conv_id, turn, " + PRICE.format("CASE WHEN turn % 2 = 0 THEN regexp_replace(text, '[^0-9., ]', '', 'g') ELSE text END") + " AS price_only FROM conversations",
    "list_page_ratio": r"""SELECT doc_id, len(w) >= 8 AND len(list_filter(w, lambda x: regexp_matches(x, '^\p{Lu}'))) >= len(w) * 0.7 AS is_list
FROM (SELECT doc_id, regexp_extract_all(text, '\p{L}[\p{L}''’\-]*') AS w FROM documents)""",
    "url_host": f"SELECT page_id, host, host IN ('example.com', 'net') OR ends_with(host, '.example.com') OR ends_with(host, '.net') AS blocked FROM (SELECT page_id, {HOST} AS host FROM pages)",
    "on_site": f"""SELECT page_id, CASE WHEN host = '' THEN FALSE WHEN page_id % 2 = 0 THEN NOT (host = 'net' OR ends_with(host, '.net'))
ELSE host = 'example.com' OR ends_with(host, '.example.com') END AS on_site FROM (SELECT page_id, {HOST} AS host FROM pages)""",
    "url_dedupe": r"""SELECT page_id, grp, url FROM (SELECT *, row_number() OVER (PARTITION BY grp, k ORDER BY page_id) AS rn FROM (
SELECT *, regexp_replace(lower(trim(url)), '/+$', '') AS k FROM (
SELECT page_id, page_id % 7 AS grp, CASE WHEN page_id % 11 = 0 THEN '' ELSE regexp_replace(url, '\?.*$', '') END AS url FROM pages))) WHERE rn = 1 OR k = ''""",
    "url_slug_words": f"""SELECT page_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(w), lambda x: {{'p': list_position(w, x), 'w': x}})), lambda y: y.w), ' ') AS slug FROM (
SELECT page_id, regexp_extract_all(lower(list_sort(list_transform(string_split({PATH}, '/'), lambda x, i: {{'n': -length(x), 'i': i, 'x': x}}))[1].x), '[a-z0-9]+') AS w FROM pages)""",
    "query_plan": "WITH t(plan_idx, label, scope, query) AS (VALUES " + ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, a, b, c in TEMPLATES) + """),
p AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 25 THEN lpad(p_partkey::VARCHAR, 9, '7') END AS sku,
  CASE WHEN contains(lower(p_name), 'cold') THEN 'cold.example.com' WHEN contains(lower(p_name), 'hot') THEN 'hot.example.com' END AS dist FROM part)
SELECT id, plan_idx, label, replace(scope, '{dist}', coalesce(dist, '')) AS scope, replace(replace(query, '{name}', name), '{sku}', coalesce(sku, '')) AS query
FROM p, t WHERE (NOT contains(query, '{sku}') OR sku IS NOT NULL) AND (NOT contains(scope, '{dist}') OR dist IS NOT NULL)""",
    "source_numbering": """SELECT doc_id, grp, CASE WHEN n > 1 THEN source || ' #' || i ELSE source END AS source FROM (
SELECT doc_id, doc_id % 50 AS grp, source, count(*) OVER (PARTITION BY doc_id % 50, source) AS n, row_number() OVER (PARTITION BY doc_id % 50, source ORDER BY doc_id) AS i FROM documents)""",
    "drop_counters": f"""SELECT grp, sum(CASE WHEN s THEN 0 ELSE 1 END)::BIGINT AS off_site, sum(CASE WHEN s AND b THEN 1 ELSE 0 END)::BIGINT AS blocked FROM (
SELECT page_id % 10 AS grp, host <> '' AND (host = 'com' OR ends_with(host, '.com')) AS s, host = 'example.com' OR ends_with(host, '.example.com') AS b FROM (SELECT page_id, {HOST} AS host FROM pages)) GROUP BY grp""",
    "mostly_failed": """WITH g AS (SELECT user_id, count(DISTINCT event_id % 3) AS answered FROM events WHERE event_type = 'view' GROUP BY 1),
b AS (SELECT user_id, count(*) AS failed FROM events WHERE event_type = 'error' GROUP BY 1),
j AS (SELECT user_id, coalesce(answered, 0) AS answered, coalesce(failed, 0) AS failed FROM g FULL JOIN b USING (user_id))
SELECT *, answered = 0 OR failed / (failed + answered) >= 0.5 AS mostly_failed FROM j""",
    "splice_trim": """WITH f AS (SELECT doc_id, min(strpos(d.text, b.text)) AS cut_at FROM documents d JOIN benchmark b ON length(d.text) >= 800 AND length(b.text) >= 80 AND length(b.text) < length(d.text) AND strpos(d.text, b.text) > 0 GROUP BY 1)
SELECT doc_id, cut_at IS NOT NULL AS spliced, length(CASE WHEN cut_at IS NULL THEN text ELSE rtrim(substr(text, 1, cut_at - 1)) END)::INT AS n FROM documents LEFT JOIN f USING (doc_id)
WHERE cut_at IS NULL OR length(rtrim(substr(text, 1, cut_at - 1))) >= 40""",
    "splice_trim_two": r"""WITH p AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN regexp_replace(text, '\s', '', 'g') ELSE text END AS segment, count(*) OVER () AS n FROM benchmark),
d AS (SELECT doc_id, concat_ws('; ', coalesce(text, ''), a.segment, b.segment) AS body FROM (SELECT *, (SELECT count(*) FROM benchmark) AS n FROM documents) x
  LEFT JOIN p a ON x.doc_id % 3 > 0 AND a.item_id = x.doc_id % x.n LEFT JOIN p b ON x.doc_id % 3 = 2 AND b.item_id = (x.doc_id * 7 + 1) % x.n),
f AS (SELECT doc_id, count(DISTINCT segment) AS n, min(strpos(body, segment)) AS cut_at FROM d, p WHERE length(body) >= 800 AND length(segment) >= 80 AND length(segment) < length(body) AND strpos(body, segment) > 0 GROUP BY 1),
c AS (SELECT doc_id, coalesce(f.n >= 2, FALSE) AS spliced, CASE WHEN f.n >= 2 THEN rtrim(substr(body, 1, cut_at - 1)) ELSE body END AS body FROM d LEFT JOIN f USING (doc_id))
SELECT doc_id, spliced, length(body)::INT AS n, md5(body) AS body_md5 FROM c WHERE NOT spliced OR length(body) >= 40""",
    "gathered_snippets": f"""WITH r AS (SELECT page_id, page_id % 20 AS product, page_id % 10 AS plan_idx, 'q' || page_id % 3 AS label, CASE WHEN page_id % 5 = 0 THEN regexp_replace(url, '[0-9]+.*$', '/') ELSE url END AS url,
  CASE WHEN page_id % 9 = 0 THEN '12.99 $' WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 17 = 0 THEN ' ' ELSE array_to_string(list_transform({list(SNIPPET_WORDS)}, lambda w: w || translate((page_id // 40)::VARCHAR, '0123456789', 'abcdefghij')), ' ')
    || CASE WHEN page_id % 2 = 0 THEN '  All rights reserved. ' ELSE ' ' END END AS text FROM pages),
f AS (SELECT *, {HOST} AS host, regexp_replace(lower(trim(url)), '/+$', '') AS k FROM r WHERE trim(text) <> ''),
d AS (SELECT *, row_number() OVER (PARTITION BY product, k ORDER BY plan_idx, page_id) AS rn FROM f WHERE host <> '' AND NOT (host = 'net' OR ends_with(host, '.net') OR host = 'shop.example.com' OR ends_with(host, '.shop.example.com'))),
n AS (SELECT *, count(*) OVER (PARTITION BY product, label) AS c, row_number() OVER (PARTITION BY product, label ORDER BY plan_idx, page_id) AS i, {CLEAN} AS clean FROM d WHERE rn = 1 OR k = ''),
g AS (SELECT *, row_number() OVER (PARTITION BY product, clean ORDER BY plan_idx, page_id) AS again FROM n WHERE length(clean) >= 40 AND length(clean) / length(text) >= 0.4 AND NOT {PRICE.format('clean')})
SELECT product, plan_idx, page_id AS pos, CASE WHEN c > 1 THEN label || ' #' || i ELSE label END AS source, url, host AS domain, md5(clean) AS body_md5 FROM g WHERE again = 1""",
    "near_dup_pairs": f"""WITH s AS {SETS}, p AS (
SELECT a.id, b.id AS other, len(list_intersect(a.w, b.w)) AS i, len(a.w) AS n, len(b.w) AS m FROM s a JOIN s b ON a.id < b.id AND least(len(a.w), len(b.w)) >= 0.9 * greatest(len(a.w), len(b.w)))
SELECT id, other, round(i / (n + m - i), 6) AS jaccard FROM p WHERE i / (n + m - i) >= 0.9
UNION ALL SELECT s.id, d.doc_id, 1.0 FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{{3,}}'))) AS w FROM documents) d JOIN s ON d.w = s.w AND d.doc_id > s.id""",
    "pick_diverse": """WITH r AS (SELECT doc_id, lang, source, doc_id % 20 AS grp, coalesce(quality, 0) AS q, n_chars FROM documents LEFT JOIN labels USING (doc_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY lang, grp, source ORDER BY q DESC, n_chars DESC, doc_id) AS fr FROM r),
p AS (SELECT *, CASE WHEN fr = 1 AND source = 'src3' THEN 1 WHEN fr = 1 THEN 2 ELSE 3 END AS pass FROM f)
SELECT doc_id, lang, grp, pass, pick_no FROM (SELECT *, row_number() OVER (PARTITION BY lang, grp ORDER BY pass, q DESC, n_chars DESC, doc_id)::INT AS pick_no FROM p) WHERE pick_no <= 5""",
    "build_context": """WITH r AS (SELECT doc_id % 40 AS grp, doc_id, source, n_chars % 100 AS s, text AS body FROM documents WHERE n_chars % 100 >= 70),
f AS (SELECT *, row_number() OVER (PARTITION BY grp, source ORDER BY s DESC, doc_id) AS fr FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY CASE WHEN fr = 1 THEN 2 ELSE 3 END, s DESC, doc_id) AS no FROM f)
SELECT grp, count(*)::INT AS n_blocks, md5(string_agg('[' || source || ' | match=' || s || ']' || chr(10) || body, chr(10) || chr(10) ORDER BY no)) AS context_md5 FROM k WHERE no <= 5 GROUP BY grp""",
    "context_blocks": """WITH r AS (SELECT doc_id % 40 AS grp, doc_id, source || ' #' || (doc_id % 3) AS source, n_chars % 100 AS s FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY grp, source ORDER BY s DESC, doc_id) AS fr FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY CASE WHEN fr = 1 THEN 2 ELSE 3 END, s DESC, doc_id) AS no FROM f)
SELECT grp, count(*)::INT AS n_blocks, count(DISTINCT regexp_replace(source, ' #.*', ''))::INT AS n_families FROM k WHERE no <= 5 GROUP BY grp""",
    "scored_view": """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY coalesce(CASE WHEN doc_id % 4 > 0 THEN n_chars % 100 END, -1) DESC, doc_id)::INT AS view_no FROM documents""",
    "dictionary_facts": r"""WITH a AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS alias FROM benchmark),
n AS (SELECT alias FROM a WHERE length(alias) >= 6),
w AS (SELECT doc_id, unnest(regexp_extract_all(""" + FOLD + r""", '[a-z0-9]+')) AS word FROM documents),
c AS (SELECT doc_id, count(DISTINCT word)::INT AS n_terms, count(*)::INT AS n_matches FROM w JOIN n ON word = alias GROUP BY doc_id)
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(n_matches, 0) AS n_matches FROM documents LEFT JOIN c USING (doc_id)""",
}
