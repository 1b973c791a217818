import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import dictionary, evidence, refdata, review, rules, scoring, selection, snippets, store, taxonomy
from sievework.plans import graph_queries
from sievework.sources import catalog, html_tables, sinks
from sievework.streaming import progress

RULES = [("category", "", "red"), ("vendor", "", "acme"), ("name", "", "gift card"), ("keyword", "beer", "pale ale"), ("keyword", "beer", "ale"), ("keyword", "food", "cheese")]


def test_cascade_order_and_audit(spark):
    rows = [(0, "Red", "acme", "pale ale"), (1, "Beer", "x", "y"), (2, "", "Acme Foods", "wine"), (3, None, "acmefoods", "Gift Card"), (4, "", "x", "a Pale  Ale x"), (5, "", "x", "saleable"), (6, "", None, None)]
    got = {r.id: r.decision for r in rules.rule_cascade(spark.createDataFrame(rows, "id int, c string, v string, n string"), RULES, "c", "v", "n").collect()}
    assert [(got[i].keep, got[i].stage, got[i].match, got[i].grp) for i in range(7)] == [
        (True, "category", "red", None), (False, "category", "beer", None), (False, "vendor", "acme", None), (False, "name", "gift card", None),
        (False, "keyword", "pale ale", "beer"), (True, "uncategorised", None, None), (True, "uncategorised", None, None),
    ]


def test_read_export_and_sinks(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_bytes(b'\xef\xbb\xbfID,Name,Product Category,Supplier-Name,Tax,Name\n1,a,"x ""q""",s,9,"b\nc"\n,,,,,\n2,d\n')
    df = catalog.read_export(spark, str(path), ["id", "name"], ["tax"])
    assert df.columns == ["id", "product_category", "supplier_name", "name"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", 'x "q"', "s", "b\nc"), ("2", None, None, None)]
    with pytest.raises(catalog.InputError):
        catalog.read_export(spark, str(path), ["sku"])
    with pytest.raises(catalog.InputError):
        catalog.read_export(spark, "x.xlsx")
    assert catalog.row_count(spark, str(path)) == 2
    assert catalog.newest_file(spark, str(tmp_path / "none"), str(tmp_path)).endswith("export.csv")
    decided = rules.rule_cascade(df, RULES, "product_category", "supplier_name", "name")
    sinks.write_decided(decided, str(tmp_path / "kept"), str(tmp_path / "out"))
    assert spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "out")).first()["excluded_by"] == "category"
    sinks.save_store(df, str(tmp_path / "store"), "1")
    assert sinks.load_store(spark, str(tmp_path / "store")).count() == 2


def test_typed_products(spark):
    df = spark.createDataFrame([(" ", "12.7", "3.9")], "name string, price string, sold string")
    assert tuple(catalog.load_products(df, ["price"], ["sold"]).first()) == (None, 12.7, 3)


def test_url_dedupe_keeps_first_and_blanks(spark):
    rows = [(1, 0, "http://A/x/"), (1, 1, "http://a/x"), (1, 2, ""), (1, 3, ""), (2, 4, "http://a/x")]
    got = snippets.url_dedupe(spark.createDataFrame(rows, "p int, i int, url string"), ["p"], ["i"])
    assert sorted(r.i for r in got.collect()) == [0, 2, 3, 4]


def test_near_duplicates_compare_with_kept_rows_only(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(1, 0, a), (1, 1, a + " eleven"), (1, 2, a + " eleven twelve"), (1, 3, ""), (1, 4, "")]
    got = {r.i: r.is_dup for r in snippets.near_duplicates(spark.createDataFrame(rows, "p int, i int, body string"), ["p"], "body", ["i"], jaccard=0.9).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False}  # row 2 is near row 1, which is itself a duplicate


def test_splices(spark):
    part = lambda w: " ".join(f"{w}{i}" for i in range(30))
    long = "an introduction that is long enough to keep by itself here " + part("aa") + " " + part("bb") + " " + part("cc") * 4
    rows = spark.createDataFrame([(1, "u1", long), (1, "u2", part("aa")), (1, "u3", part("bb"))], "p int, u string, body string")
    got = {r.u: (r.spliced, r.body) for r in snippets.trim_splices(rows, rows.select("p", F.col("body").alias("segment")), ["p"]).collect()}
    assert got["u1"] == (True, "an introduction that is long enough to keep by itself here") and not got["u2"][0]


def test_gather_snippets(spark):
    body = "a good long body about this wine and the place where it is made"
    rows = [(1, 0, 0, "q", "*", "http://a.com/1", body), (1, 0, 1, "q", "*", "http://b.com/1", body + " indeed so different words follow after it all"), (1, 1, 0, "r", "*", "http://A.com/1/", "again " + body),
            (1, 1, 1, "r", "c.com", "http://d.com/", body), (1, 1, 2, "r", "*", "http://bad.com/", body), (1, 1, 3, "r", "*", "http://e.com/", "12.99")]
    df = spark.createDataFrame(rows, "p int, plan_idx int, pos int, label string, scope string, url string, body string")
    got = snippets.gather_snippets(df, "p", blocked=["bad.com"]).orderBy("plan_idx", "pos").collect()
    assert [(r.url, r.source) for r in got] == [("http://a.com/1", "q #1"), ("http://b.com/1", "q #2")]


def test_phrases_leftmost_longest(spark):
    index = spark.createDataFrame([("region", "Picpoul de Pinet", "picpoul de pinet", 0), ("grape", "Picpoul", "picpoul", 1), ("grape", "Cabernet Sauvignon", "cabernet sauvignon", 1),
                                   ("grape", "Sauvignon Blanc", "sauvignon blanc", 1), ("region", "Txakoli", "txakoli", 0), ("grape", "Txakoli", "txakoli", 1)], "kind string, name string, alias string, priority int")
    rows = [(0, "Picpoul de Pinet"), (1, "Cabernet, Sauvignon Blanc"), (2, "Cabernet-Sauvignon Blanc"), (3, "Txakolí, picpoul"), (4, None)]
    got = {r.i: [(m["kind"], m["name"], m["pos"]) for m in r.matches] for r in dictionary.find_phrases(spark.createDataFrame(rows, "i int, t string"), "t", index).collect()}
    assert got == {0: [("region", "Picpoul de Pinet", 0)], 1: [("grape", "Sauvignon Blanc", 1)], 2: [("grape", "Cabernet Sauvignon", 0)], 3: [("region", "Txakoli", 0), ("grape", "Picpoul", 1)], 4: []}


def test_pick_diverse_passes(spark):
    rows = [("a #1", 90), ("a #2", 95), ("b (distributor)", 70), ("c", 80), ("a #3", 85), ("d", 75), ("c #2", 79)]
    df = spark.createDataFrame([(1, s, m) for s, m in rows], "p int, source string, m int").withColumn("family", selection.source_family(F.col("source")))
    got = selection.pick_diverse(df, ["p"], "family", [F.col("m").desc()], F.contains("source", F.lit("(distributor)")), 5).orderBy("pick_no").collect()
    assert [(r.source, r["pass"]) for r in got] == [("b (distributor)", 1), ("a #2", 2), ("c", 2), ("d", 2), ("a #1", 3)]


def test_context_round_trip(spark):
    df = spark.createDataFrame([(1, 1, "a #1", 90, "x\ny"), (1, 2, "a #2", 80, "z")], "p int, pick_no int, source string, match_score int, body string")
    made = selection.build_context(df, ["p"]).withColumn("b", selection.context_blocks(F.col("web_context"))).first()
    assert made.web_context == "[a #1 | match=90]\nx\ny\n\n[a #2 | match=80]\nz"
    assert [(b.source, b.body) for b in made.b] == [("a #1", "x\ny"), ("a #2", "z")]


def test_closure_leaves_cycles_out(spark):
    edges = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("z", "x")], "id string, parent_id string")
    got = {(r.ancestor, r.descendant): r.distance for r in taxonomy.closure(edges).collect()}
    assert got == {("a", "a"): 0, ("b", "b"): 0, ("c", "c"): 0, ("d", "d"): 0, ("a", "b"): 1, ("b", "c"): 1, ("c", "d"): 1, ("a", "c"): 2, ("b", "d"): 2, ("a", "d"): 3}
    assert {r.key for r in refdata.check_cycles(edges).collect()} == {"x", "y"}


def test_strip_classification(spark):
    rows = [("appellation margaux controlee",), ("d.o. rioja",), ("rioja doca (spain)",), ("chianti docg",), ("grand cru",)]
    got = [r.x for r in spark.createDataFrame(rows, "a string").select(taxonomy.strip_classification(F.col("a")).alias("x")).collect()]
    assert got == ["margaux", "rioja", "rioja", "chianti", ""]


def test_strips_to_a_fixpoint(spark):
    rows = [("rioja - doc", "rioja"), ("rioja doc aoc igt dop igp", "rioja"), ("grand cru vin de pays x (a) (b) d.o.c.", "x"), ("appellation d\u2019origine controlee margaux", "margaux"),
            ("(x)", ""), ("rioja (", "rioja ("), ("docks do", "docks"), ("a (b) c", "a (b) c"), ("", "")]
    got = spark.createDataFrame(rows, "a string, want string").select("a", "want", taxonomy.strip_classification(F.col("a")).alias("x")).collect()
    assert {r.a: r.x for r in got} == dict(rows)


def test_deep_chains(spark):
    edges = spark.createDataFrame([(i, i - 1 if i else None) for i in range(300)], "id int, parent_id int")
    assert taxonomy.closure(edges).count() == 300 * 301 // 2 and refdata.check_cycles(edges).count() == 0
    ring = spark.createDataFrame([(i, (i + 1) % 150) for i in range(150)] + [(i, i - 1) for i in range(500, 700)] + [(499, 3)], "id int, parent_id int")
    assert {int(r.key) for r in refdata.check_cycles(ring).collect()} == set(range(150))
    assert taxonomy.closure(ring).count() == 0


def test_origin(spark):
    cases = [
        ("napa valley", "grown in napa valley", "some wine", True), ("napa valley", "our shop based in napa valley", "some wine", False),
        ("beaune", "the hospices de beaune cuvee", "hospices de beaune cuvee", False), ("beaune", "the hospices de beaune cuvee", "hospices de beaune", True),
        ("ay", "made in ay", "x", False), ("rioja", "bodega based in oyon. a red wine from rioja", "faustino", True), ("baalbek", "38 km from baalbek", "chateau ka", False),
        ("barolo", "vajra barolo albe from barolo, piedmont", "vajra barolo albe", True), ("cotes du rhone", "a cotes-du-rhone, red", "x", True), ("napa", "situated (2 km) napa", "x", False),
        ("rioja", "", "rioja", False), ("rioja", "rioja", "rioja", True),
    ]
    df = spark.createDataFrame(cases, "a string, h string, n string, want boolean")
    got = df.select("*", evidence.named_as_origin(F.col("a"), F.col("h"), F.col("n")).alias("x")).collect()
    assert [(r.a, r.h, r.n, r.x) for r in got] == cases


def test_longer_regions_outweigh(spark):
    labels = spark.createDataFrame([("fr", "b", "brouilly", True), ("fr", "cb", "cote de brouilly", True), ("fr", "x", "grand brouilly", False)], "scope string, entity string, alias string, is_canonical boolean")
    tree = taxonomy.closure(spark.createDataFrame([("b", None), ("cb", None), ("x", None)], "id string, parent_id string"))
    leaves = spark.createDataFrame([(1, "b"), (2, "b")], "p int, region string")
    blocks = spark.createDataFrame([(1, "s", "a cote de brouilly"), (1, "t", "from brouilly"), (2, "s", "a cote de brouilly"), (2, "t", "brouilly"), (2, "u", "brouilly too")], "p int, family string, body string")
    names = spark.createDataFrame([(1, "some name"), (2, "some name")], "p int, name string")
    got = evidence.longer_regions(leaves, "p", "region", labels, tree, blocks, names).collect()
    assert [(r.p, r.longer, r.n, r.leaf_n) for r in got] == [(1, "cb", 1, 1)]


def test_longer_regions_meet_what_texts_hold(spark, monkeypatch):
    """A common word is in many names; only those that a row's texts hold are looked for in them."""
    many = [("fr", f"n{i}", f"hill number{i}", True) for i in range(200)]
    labels = spark.createDataFrame([("fr", "h", "hill", True), *many], "scope string, entity string, alias string, is_canonical boolean")
    tree = taxonomy.closure(spark.createDataFrame([(x[1], None) for x in labels.collect()], "id string, parent_id string"))
    leaves = spark.createDataFrame([(i, "h") for i in range(5)], "p int, region string")
    blocks = spark.createDataFrame([(i, "s", f"a hill  number{i}, red") for i in range(5)], "p int, family string, body string")
    names = spark.createDataFrame([(i, "some name") for i in range(5)], "p int, name string")
    asked, counts = [], evidence.origin_counts
    monkeypatch.setattr(evidence, "origin_counts", lambda c, *a, **b: asked.append(c.count()) or counts(c, *a, **b))
    got = evidence.longer_regions(leaves, "p", "region", labels, tree, blocks, names).collect()
    assert sorted((r.p, r.longer, r.n, r.leaf_n) for r in got) == [(i, f"n{i}", 1, 0) for i in range(5)] and max(asked) == 5


def test_variants_are_made_in_many_tasks(spark):
    """A small file of many rows is one task's to read; spelling its labels is not."""
    got = graph_queries.region_variants(spark, "/root/testdata/sf0.001")
    assert spark.read.parquet("/root/testdata/sf0.001/part.parquet").rdd.getNumPartitions() == 1 < got.rdd.getNumPartitions()


def test_scorer_batches_cross_slices(spark, monkeypatch):
    """Few rows at a time become Python objects, and the scorer still gets a product's rows in full batches."""
    monkeypatch.setattr(scoring, "SLICE", 3)
    rows = spark.createDataFrame([(p, i, "n", f"b{i}") for p in ("x", None, "y") for i in range(20)], "product_id string, i int, name string, body string")
    got = scoring.score_batches(rows.repartition(3), lambda name, bodies: {j: (len(bodies), [b]) for j, b in enumerate(bodies)}).collect()
    assert {(r.product_id, r.i): (r.score, r.facts) for r in got} == {(p, i): (8 if i < 16 else 4, [f"b{i}"]) for p in ("x", None, "y") for i in range(20)} and len(got) == 60


def test_table_rows_leave_in_parts(spark, monkeypatch):
    """Rows of tables go out a few at a time, whatever a batch of pages holds."""
    monkeypatch.setattr(html_tables, "ROWS", 4)
    pages = spark.createDataFrame([(i, None if i == 3 else "<table>" + f"<tr><td>{i}</td></tr>" * i + "</table>") for i in range(12)], "p long, h string").coalesce(1)
    got = html_tables.html_tables(pages, "h", ["p"]).collect()
    assert sorted((r.p, r.table_no, r.row_no, r.cells) for r in got) == [(i, 0, k, [str(i)]) for i in range(12) if i != 3 for k in range(i)]


def test_leaves_finer_and_longer(spark):
    tree = taxonomy.closure(spark.createDataFrame([("r", None), ("s", "r"), ("t", "s")], "id string, parent_id string"))
    claims = spark.createDataFrame([(1, "r"), (1, "s"), (2, "r")], "p int, region string")
    leaves = evidence.submitted_leaves(claims, "p", "region", tree)
    assert {(r.p, r.region) for r in leaves.collect()} == {(1, "s"), (2, "r")}
    counts = spark.createDataFrame([(1, "t", 2), (1, "s", 3), (2, "s", 2), (2, "t", 2)], "p int, region string, n_sources int")
    finer = evidence.finer_regions(leaves, "p", "region", tree, counts)
    assert {(r.p, r.finer) for r in finer.collect()} == {(1, "t"), (2, "s"), (2, "t")}
    assert {(r.p, r.replacement) for r in evidence.region_from_sources(finer, "p", tree).collect()} == {(2, "t")}
    names = evidence.name_region(spark.createDataFrame([(1, "s"), (1, "t")], "p int, region string"), "p", "region", tree)
    assert names.first().region == "t"
    rows = evidence.region_from_name(spark.createDataFrame([("r", "t"), ("t", "s"), ("s", "q"), ("s", None)], "c string, n string"), "c", "n", tree)
    assert {(r.c, r.n): r.name_verdict for r in rows.collect()} == {("r", "t"): "upgrade", ("t", "s"): "agree", ("s", "q"): "conflict", ("s", None): None}
    labels = spark.createDataFrame([("fr", "a", "chablis"), ("fr", "b", "petit chablis"), ("us", "c", "petit chablis")], "scope string, entity string, alias string")
    assert [tuple(r) for r in evidence.longer_names(labels).collect()] == [("fr", "a", "b")]


def test_edits_distinguish_unset_from_null(spark):
    rows = spark.createDataFrame([(1, "a", "model"), (2, "b", "model"), (3, "c", "model")], "id int, note string, tag_status string")
    edits = spark.createDataFrame([(1, None, None, ["note"]), (2, None, "pending", ["tag_status"])], "id int, note string, tag_status string, present array<string>")
    assert {tuple(r) for r in store.apply_edits(rows, edits, "id", ["note", "tag_status"]).collect()} == {(1, None, "human"), (2, "b", "pending"), (3, "c", "model")}


def test_parse_reply(spark):
    rows = [('x {"1": 140, "2": {"score": "70", "facts": ["region", "grape", "zzz"]}, "3": "bad"} y',), ("none",), (None,)]
    got = [r.x for r in spark.createDataFrame(rows, "a string").select(scoring.parse_reply(F.col("a")).alias("x")).collect()]
    assert {k: (v.score, v.facts) for k, v in got[0].items()} == {"1": (100, []), "2": (70, ["grape", "region"])} and got[1:] == [None, None]


def test_reask_marks_what_stays_out(spark):
    df = spark.createDataFrame([(1, i, "red wine", "red wine here") for i in range(10)], "product_id int, i int, name string, body string")
    never = lambda name, bodies: {}
    got = scoring.reask_missing(df, ["product_id", "i"], [never, never]).collect()
    assert len(got) == 10 and all(r.unscored and r.score == 0 for r in got)


def test_html_tables():
    assert html_tables.table_rows("<table><tr><th>A<td>b &amp; <b>c</b></td></tr><tr></tr></table>")[0]["cells"] == ["A", "b & c"]
    assert html_tables.table_rows(None) == []


def test_progress_ignores_replays(spark):
    ev = [("r", "run_plan", 1.0, None, None, None), ("r", "phase_start", 2.0, "search", None, 3), ("r", "progress", 3.0, "search", 0, 3), ("r", "progress", 3.0, "search", 0, 3),
          ("r", "progress", 4.0, "search", 2, 3), ("r", "phase_end", 5.0, "search", None, 3), ("r", "phase_start", 6.0, "score", None, 3), ("r", "progress", 7.0, "score", 0, 3), ("r", "error", 8.0, None, None, None)]
    df = spark.createDataFrame(ev, "run_id string, type string, ts double, phase string, index int, total int")
    assert {r.phase: (r.state, r.done) for r in progress.progress(df).collect()} == {"search": ("done", 3), "score": ("stopped", 1)}


def _folded(events):
    """The bars of one run, event by event."""
    bars, order = {p: ["pending", 0, 0, True] for p in progress.PHASES}, list(progress.PHASES)
    for kind, phase, index, total, cursor, resume, stop in events:
        if kind == "run_plan":
            first = order.index(resume or "search")
            last = order.index(stop) if stop and order.index(stop) >= first else 2
            bars = {p: ["done", total, total, i <= last] if i < first else ["pending", min(cursor, total) if i == first else 0, total, i <= last] for i, p in enumerate(order)}
        elif kind in ("error", "exit"):
            for b in bars.values():
                b[0] = "stopped" if b[0] == "running" else b[0]
        elif phase and bars[phase][0] != "done":
            b = bars[phase]
            if kind == "phase_end":
                b[:2] = "done", max(b[1], b[2])
            elif kind in ("phase_start", "wine_start", "progress"):
                b[0], b[2] = "running", b[2] if total is None else total
                b[1] = max(b[1], index + 1) if kind == "progress" else b[1]
    return {p: tuple(b) for p, b in bars.items()}


def test_run_bars_fold_any_events(spark):
    rng, rows, want = random.Random(5), [], {}
    kinds = ["phase_start", "wine_start", "progress", "progress", "progress", "phase_end", "paused", "error", "exit"]
    for run in range(60):
        events = []
        for _ in range(rng.randrange(1, 25)):
            kind = "run_plan" if rng.random() < 0.12 else rng.choice(kinds)
            plan = kind == "run_plan"
            phase = None if plan or kind in ("error", "exit") else rng.choice(progress.PHASES)
            events.append((kind, phase, rng.randrange(6), rng.randrange(3, 8) if plan or rng.random() < 0.7 else None, rng.randrange(9), rng.choice(progress.PHASES), rng.choice([None, *progress.PHASES])))
        want[run] = _folded(events)
        rows += [(run, float(i), *e, "x") for i, e in enumerate(events)] * rng.randrange(1, 3)
    df = spark.createDataFrame(rows, "run_id int, ts double, type string, phase string, index int, total int, cursor int, resume_phase string, stop_after string, name string")
    got = {}
    for r in progress.run_bars(df).collect():
        got.setdefault(r.run_id, {})[r.phase] = (r.state, r.done, r.total, r.in_run)
    assert got == want
    assert {r.state for r in progress.run_bars(df, live=False).collect()} <= {"pending", "done", "stopped"}
    assert progress.run_bars(df.limit(0)).count() == 0


def test_fold_state_is_order_free_within_a_batch():
    rows = [(3, "click", 3), (1, "signup", 1), (2, "click", 2), (4, "purchase", 4), (5, "click", 5)]
    assert progress.fold_state(rows, None) == {"done": 2, "ended": 1, "errors": 0}


def test_score_and_assemble(spark):
    row = lambda pos, body, url, source, category="red": (1, pos, "chateau margaux", category, ["chateau", "margaux"], ["chateau", "margaux"], (body + " " + url).lower(), body, url, source, 1, 1)
    rows = [row(0, "chateau margaux is a fine wine", "http://a.com/1", "a #1"), row(1, "chateau margaux again", "http://b.com/x-white", "b"), row(2, "some other producer", "http://c.com", "c"),
            row(3, "results for chateau margaux", "http://d.com", "d"), row(4, "the chateau", "http://e.com/", "e"), row(5, "chateau margaux too", "http://f.com", "f (distributor)")]
    df = spark.createDataFrame(rows, "product_id int, pos int, name string, category string, tokens array<string>, own array<string>, hay string, body string, url string, source string, n_grapes int, n_regions int")
    every, context = scoring.score_and_assemble(df, [scoring.lexical_scorer], "results for (.+)", {"red": ["white"]})
    assert {r.pos: (r.dropped_reason, r.match_score) for r in every.collect()} == {
        0: (None, 100), 1: ("colour_conflict", 0), 2: ("producer_absent", 0), 3: ("search_page", 0), 4: (None, 50), 5: (None, 100)}
    assert [b.source for b in context.first().blocks] == ["f (distributor)", "a #1"]


def test_lookup_and_hints(spark):
    dims = spark.createDataFrame([("margaux", "2", "Margaux", "France", True, 0), ("ch margaux", "2", "Margaux", "France", True, 1), ("bordeaux", "1", "Bordeaux", "France", True, 0), ("odd", "3", "Odd", "Spain", False, 0)],
                                 "label_fold string, entity string, name string, scope string, is_canonical boolean, rank int")
    tree = taxonomy.closure(spark.createDataFrame([("1", None), ("2", "1"), ("3", None)], "id string, parent_id string"))
    got = {r.l: r for r in taxonomy.lookup(spark.createDataFrame([("ch margaux",), ("odd",), ("zzz",)], "l string"), "l", dims, tree).collect()}
    assert got["ch margaux"].canonical == "Margaux" and got["ch margaux"].parents == ["Bordeaux"] and got["ch margaux"].synonyms == ["ch margaux"] and got["ch margaux"].is_placeholder is False
    assert got["odd"].is_placeholder is True and got["zzz"].known is False and got["zzz"].parents is None
    countries = spark.createDataFrame([("france", "f", "France", "", True, 0)], "label_fold string, entity string, name string, scope string, is_canonical boolean, rank int")
    grapes = spark.createDataFrame([("merlot", "m", "Merlot", "", True, 0), ("syrah", "s", "Syrah", "", True, 0)], "label_fold string, entity string, name string, scope string, is_canonical boolean, rank int")
    rows = [(1, "france", ["ch margaux"], ["merlot"], None, None, 90, "red"), (2, "atlantis", ["nowhere", "france", "odd"], ["red blend", "zzz"], None, None, 90, "pink"),
            (3, None, ["margaux"], ["merlot", "syrah", "merlot"], False, True, 90, None), (4, "france", ["odd"], [], None, None, 90, "red")]
    df = spark.createDataFrame(rows, "id int, country string, region array<string>, grapes array<string>, is_blend boolean, organic boolean, confidence int, category string")
    out = {r.id: r for r in taxonomy.canonicalise(df, "id", countries, dims, grapes, tree, {"red": "red"}, ["blend"]).collect()}
    assert out[1].ok and out[1].normalized.region == ["Margaux", "Bordeaux"] and out[1].normalized.country == "France" and out[1].warnings == []
    assert out[2].hints == ["unknown_country: atlantis", "country_in_region_slot: france", "unknown_region: nowhere", "non_canonical_region: odd", "phrase_grapes: red blend", "non_canonical_grape: zzz", "unknown_category: pink"]
    assert out[3].issues == ["is_blend_mismatch"] and out[3].normalized.country == "France" and out[3].normalized.grapes == ["Merlot", "Syrah"] and out[3].normalized.organic
    assert out[4].issues == ["non_canonical_region", "region_country_mismatch"] and out[4].warnings == ["empty_grapes"]


def test_shares_and_blends(spark):
    rows = [("60% merlot and 40 % syrah",), ("merlot (60%)",), ("merlot is good, 13% alcohol",), ("merlot",)]
    got = [r.x for r in spark.createDataFrame(rows, "b string").select(evidence.has_share(F.col("b"), F.lit("merlot")).alias("x")).collect()]
    assert got == [True, True, False, False]
    df = spark.createDataFrame([(1, ["a", "b"], ["a", "b"], False, False), (2, ["a", "b"], ["a", "b", "c"], False, False), (3, ["a", "b"], ["a", "b", "c"], False, True), (4, ["a"], ["a"], False, True), (5, ["a", "b"], ["a", "b"], True, True)],
                               "p int, g array<string>, n array<string>, part boolean, shares boolean")
    assert {r.p: r.named_whole for r in evidence.blend_named_whole(df, "p", "g", "n", "part", "shares").collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}
    white = evidence.white_grapes_only(F.col("c"), F.col("k"), F.col("n"), ["pinot gris"])
    rows = [("red", ["white"], ["riesling"]), ("rose", ["white"], ["pinot gris"]), ("white", ["white"], ["riesling"]), ("red", ["white", None], ["riesling", "x"]), ("red", [], [])]
    assert [r.x for r in spark.createDataFrame(rows, "c string, k array<string>, n array<string>").select(white.alias("x")).collect()] == [True, False, False, False, False]


def test_review_upgrades_before_it_checks(spark):
    edges = [("piedmont", None), ("barolo", "piedmont"), ("langhe", "piedmont"), ("beaujolais", None), ("brouilly", "beaujolais"), ("cote de brouilly", "beaujolais")]
    tree = taxonomy.closure(spark.createDataFrame(edges, "id string, parent_id string"))
    labels = spark.createDataFrame([("it" if i < 3 else "fr", e, e, True) for i, (e, _) in enumerate(edges)], "scope string, entity string, alias string, is_canonical boolean")
    row = lambda i, name, regions, conf=90, submitted=True, blend=False, grapes=("nebbiolo",), category="red", colour="red": (
        i, name, category, None, submitted, blend, conf, list(grapes), [colour] * len(grapes), regions, False)
    rows = spark.createDataFrame(
        [row(1, "neirano barolo", ["piedmont"]), row(2, "plain wine", ["piedmont"]), row(3, "pav brouilly", ["brouilly", "beaujolais"]), row(4, "gran barolo", ["brouilly", "beaujolais"]),
         row(5, "plain", ["langhe", "piedmont"], grapes=("merlot",)), row(6, "plain", [], submitted=False), row(7, "plain", ["piedmont"]), row(8, "plain", ["piedmont"], blend=True, colour="white"),
         row(9, "plain", None, conf=70, grapes=()), row(10, "plain", ["piedmont", "utopia"])],
        "row int, name string, category string, scope string, submitted boolean, is_blend boolean, confidence int, grapes array<string>, colours array<string>, regions array<string>, named_whole boolean",
    )
    said = {1: ["barolo nebbiolo", "a nebbiolo"], 2: ["from barolo, nebbiolo", "the barolo style"], 3: ["cote de brouilly nebbiolo", "cote-de-brouilly"], 4: ["nebbiolo", "nebbiolo"], 5: ["langhe wine"],
            6: ["x"], 8: ["piedmont", "nebbiolo of piedmont"], 9: ["x", None], 10: ["piedmont and barolo nebbiolo", "langhe or barolo", "langhe nebbiolo"]}
    blocks = spark.createDataFrame([(i, f"f{j}", b) for i, bodies in said.items() for j, b in enumerate(bodies)], "row int, family string, body string")
    grapes = spark.createDataFrame([("nebbiolo", "spanna")], "claim string, alias string")
    got = {r.row: (r.regions, r.reasons, r.confidence, r.status) for r in review.review(rows, blocks, grapes, labels, tree).collect()}
    assert got == {
        1: (["barolo", "piedmont"], [], 90, "model"),
        2: (["barolo", "piedmont"], [], 90, "model"),
        3: (["cote de brouilly", "beaujolais"], [], 90, "model"),
        4: (["brouilly", "beaujolais"], ["name_region_conflict:barolo", "unsupported_region:brouilly"], 90, "needs_review"),
        5: (["langhe", "piedmont"], ["single_source", "unsupported_grape:merlot"], 69, "needs_review"),
        6: ([], ["no_submit"], 69, "needs_review"),
        7: (["piedmont"], ["no_context"], 90, "needs_review"),
        8: (["piedmont"], ["uncorroborated_grape:nebbiolo", "incomplete_blend", "white_grapes_only"], 90, "needs_review"),
        9: ([], ["no_grapes", "low_confidence"], 70, "needs_review"),
        10: (["piedmont", "utopia"], ["coarse_region:barolo", "coarse_region:langhe"], 90, "needs_review"),
    }
    told = {r.row: r.reasons for r in review.review(rows, blocks, grapes, labels, tree, review_upgrades=True).where("row < 4").collect()}
    assert told == {1: ["region_from_name:piedmont→barolo"], 2: ["region_from_sources:piedmont→barolo"], 3: ["region_from_sources:brouilly→cote de brouilly"]}
    assert review.review(rows.limit(0), blocks, grapes, labels, tree).count() == 0


def test_corroboration_counts_families_and_phrases(spark):
    claims = spark.createDataFrame([(1, "merlot"), (1, "pinot noir"), (1, "syrah"), (2, "merlot")], "p int, claim string")
    aliases = spark.createDataFrame([("pinot noir", "spatburgunder"), ("syrah", "shiraz"), ("merlot", "mer")], "claim string, alias string")
    blocks = spark.createDataFrame([(1, "a", "a merlot, and pinot-noir"), (1, "a", "merlot again mer"), (1, "b", "spatburgunder"), (1, "c", "pinot of noir merlots"), (2, "a", "nothing")], "p int, family string, body string")
    got = {(r.p, r.claim): r.n_sources for r in evidence.corroboration(claims, blocks, aliases, "p").collect()}
    assert got == {(1, "merlot"): 1, (1, "pinot noir"): 2, (1, "syrah"): 0, (2, "merlot"): 0}


def most_rows(df, node, metric):
    """The largest figure of a kind of step in the plan by which ``df`` ran."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if "QueryStage" in plan.nodeName() or plan.nodeName() == "AdaptiveSparkPlan":
            todo.append(plan.plan() if "QueryStage" in plan.nodeName() else plan.executedPlan())
            continue
        if node in plan.nodeName() and plan.metrics().contains(metric):
            most = max(most, plan.metrics().apply(metric).value())
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return most


def test_regions_go_up_from_what_is_named(spark):
    """Leaves are not multiplied by all that lies below them."""
    tree = taxonomy.cut(taxonomy.closure(spark.createDataFrame([("r", None), *[(f"c{i}", "r") for i in range(500)]], "id string, parent_id string")))
    leaves = spark.createDataFrame([(i, "r") for i in range(60)], "p int, region string")
    counts = spark.createDataFrame([(i, f"c{i}", i % 3) for i in range(50)], "p int, region string, n_sources int")
    finer, nowhere = evidence.finer_regions(leaves, "p", "region", tree, counts), evidence.unsupported_regions(leaves, "p", "region", tree, counts)
    assert most_rows(finer, "Join", "numOutputRows") <= 100 and most_rows(nowhere, "Join", "numOutputRows") <= 100
    assert {(r.p, r.finer, r.n, r.leaf_n) for r in finer.collect()} == {(i, f"c{i}", i % 3, 0) for i in range(50) if i % 3}
    assert {r.p for r in nowhere.collect()} == {i for i in range(60) if i >= 50 or i % 3 == 0}


def test_claims_go_up_to_find_leaves(spark):
    """A claimed region is not multiplied by all that lies below it."""
    tree = taxonomy.cut(taxonomy.closure(spark.createDataFrame([("r", None), *[(f"c{i}", "r") for i in range(500)]], "id string, parent_id string")))
    claims = spark.createDataFrame([(i, x) for i in range(60) for x in (("r", f"c{i}") if i % 2 else ("r",))] + [(1, "r"), (60, "other")], "p int, region string")
    leaves = evidence.submitted_leaves(claims, "p", "region", tree)
    assert most_rows(leaves, "Join", "numOutputRows") <= 100
    assert sorted((r.p, r.region) for r in leaves.collect()) == sorted([(i, f"c{i}" if i % 2 else "r") for i in range(60)] + [(60, "other")])


@pytest.mark.parametrize("few", [True, False])
def test_words_that_no_alias_has_stay_where_they_are_read(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(evidence, "BROADCAST_ROWS", 0, raising=False)
    claims = spark.createDataFrame([(i, c) for i in range(20) for c in ("merlot", "pinot noir")], "p int, claim string")
    blocks = spark.createDataFrame([(i, f"f{j}", " ".join(f"w{j}x{k}" for k in range(200)) + " merlot, pinot-noir") for i in range(20) for j in range(2)], "p int, family string, body string")
    got = evidence.corroboration(claims, blocks, spark.createDataFrame([("zinfandel", "primitivo di manduria")], "claim string, alias string"), "p")
    assert {(r.p, r.claim): r.n_sources for r in got.collect()} == {(i, c): 2 for i in range(20) for c in ("merlot", "pinot noir")}
    assert not few or most_rows(got, "Exchange", "shuffleRecordsWritten") <= 100


def test_review_splits_texts_once_and_in_many_tasks(spark, monkeypatch):
    """A small file of many texts is one task's to read; splitting them is not, and is not done for each use of them."""
    tasks, splits, held, runs = [], [], review.stored, evidence.word_runs
    monkeypatch.setattr(evidence, "word_runs", lambda *a: splits.append(a) or runs(*a))

    def keep(df, *a):
        if set(df.columns) == {"row", "family", "body"}:
            tasks.append(df.rdd.getNumPartitions())
        return held(df, *a)

    monkeypatch.setattr(review, "stored", keep)
    rows = spark.range(100).coalesce(1).selectExpr(
        "CAST(id AS INT) AS row", "'plain wine' AS name", "'red' AS category", "CAST(null AS STRING) AS scope", "true AS submitted", "false AS is_blend", "90 AS confidence", "array('nebbiolo') AS grapes",
        "array('red') AS colours", "array('piedmont') AS regions", "false AS named_whole")
    blocks = rows.selectExpr("row", "explode(array('f1', 'f2')) AS family", "IF(row % 2 = 0, 'barolo nebbiolo', 'nebbiolo of piedmont') AS body")
    labels = spark.createDataFrame([("it", e, e, True) for e in ("piedmont", "barolo")], "scope string, entity string, alias string, is_canonical boolean")
    tree = taxonomy.closure(spark.createDataFrame([("piedmont", None), ("barolo", "piedmont")], "id string, parent_id string"))
    got = review.review(rows, blocks, spark.createDataFrame([("nebbiolo", "spanna")], "claim string, alias string"), labels, tree).collect()
    assert {(r.row, *r.regions, *r.reasons, r.status) for r in got} == {(i, *(["barolo"] if i % 2 == 0 else []), "piedmont", "model") for i in range(100)}
    assert tasks == [4] and len(splits) <= 3


def test_review_broadcasts_dictionaries_only(spark, monkeypatch):
    """What grows with the rows joins by shuffle, however small Spark takes its files for; and no step is a long chain of joins."""
    sent, joins, held = [], [], evidence.stored

    def keep(df, *a):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        sent.append(most_rows(df, "BroadcastExchange", "numOutputRows"))
        return held(df, *a)

    monkeypatch.setattr(evidence, "stored", keep)
    monkeypatch.setattr(review, "stored", keep)
    rows = spark.range(200).selectExpr(
        "CAST(id AS INT) AS row", "IF(id % 4 = 0, 'wine of barolo', 'plain wine') AS name", "'red' AS category", "CAST(null AS STRING) AS scope", "true AS submitted", "false AS is_blend", "90 AS confidence",
        "array('nebbiolo') AS grapes", "array('red') AS colours", "IF(id % 4 = 1, array('langhe', 'piedmont'), array('piedmont')) AS regions", "false AS named_whole")
    blocks = rows.selectExpr("row", "explode(array('f1', 'f2')) AS family", "CASE row % 4 WHEN 2 THEN 'barolo nebbiolo' WHEN 1 THEN 'langhe alta nebbiolo' ELSE 'nebbiolo of piedmont' END AS body")
    edges = [("piedmont", None), ("barolo", "piedmont"), ("langhe", "piedmont"), ("langhe alta", None)]
    labels = spark.createDataFrame([("it", e, e, True) for e, _ in edges], "scope string, entity string, alias string, is_canonical boolean")
    tree = taxonomy.closure(spark.createDataFrame(edges, "id string, parent_id string"))
    out = review.review(rows, blocks, spark.createDataFrame([("nebbiolo", "spanna")], "claim string, alias string"), labels, tree)
    sent.append(most_rows(out, "BroadcastExchange", "numOutputRows"))
    assert out.count() == 200 and 0 < max(sent) <= 20
    assert max(*joins, out._jdf.queryExecution().optimizedPlan().toString().count("Join ")) <= 8
