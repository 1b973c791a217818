"""Interval labels against plain walks, scored links against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import linking, taxonomy


def forest(rng, n, kind):
    up = {}
    for i in range(n):
        if kind == "chain":
            up[i] = i - 1 if i else None
        elif kind == "star":
            up[i] = 0 if i else None
        else:
            up[i] = rng.choice([None, *range(max(0, i - 5), i)]) if i else None
    names = rng.sample(range(10 * n), n)
    return {f"n{names[i]:05d}": None if p is None else f"n{names[p]:05d}" for i, p in up.items()}


def ancestors(up, x):
    out = []
    while up.get(x) is not None:
        x = up[x]
        out.append(x)
        if len(out) > len(up):
            return None  # a cycle
    return out


@pytest.mark.parametrize("kind", ["chain", "star", "any"])
def test_intervals_say_what_is_below(spark, kind):
    rng = random.Random(4)
    up = forest(rng, 300 if kind == "chain" else 200, kind)
    edges = spark.createDataFrame(list(up.items()) * 2, "id string, parent_id string").repartition(5)
    rows = {r.id: r for r in taxonomy.tree_intervals(edges).collect()}
    above = {x: ancestors(up, x) for x in up}
    assert {x: (r.root, r.depth) for x, r in rows.items()} == {x: ([x, *a][-1], len(a)) for x, a in above.items()}
    for x in rng.sample(sorted(up), 60):
        below = {y for y in up if rows[y].root == rows[x].root and rows[x].pre < rows[y].pre and rows[y].post < rows[x].post}
        assert below == {y for y, a in above.items() if x in a} and (rows[x].post - rows[x].pre + 1) // 2 == len(below) + 1
    tops = rng.sample(sorted(up), 5)
    got = {(r.top, r.id): r.distance for r in taxonomy.below_any(taxonomy.tree_intervals(edges), spark.createDataFrame([(t,) for t in tops], "top string")).collect()}
    assert got == {(t, y): a.index(t) + 1 for y, a in above.items() for t in tops if t in a}


def test_intervals_of_odd_edges(spark):
    schema = "id string, parent_id string"
    edges = [("a", None), ("b", "a"), ("b", "a"), ("c", "unlisted"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s"), (None, "a"), ("alone", None)]
    rows = taxonomy.tree_intervals(spark.createDataFrame(edges, schema)).collect()
    assert sorted((r.id, r.root, r.depth) for r in rows) == [("a", "a", 0), ("alone", "alone", 0), ("b", "a", 1), ("c", "unlisted", 1), ("unlisted", "unlisted", 0)]
    assert taxonomy.tree_intervals(spark.createDataFrame([], schema)).count() == 0


def test_leaves_take_no_rounds(spark, monkeypatch):
    """A node with many leaves is no longer walk than one without: leaves are numbered, not walked."""
    tables = []
    for name in ("cut", "stored"):
        monkeypatch.setattr(taxonomy, name, lambda df, f=getattr(taxonomy, name, None): tables.append(1) or f(df), raising=False)
    edges = [("top", None), *((f"leaf{i}", "top") for i in range(700))]
    rows = {r.id: r for r in taxonomy.tree_intervals(spark.createDataFrame(edges, "id string, parent_id string").repartition(6)).collect()}
    assert len(tables) < 9 and len(rows) == 701 and (rows["top"].pre, rows["top"].post) == (-1401, 0)
    assert sorted((r.pre, r.post) for r in rows.values() if r.depth == 1) == [(i, i + 1) for i in range(-1400, 0, 2)]


C_SCHEMA = "candidate string, label string, description string, classes array<string>, supers array<string>, class_labels array<string>, ord int"
WORDS = ["pinot", "noir", "gris", "napa", "valley", "old"]
SUFFIXES = [" ava", " wine region", " (wine)"]


def made(rng):
    label = lambda k: " ".join(rng.choices(WORDS, k=k))
    cands = [
        (f"c{i}", label(rng.randrange(1, 4)) + rng.choice(["", "", *SUFFIXES]), rng.choice([None, "", "a mutation of a grape", "grape variety", "wine grape", "a ship", "wine area", "viticultural area"]),
         rng.choice([None, [], ["G"], ["S"], ["W"]]), rng.choice([None, ["G"], ["x"]]), rng.choice([None, [], ["Vitis"], ["comune"], ["vineyard"], ["Valley"]]), rng.randrange(4))
        for i in range(150)
    ]
    return cands, [(f"e{i}", label(rng.randrange(1, 3)), rng.choice([None, [label(1), label(2)]]), rng.choice([None, "AVA"])) for i in range(60)]


def best(scored, ok, review):
    if not scored:
        return None, None, "none"
    s, _, c = min(scored)
    return c, -s, "ok" if -s >= ok else review


@pytest.mark.parametrize("searched", [False, True])
def test_grapes_against_loops(spark, searched):
    rng = random.Random(7)
    cands, entries = made(rng)
    pairs = [(e[0], c[0]) for e in entries for c in rng.sample(cands, 3)] if searched else []
    want = {}
    for e, name, syns, _ in entries:
        scored = []
        for c, label, desc, classes, supers, kinds, order in cands:
            desc, kinds = (desc or "").lower(), " ".join(kinds or []).lower()
            if not ("G" in [*(classes or []), *(supers or [])] or "grape" in kinds or "vitis" in kinds or ("grape" in desc and "wine" in desc) or desc.endswith("grape variety") or desc.startswith("grape variety") or desc == "wine grape"):
                continue
            more = 20 if label == name else 15 if label in (syns or []) else 3 if label.startswith(name + " ") or label.endswith(" " + name) else 0
            if more or (e, c) in pairs:
                scored.append((-(10 + more - 5 * ("S" in (classes or []) or "mutation" in desc)), order, c))
        want[e] = best(scored, 25, "inexact label")
    df, found = spark.createDataFrame([e[:3] for e in entries], "entry string, name string, synonyms array<string>"), spark.createDataFrame(pairs, "entry string, candidate string")
    got = linking.link_grapes(df, spark.createDataFrame(cands, C_SCHEMA), ["G"], ["S"], found if searched else None)
    assert {r.entry: (r.candidate, r.score, r.note) for r in got.collect()} == want and {"ok", "inexact label"} <= {n for _, _, n in want.values()}


def test_regions_against_loops(spark):
    rng = random.Random(8)
    cands, entries = made(rng)
    want = {}
    for e, name, _, classification in entries:
        scored = []
        for c, label, desc, classes, supers, kinds, order in cands:
            suffixed = any(label == name + s for s in SUFFIXES)
            if label != name and not suffixed:
                continue
            desc, kinds = (desc or "").lower(), " ".join(kinds or []).lower()
            if "W" in [*(classes or []), *(supers or [])] or any(w in kinds for w in ("wine", "vineyard", "appellation")) or "wine" in desc or "viticultural" in desc:
                s = 30
            elif classification is None and ("comune" in kinds or "valley" in kinds):
                s = 15
            else:
                continue
            scored.append((-(s + 5 * any(w in desc for w in ("wine", "appellation", "viticultural")) + 3 * (suffixed and label != name)), order, c))
        want[e] = best(scored, 30, "no wine class")
    df = spark.createDataFrame([(e, n, k) for e, n, _, k in entries], "entry string, name string, classification string")
    got = linking.link_regions(df, spark.createDataFrame(cands, C_SCHEMA), ["W"], SUFFIXES, ["comune"])
    assert {r.entry: (r.candidate, r.score, r.note) for r in got.collect()} == want and {"ok", "no wine class", "none"} <= {n for _, _, n in want.values()}


def test_one_row_for_each_relation_of_a_hot_name(spark):
    cands = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("candidate"), F.concat(F.lit("pinot "), "id").alias("label"), F.lit("wine grape").alias("description"),
                                     *[F.array().cast("array<string>").alias(c) for c in ("classes", "supers", "class_labels")], F.col("id").cast("int").alias("ord"))
    entries = spark.createDataFrame([(i, "pinot", None) for i in range(500)], "entry int, name string, synonyms array<string>")
    got = linking.link_grapes(entries, cands, ["G"]).collect()
    assert len(got) == 500 and {(r.candidate, r.score, r.note) for r in got} == {("c0", 13, "inexact label")}
