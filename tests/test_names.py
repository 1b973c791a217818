"""Names found by joins against the trie, and picks of hot groups against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import dictionary, selection

WORDS = ["picpoul", "de", "pinet", "cabernet", "sauvignon", "blanc", "saint", "emilion", "grand", "cru", "rosé", "x"]
INDEX = "kind string, name string, alias string, priority int"


def index(rng, n):
    rows = [("grape", f"G{i}", " ".join(rng.choices([w for w in WORDS if w != "rosé"] + ["rose"], k=rng.randrange(1, 5))), rng.randrange(2)) for i in range(n)]
    return [*rows, ("region", "R0", rows[0][2], 0), ("region", "R1", "saint-emilion", 0), ("region", "none", "' -", 0)]


@pytest.mark.parametrize("large", [False, True])
def test_joins_find_what_the_trie_finds(spark, monkeypatch, large):
    """Dictionaries beyond the bound of what is sent to the tasks give the same."""
    if large:
        monkeypatch.setattr(dictionary, "BROADCAST_ROWS", 0)
    rng = random.Random(2)
    texts = [None, "", "  ", "Cabernet, Sauvignon Blanc", "Saint-Émilion. Grand Cru", "x " * 400, "a b c"]
    texts += ["".join(rng.choice(WORDS) + rng.choice([" ", "-", ", ", ". ", "’", " \n", "; ", " – "]) for _ in range(rng.randrange(40))) for _ in range(150)]
    df = spark.createDataFrame([(i, f"k{i % 3}", t) for i, t in enumerate(texts)], "i int, k string, t string").repartition(3)
    monkeypatch.setattr(dictionary, "HELD", 300)
    monkeypatch.setattr(dictionary, "CHUNK", 7)
    for n in (1, 40):
        labels = spark.createDataFrame(index(rng, n), INDEX)
        want = {r.i: [(m["kind"], m["name"], m["pos"]) for m in r.matches] for r in dictionary.find_phrases(df, "t", labels).collect()}
        found = dictionary.find_names(df, ["i", "k"], "t", labels)
        got = {r.i: [(m["kind"], m["name"], m["pos"]) for m in r.matches] for r in dictionary.name_lists(found, ["i", "k"]).collect()}
        assert {i: got.get(i, []) for i in want} == want and (n == 1 or any(len(x) > 2 for x in got.values()))


def test_large_dictionaries_meet_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "BROADCAST_ROWS", 1)
    labels = spark.createDataFrame([("region", "Picpoul de Pinet", "picpoul de pinet", 0), ("grape", "Picpoul", "picpoul", 1)], INDEX)
    df = spark.createDataFrame([(1, "Picpoul de Pinet, picpoul"), (2, "Pinet")], "i int, t string")
    assert [(r.i, r.pos, r.name) for r in dictionary.find_names(df, ["i"], "t", labels).orderBy("pos").collect()] == [(1, 0, "Picpoul de Pinet"), (1, 3, "Picpoul")]
    assert dictionary.find_names(df, ["i"], "t", labels.limit(0)).count() == 0 and dictionary.find_names(df.limit(0), ["i"], "t", labels).count() == 0


def plain_picks(rows, n):
    """Rows of (group, family, rank, first): best of each family with first, best of each other, the rest."""
    best = {}
    for r in sorted(rows, key=lambda r: r[2]):
        best.setdefault((r[0], r[1]), r)
    turn = lambda r: (1 if r[3] else 2) if best[r[0], r[1]] is r else 3
    out = {}
    for g in {r[0] for r in rows}:
        out[g] = [(r[2], turn(r)) for r in sorted((r for r in rows if r[0] == g), key=lambda r: (turn(r), r[2]))[:n]]
    return out


def test_picks_of_hot_groups(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", f"f{rng.randrange(1 if i % 5 else 9)}", i, rng.random() < 0.2) for i in rng.sample(range(3000), 3000)]
    df = spark.createDataFrame(rows, "grp string, family string, rnk int, fst boolean").repartition(8).withColumn("body", F.lit("long text"))
    for n in (1, 5):
        picked = selection.pick_diverse(df.drop("body"), ["grp"], "family", [F.col("rnk")], F.col("fst"), n)
        got = {}
        for r in selection.join_picks(picked, df, ["rnk"]).orderBy("pick_no").collect():
            assert r.body == "long text"
            got.setdefault(r.grp, []).append((r.rnk, r["pass"]))
        assert got == plain_picks(rows, n)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    partial = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert len(partial) == 2  # both windows are cut in the tasks that read, before rows are shuffled
