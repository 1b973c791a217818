"""Near-duplicates within groups against a plain greedy fold."""

import random
import re

from pyspark.sql import functions as F

from sievework.operators import snippets
from sievework.plans import text_queries

SF = "/root/testdata/sf0.001"


def fold(rows):
    """``{id: is_dup}`` of rows (group, id, body)."""
    marks, kept = {}, {}
    for g, i, body in sorted(rows, key=lambda r: r[1]):
        body = body or ""
        have = set(re.findall("[a-z]{3,}", body.lower()))
        marks[i] = any(
            have & o and (len(have & o) / len(have | o) >= 0.9 or (min(len(body), n) >= 800 and len(have & o) / min(len(have), len(o)) >= 0.9)) for o, n in kept.get(g, [])
        )
        if not marks[i]:
            kept.setdefault(g, []).append((have, len(body)))
    return marks


def test_against_greedy_fold(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    base = [[word() for _ in range(n)] for n in (12, 40, 200, 300)]
    rows = [("a", 0, None), ("a", 1, ""), ("a", 2, "1 2"), (None, 3, "one two three"), (None, 4, "Three, two one")]
    for i in range(5, 125):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 2, 4, 10, 15))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w = w[: len(w) // 2] + [word() for _ in range(5)]
        if rng.random() < 0.5:
            w.insert(0, word() * 8)  # other first characters
        rows.append((rng.choice(("a", "b", None)), i, " ".join(w)))
    want = fold(rows)
    df = spark.createDataFrame(rows, "g string, id int, body string").repartition(3)
    got = {r.id: r.is_dup for r in snippets.near_duplicates(df, ["g"], "body", ["id"]).collect()}
    assert got == want and 10 < sum(want.values()) < 110


def test_query_compares_whole_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = fold([((r.lang, r.source), r.doc_id, r.text) for r in docs])
    assert any(want.values())
    assert {r.doc_id: r.is_dup for r in text_queries.near_dup_greedy(spark, SF).collect()} == want


def test_query_links_other_first_characters(spark, tmp_path):
    body = " ".join(f"word{a}{b}" for a in "abcdef" for b in "ghijkl")
    rows = [(1, "en", "s", body), (2, "en", "s", f"entirely different opening here {body}"), (3, "en", "t", body), (4, "en", "s", "something else")]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.is_dup for r in text_queries.near_dup_greedy(spark, str(tmp_path)).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_pairs_against_all_pairs(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdef", k=3))
    base = [[word() for _ in range(n)] for n in (3, 8, 30, 120)]
    rows = [(0, None), (1, ""), (2, "a bc 12")]
    for i in range(3, 160):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    sets = {i: set(re.findall("[a-z]{3,}", (t or "").lower())) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    reps = [i for i in sorted(sets) if sets[i] and first[frozenset(sets[i])] == i]
    want = {(first[frozenset(sets[i])], i): 1.0 for i in sets if sets[i] and i not in reps}
    for threshold in (0.9, 0.6):
        near = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for k, b in enumerate(reps) for a in reps[:k]}
        expected = want | {p: j for p, j in near.items() if j >= threshold}
        for frequent in (100_000, 3):
            monkeypatch.setattr(snippets, "FREQUENT", frequent)
            got = snippets.near_duplicate_pairs(spark.createDataFrame(rows, "i int, t string").repartition(4), "i", "t", threshold)
            assert {(r.id, r.other): r.jaccard for r in got.collect()} == expected
    assert snippets.near_duplicate_pairs(spark.createDataFrame([], "i int, t string"), "i", "t").count() == 0


def test_groups_in_blocks(spark, monkeypatch):
    """Long texts within longer ones, equal sizes and texts of other groups, whatever the blocks that a group is dealt into."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(900)]
    rows = []
    for i in range(90):
        own = rng.sample(words, rng.choice((150, 160, 700))) if i < 45 or rng.random() < 0.2 else rows[rng.randrange(45)][2].split()
        kept = own[: rng.choice((len(own), len(own) - 8, len(own) - 20, 140))]
        rows.append((rng.choice("ab"), i, " ".join([*kept, *rng.sample(words, rng.choice((0, 3, 300)))])))
    want = fold(rows)
    assert 10 < sum(want.values()) < 80
    df = spark.createDataFrame(rows, "g string, id int, body string").repartition(3)
    for block in (1 << 22, 3000):
        monkeypatch.setattr(snippets, "BLOCK", block)
        assert {r.id: r.is_dup for r in snippets.near_duplicates(df, ["g"], "body", ["id"]).collect()} == want


def test_little_is_shuffled(spark):
    """Texts with words of their own: those words are counted, but no set or pair carries them."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    shared = [word() for _ in range(40)]
    rows = [(i, " ".join([*rng.sample(shared, 20), *(word() for _ in range(200))])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, body string").repartition(4)
    hashed = df.select("id", F.array_sort(F.transform(snippets.word_set(F.col("body")), lambda w: F.xxhash64(w))).alias("w"))
    counts = snippets._counts(hashed)
    levels = snippets._magnitudes(counts)
    left = snippets._by_rarity(hashed, levels).select("size", "alone", F.size("w").alias("n")).collect()
    assert all(r["size"] == r["alone"] + r["n"] == 220 and r["n"] < 25 for r in left)
    assert all(r["n"] < 25 for r in snippets._shared_words(hashed, levels).select(F.size("w").alias("n")).collect())
    assert snippets._rare_prefixes(hashed, 0.9, counts, levels).count() == 0
    assert snippets.near_duplicate_pairs(df, "id", "body").count() == 0
