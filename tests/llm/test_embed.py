import numpy as np
from helpers import components

from sievework.llm import embed, meeting


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain(rows, cosine):
    ok = [(i, np.array(v, float), la) for i, v, la in rows if v and la is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = [(a[0], b[0]) for k, a in enumerate(ok) for b in ok[:k] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= cosine]
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    roots = components([r[0] for r in rows], links)
    return {i: (n[i], roots[i], roots[i] == i) for i in n}


def test_against_brute_force_with_hot_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows, n = [], 0
    for k in range(300):
        v = base[k % 40] + rng.standard_normal(16) * (0.05 if k % 3 else 0.2)
        rows.append((n := n + 1, [float(np.float32(x)) for x in v], int(k % 2)))
    rows += [(n := n + 1, rows[0][1], 0) for _ in range(30)] + [(n := n + 1, [float(np.float32(x)) for x in base[0] + rng.standard_normal(16) * 0.01], 0) for _ in range(60)]
    for most in (meeting.MOST, 20):  # the lower one passes groups on whole
        monkeypatch.setattr(meeting, "MOST", most)
        monkeypatch.setattr(meeting, "BLOCK", 16)  # so that cells are dealt into blocks
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.near_dedup(table(spark, rows), miss=1e-4).collect()}
        assert got == plain(rows, 0.93)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, found with the registered setting among unrelated vectors."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(3000):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = rng.uniform(0.931, 0.94)
        rows += [(2 * k, [float(np.float32(x)) for x in a], k % 2), (2 * k + 1, [float(np.float32(x)) for x in c * a + np.sqrt(1 - c * c) * b], k % 2)]
    for options in ({}, {"crowd": 8}):
        got = {r.vec_id: r for r in embed.near_dedup(table(spark, rows), **options).collect()}
        assert sum(r.n_links for r in got.values()) >= 0.99 * 6000
        assert all(r.component_id in (i, i - i % 2) and r.n_links <= 1 for i, r in got.items())


def test_what_is_shuffled_does_not_grow_with_tables_and_vectors(spark):
    """At 300 tables a class is sent as 300 rows of fixed width, no vector among them."""
    classes = spark.createDataFrame([(i, i % 2, [float(i), 1.0, 2.0]) for i in range(50)], "key long, label long, _v array<float>")
    sent = embed._tables(classes, 20, 300, 2.0)
    assert sent.dtypes == [("turn", "int"), ("cell", "bigint"), ("key", "bigint"), ("s0", "bigint"), ("s1", "bigint")] and sent.count() == 50 * 300


def test_groups_cut_by_batches():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 60)
    g = np.repeat(np.arange(60), sizes)
    batches = [pa.RecordBatch.from_arrays([pa.array(g[i : i + 7]), pa.array(np.arange(i, min(len(g), i + 7)))], names=["g", "x"]) for i in range(0, len(g), 7)]
    seen, passed = [], set()
    for t, whole in meeting.whole_groups(iter(batches), ["g"], 12):
        seen += t.column("x").to_pylist()
        groups = set(t.column("g").to_pylist())
        if whole:
            assert len(groups) == 1
            passed |= groups
        else:
            assert not passed & groups and all(t.column("g").to_pylist().count(x) == sizes[x] for x in groups)
    assert seen == list(range(len(g))) and passed and all(sizes[x] > 12 for x in passed)


def test_awkward_vectors(spark):
    one = [1.0, 0.0]
    rows = [(1, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [float("nan"), 1.0], 0), (9, [float("inf"), 1.0], 0), (10, [1.0, None], 0), (11, [1.0, 0.0, 0.0], 0), (12, [2.0, 0.01], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.near_dedup(table(spark, rows).selectExpr("*", "1 AS n", "2 AS key", "3 AS links")).collect()}
    assert got == plain(rows, 0.93) and got[12] == (2, 1, False)
    assert embed.near_dedup(table(spark, rows).limit(0)).count() == 0


def test_plan_keeps_its_promise():
    for rows in (10, 1000, 10**6, 10**9):
        k, tables = embed.plan(rows)
        assert (1 - embed.agree((2 - 2 * 0.93) ** 0.5, embed.WIDTH) ** k) ** tables <= embed.MISS
