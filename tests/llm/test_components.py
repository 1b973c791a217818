import random

from helpers import components

from sievework.llm.components import connected_components


def test_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)] + [(5, 5), (1, 2), (2, 1)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if n in got} and all(n in got for n, r in want.items() if r != n)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
