import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, spark_rows, sql_rows

from sievework.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024.0):
    """The codes by loops over whole numbers; rows of (id, vector, label), all sound and of one length."""
    whole = [(i, [math.floor(scale * float(np.float32(c))) for c in v], label) for i, v, label in rows]
    w = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    nearest = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in whole:
                held.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, label in whole:
        found = [nearest(v, p) for p in range(parts)]
        error = sum(x for x, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, code, error, sums[label], sha) for i, code, error, label in out), key=str)


def coded(df, **more):
    return sorted((tuple(r) for r in vector_codes.compress(df, **more).collect()), key=str)


@pytest.mark.parametrize(("d", "entries"), [(4, 5), (12, 16)])
def test_against_loops(spark, d, entries):
    rng = np.random.default_rng(d)
    rows = [(i, rng.normal(size=d).tolist(), [None, 1, 2][i % 3]) for i in range(150)] + [(7, [0.25] * d, 1), (7, [-0.25] * d, 1), (None, [0.5] * d, 9)]
    assert coded(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=entries) == plain(rows, entries=entries)


def test_fewer_rows_than_entries_and_ties(spark):
    rows = [(i, [float(i % 2)] * 4, 0) for i in range(10)]
    got = coded(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows) and {r[1] for r in got} == {"00000000", "01010101"}


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(1, 60), k=st.integers(1, 20), large=st.booleans())
def test_assigning_by_tables(seed, n, k, large):
    rng = np.random.default_rng(seed)
    top = vector_codes.LIMIT if large else 4
    values, books = rng.integers(-top, top + 1, (n, 8)), rng.integers(-top, top + 1, (2, k, 4))
    codes, errors = vector_codes.assign(values, books)
    for p in range(2):
        every = ((values[:, None, p * 4 : p * 4 + 4] - books[p]) ** 2).sum(2)
        assert (codes[:, p] == every.argmin(1)).all() and (errors[:, p] == every.min(1)).all()


def test_query_equals_sql_on_a_larger_table(spark):
    sf = "/root/testdata/sf0.1"
    assert spark_rows(queries.op13_vector_codes(spark, sf)) == sql_rows(connect(sf), queries.OP13_SQL)


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 0.5, 0.0, 1.0], 0), (1, [1.0, 2.0, 0.5, 0.0, 1.0], 0), (2, [3.0, 2.5, 1.0, 1.0, 1.0], None), (None, [0.0] * 5, None), (3, None, 1), (4, [], 1), (5, [1.0, None, 1.0, 1.0, 1.0], 1),
        (6, [float("nan")] * 5, 1), (7, [float("inf")] * 5, 1), (8, [1.0, 2.0], 1), (9, [-3e38, 3e38, 1.0, 1.0, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = coded(df.selectExpr("*", "1 AS v", "2 AS code", "3 AS error", "4 AS _id", "5 AS _label", "6 AS _same"))
    assert [r[0] for r in got] == [1, 1, 2, 9, None] and got[0][1] == got[1][1] and all(r[2] == 0 for r in got)
    assert coded(df.limit(0)) == coded(df.where("vec_id IN (3, 4)")) == []
    padded = [(i, [*v, 0.0, 0.0, 0.0], label) for i, v, label in rows if i in (1, 2, None)]
    assert coded(df.where("vec_id IS NULL OR vec_id IN (1, 2)")) == plain(padded)
