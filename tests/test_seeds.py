import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.operators import seeds, snippets


def plain(data, window):
    """Anchors by the definition."""
    h = [int(x) for x in seeds.gram_hashes(seeds.np.frombuffer(data, seeds.np.uint8))] if len(data) >= seeds.GRAM else []
    out = {}
    for i in range(len(h) - window + 1):
        for j in range(i, i + window):
            if h[j] == min(h[i : i + window]):
                out[j] = h[j]
    return out


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(0, 300), window=st.integers(1, 60), letters=st.sampled_from(["ab", "a", "abcdefgh é"]), part=st.sampled_from([17, 100, 1 << 20]))
def test_anchors_by_definition(seed, n, window, letters, part):
    data = "".join(random.Random(seed).choices(letters, k=n)).encode()
    held, seeds.PART = seeds.PART, part
    try:
        at, h = seeds.anchors(data, window)
    finally:
        seeds.PART = held
    assert dict(zip(at.tolist(), h.tolist(), strict=True)) == plain(data, window)


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), window=st.integers(1, 60))
def test_common_stretches_share_an_anchor(seed, window):
    rng = random.Random(seed)
    some = lambda k: bytes(rng.choices(range(97, 101), k=k))
    common = some(seeds.GRAM + window - 1)
    a, b = (dict(zip(*(x.tolist() for x in seeds.anchors(left + common + some(50), window)), strict=True)) for left in (some(rng.randrange(90)), some(rng.randrange(90)), ))
    assert set(a.values()) & set(b.values())


def cuts(rows, segments, needed, keyed):
    """The bodies after the rule, by loops: rows of (key, id, body), segments of (key, text)."""
    out = {}
    for key, i, body in rows:
        held = {s for k, s in segments if s is not None and body is not None and (not keyed or k == key) and len(s) >= 80 and len(body) >= 800 and len(s) < len(body) and s in body}
        if len(held) < needed:
            out[i] = (False, body)
            continue
        rest = body[: min(body.index(s) for s in held)].rstrip(" ")
        if len(rest) >= 40:
            out[i] = (True, rest)
    return out


@pytest.mark.parametrize("keyed", [True, False])
def test_splices_against_loops(spark, keyed):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choices("abcdé ", k=k))
    segments = [(rng.choice([0, 1, None]), word(n)) for n in (80, 81, 90, 200, 300, 79, 85, 120)] + [(0, "x" * 90), (1, "漢" * 80), (0, "=" * 400), (0, None), (1, "y" * 79)]
    rows = []
    for i in range(120):
        parts = [rng.choice(segments)[1] or "" for _ in range(rng.randrange(4))]
        rows.append((rng.choice([0, 1, None]), i, word(rng.choice([5, 60, 900])) + word(3).join(parts) + word(rng.choice([0, 700]))))
    rows += [(0, 120, None), (0, 121, ""), (0, 122, "x" * 5000), (0, 122, "x" * 5000), (0, 123, "=" * 900 + "x" * 100), (1, 124, word(50) + "漢" * 800 + segments[0][1])]
    df = spark.createDataFrame(rows, "k int, i int, body string").repartition(4)
    parts = spark.createDataFrame(segments * 2, "k int, segment string")
    for needed in (1, 2):
        got = {r.i: (r.spliced, r.body) for r in snippets.trim_splices(df, parts if keyed else parts.drop("k"), ["k"] if keyed else [], segments_needed=needed).collect()}
        assert got == cuts(rows, segments, needed, keyed) and any(s for s, _ in got.values())


def test_no_text_is_broadcast_and_nothing_crossed(spark):
    df = spark.createDataFrame([(i, f"{i} " * 400) for i in range(50)], "i int, body string")
    cut = snippets.trim_splices(df, df.select(F.substring("body", 1, 100).alias("segment")), [])
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and cut.count() == 50
    with pytest.raises(ValueError, match="characters"):
        snippets.trim_splices(df, df.select(F.col("body").alias("segment")), [], least_segment=20)
