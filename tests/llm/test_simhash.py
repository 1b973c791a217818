import random

import numpy as np
import xxhash
from helpers import awkward, components, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import simhash


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aAÄ b\t\n\u00a0\x1c", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain(text)


def test_code_has_radius_one_and_balls_are_complete():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 300, np.uint64)
    y = x.copy()
    for bit in rng.integers(0, 64, (2, 300)).astype(np.uint64):
        y ^= np.uint64(1) << bit  # 0 or 2 bits apart
    z = x ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    every = [set() for _ in range(3)]
    for sets, fps in zip(every, (x, y, z), strict=True):
        i, a = simhash.near_anchors(fps)
        assert (np.bitwise_count(fps[i] ^ a) <= 2).all() and (np.bincount(i) <= 33).all()
        sets.update(zip(i.tolist(), a.tolist(), strict=True))
    for other in every[1:]:
        met = {i for i, _ in every[0] & other}
        assert met == set(range(300))  # each pair meets at some anchor


def test_components_against_all_pairs(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(20)]
    for f in fps[:]:  # chains of near fingerprints, and one dense group
        for _ in range(4):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.append(f)
    fps += [fps[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)] + [0, 1 << 63, fps[1]]
    rows = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, fp long"))
    of = {r.fp: r.component_id for r in got.collect()}
    wider = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, fp long"), radius=3)  # covering radius plus threshold
    assert {r.fp: r.component_id for r in wider.collect()} == of
    links = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = components(range(len(fps)), links)
    assert {i: of[f] for i, f in rows} == want


def test_awkward_documents(spark):
    rows = awkward()
    got = simhash.simhash_near_dedup(documents(spark, rows, extra=True)).collect()
    assert sorted((r.doc_id, r.fingerprint) for r in got if r.doc_id is not None) == sorted((i, f"{plain(t):016x}") for i, t, _, _ in rows if i is not None)
    of = {r.doc_id: r.component_id for r in got}
    assert of[0] == of[1] == of[2] == 0 and of[3] == of[4] == 3
    assert simhash.simhash_near_dedup(documents(spark, rows).limit(0)).count() == 0


def test_golay_code_is_perfect():
    code = simhash.golay(3)
    assert (code.size == 1).all() and len(code.patterns) == 2048
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**23, 500, np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 23, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 23, 500).astype(np.uint64))
    met = [set(zip(*(a.tolist() for a in simhash.golay(4).anchors(p)), strict=True)) for p in (x, y)]
    assert {i for i, _ in met[0] & met[1]} == set(range(500))


def shingles(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def test_near_copies_against_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(120):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 3, 12])):
            w = base[:]
            for _ in range(rng.choice([0, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(9999)}"
            rows.append((n := n + 1, " ".join(w).upper() if n % 5 == 0 else " ".join(w), "en", "a"))
    monkeypatch.setattr(simhash.meeting, "BLOCK", 4)
    held = documents(spark, rows)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(held, [], "doc_id", "text").collect()}
    sets = {i: shingles(t) for i, t, _, _ in rows}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    sure = [(a, b) for (a, b), j in alike.items() if j >= 0.88]
    assert sum(got[a] == got[b] for a, b in sure) == len(sure) > 100
    near = [(a, b) for (a, b), j in alike.items() if 0.8 <= j]
    assert sum(got[a] == got[b] for a, b in near) >= 0.95 * len(near)
    most = components(sets, [(a, b) for (a, b), j in alike.items() if j >= 0.7])  # nothing less alike links
    assert all(most[i] == most[c] for i, c in got.items())


def test_one_of_each_stays(spark):
    rows = awkward()
    docs = documents(spark, rows, extra=True).selectExpr("*", "1 AS _k1", "2 AS _k2", "3 AS _0", "4 AS root", "5 AS least_id")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    # no words: 0, 1, 2; equal texts: 3, 3, 4; long ones that differ in a word at the end: 5, 6
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (True, 0), (True, 3), (True, 5), (True, 7), (True, 8), (True, 9)]
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0
    hot = documents(spark, [(7, "the same row again", "en", "a")] * 500 + [(8, "the same row again", "en", "b")])
    assert [r.doc_id for r in simhash.keep_one_of_each(hot).collect()] == [7]
