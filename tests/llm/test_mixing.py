from collections import defaultdict

from helpers import awkward, documents, words

from sievework.llm import mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Water filling by rounds: share by weight, cut at the caps, reshare the rest."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, rest = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return out | {s: rest * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            rest -= out[s]
        open_ -= over


def test_targets_and_takes(spark):
    rows = [(i, "w " * (i * 7919 % 50), "en", None if i % 10 == 0 else f"s{i % 4 if i % 3 else 0}") for i in range(600)] + [(i, "tiny", "en", "aa") for i in range(900, 903)]
    docs = documents(spark, rows)
    got = mixing.plan_mix(docs, keep=["doc_id", "source"]).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source] and r.taken == r.copies * r.size and r.copies <= 3
        assert list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions) and len(r.positions) == r.copies
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 50 for s in want)  # within a document
    again = mixing.plan_mix(docs.repartition(7), keep=["doc_id"]).collect()
    assert sorted((r.doc_id, r.taken, tuple(r.positions)) for r in got) == sorted((r.doc_id, r.taken, tuple(r.positions)) for r in again)


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w w w w w", "en", s) for i, s in enumerate(["a", "b"] * 1000)]
    got = mixing.plan_mix(documents(spark, rows), weights=(1.0, 1.0), slopes=(1.0, -1.0), keep=["source"]).collect()
    early = {s: sum(p < 0.5 for r in got if r.source == s for p in r.positions) / 1000 for s in "ab"}
    assert abs(early["a"] - 0.25) < 0.02 and abs(early["b"] - 0.75) < 0.02  # the integrals of both schedules up to one half


def test_stream_is_sorted_and_whole(spark):
    docs = documents(spark, awkward(), extra=True)
    planned = {(r.doc_id, r.source): r.copies for r in mixing.plan_mix(docs, keep=["doc_id", "source"]).collect()}
    stream = mixing.mix(documents(spark, awkward())).collect()
    assert [r.position for r in stream] == sorted(r.position for r in stream)
    assert len(stream) == sum(r.copies for r in mixing.plan_mix(docs, keep=["doc_id"]).collect())
    assert planned[(0, "a")] == planned[(1, "a")] == 0
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.plan_mix(docs.limit(0), keep=["doc_id"]).count() == 0


def test_columns_of_any_name(spark):
    docs = documents(spark, awkward()).selectExpr("*", "1 AS _position", "2 AS _epoch", "3 AS _in0", "4 AS _0", "5 AS source_key", "6 AS bucket", "7 AS _at")
    stream = mixing.mix(docs)
    assert stream.columns == [*docs.columns, "epoch", "position"]
    rows = stream.collect()
    assert rows and all((r._position, r._epoch, r._in0, r.bucket) == (1, 2, 3, 6) for r in rows)


def test_many_buckets_change_nothing(spark, monkeypatch):
    docs = documents(spark, [(i % 40 if i % 3 else None, f"w{i} " * (i % 30), "en", f"s{i % 5}") for i in range(700)])
    places = lambda: sorted(((r.size, r.source_size, tuple(r.positions)) for r in mixing.plan_mix(docs, keep=["doc_id"]).collect()), key=repr)
    few = places()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert places() == few
