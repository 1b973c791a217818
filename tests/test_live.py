import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.streaming import live, progress

SCHEMA = "run_id string, ts timestamp, seq long, type string, phase string, index long, total long, name string, cursor long, resume_phase string, stop_after string"
KINDS = ["run_plan", "info", "phase_start", "wine_start", "progress", "progress", "progress", "phase_end", "paused", "error", "exit"]
HOUR = 3600


def made(rng, seq, at):
    kind = rng.choice(KINDS)
    phase = None if kind in ("run_plan", "error", "exit") else rng.choice([*progress.PHASES, None])
    return (
        "r", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=at), seq, kind, phase, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, 3, 4, 5]), f"i{seq}", rng.choice([None, 0, 2, 9]),
        rng.choice([None, *progress.PHASES]), rng.choice([None, *progress.PHASES]),
    )


def state_events(rows):
    ranks = {k: i for i, k in enumerate(progress.ORDER, 1)}
    micros = lambda t: round((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    return [live.Event(micros(r[1]), ranks.get(r[3], len(ranks) + 1), *r[2:]) for r in rows]


def test_folds_of_any_runs_equal_the_batch(spark):
    rng = random.Random(5)
    rows = []
    for run in range(60):
        some = [made(rng, i, rng.randrange(12) * 60) for i in range(rng.randrange(1, 15))]
        rows += [(f"r{run}", *r[1:]) for r in some]
    want = {}
    for r in progress.run_bars(spark.createDataFrame(rows, SCHEMA), seq="seq").collect():
        want[r.run_id, r.phase] = tuple(r)[1:-1]
    got = {}
    for run in {r[0] for r in rows}:
        for bar in live.RunState().fold(state_events([r for r in rows if r[0] == run])).bars():
            got[run, bar[0]] = bar[:-1]
    assert got == want


@settings(max_examples=200, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(1, 30), cut=st.integers(0, 30))
def test_settling_in_parts_changes_nothing(seed, n, cut):
    rng = random.Random(seed)
    events = state_events([made(rng, i, rng.randrange(8)) for i in range(n)])
    whole = live.RunState().fold(events)
    order = sorted(events, key=lambda e: live.place(*e[:3]))
    first = live.RunState().fold(order[:cut] * 2)
    kept = live.RunState(first.plan_row(), {p: live.PhaseState(*held.row()) for p, held in first.phases.items()})  # as it is stored and read
    assert list(kept.fold(order[cut:]).bars()) == list(whole.bars()) and kept.plan_row() == whole.plan_row()


class Streamed:
    """A stream that is stopped after each part and goes on from its checkpoint."""

    def __init__(self, spark, folder, transform):
        self.spark, self.folder, self.transform, self.rows = live.with_state_store(spark), folder, transform, []

    def feed(self, rows, schema=SCHEMA):
        self.spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{self.folder}/in")
        query = (
            self.transform(self.spark.readStream.schema(schema).parquet(f"{self.folder}/in")).writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/state")
            .foreachBatch(lambda df, b: self.rows.extend(df.collect())).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return {tuple(r)[:2]: tuple(r) for r in self.rows}


def test_late_and_replayed_events_then_expiry(spark, tmp_path):
    rng = random.Random(11)
    rows = [made(rng, i, i * HOUR // 4) for i in range(60)]
    rows = [r for r in rows if r[3] not in ("error", "exit")]
    shuffled = sorted(rows, key=lambda r: r[2] + rng.randrange(12))  # up to three hours late
    stream = Streamed(spark, tmp_path, lambda e: live.live_bars(e, seq="seq", late="4 hours", idle_seconds=48 * HOUR))
    seen = []
    for part in (shuffled[:25], shuffled[25:40] + shuffled[20:30], shuffled[40:]):
        seen += part
        got = stream.feed(part)
        want = {(r.run_id, r.phase): tuple(r) for r in progress.run_bars(spark.createDataFrame(seen, SCHEMA), seq="seq").collect()}
        assert got == want
    day = lambda d, run, kind, *rest: (run, dt.datetime(2024, 1, d), 99, kind, *rest)
    stream.feed([day(9, "other", "progress", "tag", 0, 5, "x", None, None, None)])  # the watermark passes the expiry of r
    stream.feed([day(9, "other", "progress", "tag", 1, 5, "x", None, None, None)])
    got = stream.feed([day(10, "r", "progress", "score", 1, 5, "x", None, None, None), ("r", dt.datetime(2024, 1, 1), 1, "phase_end", "tag", None, 5, "y", None, None, None)])
    assert got["r", "score"][2:7] == ("running", 2, 5, True, False) and got["r", "tag"][2] == "pending"  # the state was gone, and the old event is too late
    assert got["other", "tag"][2:5] == ("running", 2, 5)


def test_latest_job_of_a_stream(spark, tmp_path):
    schema = "job string, ts timestamp, event_id long, type string"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    stream = Streamed(spark, tmp_path, lambda e: live.live_latest(e, "job", late="5 hours", idle_seconds=24 * HOUR))
    first = [("a", at(1), 1, "x"), ("a", at(6), 2, "y"), ("a", at(6), 3, "z"), ("b", at(2), 4, "x"), (None, at(1), 5, "n"), ("b", None, 6, "lost")]
    assert {k[0]: v for k, v in stream.feed(first, schema).items()} == {"a": ("a", "z", at(6), 3), "b": ("b", "x", at(2), 1), None: (None, "n", at(1), 1)}
    late = [("a", at(3), 7, "late"), ("b", at(8), 8, "new")]
    got = {k[0]: v for k, v in stream.feed(late, schema).items()}
    stream.rows = [r for r in stream.rows if r[0] != "a"] + [r for r in stream.rows if r[0] == "a"][-1:]
    assert got["b"] == ("b", "new", at(8), 2) and stream.rows[-1][1:] == ("z", at(6), 4)
    stream.feed([("c", at(100), 9, "far")], schema)
    stream.feed([("c", at(100), 10, "far")], schema)
    stream.rows = []
    assert {k[0]: v for k, v in stream.feed([("a", at(101), 11, "again"), ("a", at(7), 12, "too late")], schema).items()} == {"a": ("a", "again", at(101), 1)}


def test_latest_keeps_one_timer():
    """Events of a known job touch its state only; its one timer moves on by itself, and ends the state when the job is idle."""
    calls, held = [], []

    class Kept:
        get = staticmethod(lambda: held[-1] if held else None)
        exists = staticmethod(lambda: bool(held))
        update = staticmethod(held.append)
        clear = staticmethod(held.clear)

    class Handle:
        getValueState = staticmethod(lambda *a: Kept)  # noqa: N815
        listTimers = staticmethod(lambda: calls.append("list") or [])  # noqa: N815
        registerTimer = staticmethod(calls.append)  # noqa: N815

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    job = live._Latest(1000)
    job.init(Handle)
    row = lambda t: {"t": t * 1000, "seq": 1, "type": "x"}
    got = [list(job.handleInputRows(("a",), iter([row(t)]), At(0)))[0] for t in (5, 700, 6)]
    assert [r.n_events for r in got] == [1, 2, 3] and calls == [1005]
    list(job.handleExpiredTimer(("a",), At(1100), None))
    assert calls == [1005, 1700] and held
    list(job.handleExpiredTimer(("a",), At(1700), None))
    assert calls == [1005, 1700] and not held


def test_bars_ask_for_few_timers():
    """A run with events that wait has two timers, which are neither listed nor deleted, and are set anew only when they have come."""
    calls = []

    class Kept:
        def __init__(self):
            self.held = None

        get = lambda self: self.held or []
        put = update = lambda self, x: setattr(self, "held", x)
        clear = lambda self: setattr(self, "held", None)
        iterator = lambda self: iter(())

    class Plan(Kept):
        get = lambda self: self.held

    class Handle:
        getValueState, getListState, getMapState = (staticmethod(lambda *a, k=k: k()) for k in (Plan, Kept, Kept))  # noqa: N815
        listTimers = staticmethod(lambda: calls.append("list") or [])  # noqa: N815
        deleteTimer = registerTimer = staticmethod(calls.append)  # noqa: N815

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    job = live._LiveBars("run", 1000)
    job.init(Handle)
    row = lambda t: dict.fromkeys(live.Event._fields) | {"t": t * 1000, "rank": 1, "seq": 1, "type": "other"}
    for t in (500, 700, 600):
        assert len(list(job.handleInputRows(("a",), iter([row(t)]), At(0)))) == 3
    assert calls == [501, 1500] and len(job.waiting.held) == 3
    list(job.handleExpiredTimer(("a",), At(501), None))
    assert calls == [501, 1500, 701] and len(job.waiting.held) == 2
    list(job.handleExpiredTimer(("a",), At(1600), None))
    assert calls == [501, 1500, 701, 1700] and not job.waiting.held and job.plan.held
    list(job.handleExpiredTimer(("a",), At(1700), None))
    assert calls == [501, 1500, 701, 1700] and job.plan.held is None


def test_state_of_the_dedupe_is_bounded(spark, tmp_path):
    schema = "job string, ts timestamp, event_id long, type string"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    session, out = live.with_state_store(spark), []
    for i, rows in enumerate([[(1, 1), (1, 1), (2, 2)], [(2, 2), (3, 3)], [(4, 50)], [(5, 51)]]):
        session.createDataFrame([("a", at(h), k, "x") for k, h in rows], schema).write.mode("append").parquet(f"{tmp_path}/in")
        df = progress.event_dedupe(session.readStream.schema(schema).parquet(f"{tmp_path}/in"), ["event_id"], "ts", "5 hours")
        query = df.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/state").foreachBatch(lambda d, b: out.extend(r.event_id for r in d.collect())).trigger(availableNow=True).start()
        query.awaitTermination()
        if i == 3:
            assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2
    assert sorted(out) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("seq", [None, 3])
def test_places(seq):
    assert live.place(1, 2, seq) < live.place(1, 2, 4) < live.place(1, 3, None)
