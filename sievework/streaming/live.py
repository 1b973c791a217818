"""Bars of runs over a live stream: the machine of ``progress.run_bars`` with state, event-time timers and expiry.

Events come late, out of order and more than once.  What the watermark has passed can get no event before it any more and is folded,
in order, into a state of fixed size: the run's last plan and stop, and what each phase has done.  Later events wait beside it.  A run's
bars are put out whenever it gets events: its settled state with the waiting events folded over it in order, which is what the batch gives for
the events seen so far.  A timer at the newest waiting event settles it without further input; another, ``idle`` after a run's newest event, drops its state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sievework.streaming.progress import ORDER, PHASES

#: Transform-with-state keeps several columns of state a key, which only this store has.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "t long, rank int, seq long, type string, phase string, index long, total long, name string, cursor long, resume_phase string, stop_after string"
PLAN = "total long, cursor long, first int, last int, stop_t long, stop_rank int, stop_seq long, newest long, due long, gone long"
PHASE = "ended boolean, moved_t long, moved_rank int, moved_seq long, total long, done long, last_type string, last_index long, last_name string, last_t long"
BARS = "phase string, state string, done long, total long, in_run boolean, planned boolean, current_index long, current_name string, since timestamp"
MOVES = ("phase_start", "wine_start", "progress")


class Event(NamedTuple):
    """One event; its first three fields are its place in the order of a run, times in microseconds."""

    t: int
    rank: int
    seq: int | None
    type: str | None
    phase: str | None
    index: int | None
    total: int | None
    name: str | None
    cursor: int | None
    resume_phase: str | None
    stop_after: str | None


def place(t: int, rank: int, seq: int | None) -> tuple[int, int, int]:
    """A place in the order of a run, missing numbers first."""
    return t, rank, -(2**63) if seq is None else seq


class PhaseState:
    """What one phase of the current invocation has done."""

    def __init__(self, *held: Any):
        ended, t, rank, seq, self.total, self.done, *self.last = held or (False, *[None] * 9)
        self.ended, self.moved = ended, None if t is None else (t, rank, seq)

    def row(self) -> tuple:
        return (self.ended, *(self.moved or (None, None, None)), self.total, self.done, *self.last)

    def take(self, e: Event) -> None:
        if self.ended:
            return  # for good: what is replayed later pulls nothing back
        if e.type == "phase_end":
            self.ended = True
        elif e.type != "progress" or e.index is not None:
            self.moved, self.total = (e.t, e.rank, e.seq), self.total if e.total is None else e.total
            if e.type == "progress":
                self.done = max(self.done or 0, e.index + 1)
            self.last = [e.type, e.index, e.name, e.t]


class RunState:
    """The last plan and stop of a run and its phases; ``settled`` rows make it, ``plan_row`` and ``phases`` are kept."""

    def __init__(self, plan: tuple | None = None, phases: dict[str, PhaseState] | None = None):
        total, cursor, first, last, t, rank, seq, self.newest, self.due, self.gone = plan or (None,) * 10  # the last two: its timers
        self.plan = None if first is None else (total, cursor, first, last)
        self.stop = None if t is None else (t, rank, seq)
        self.phases = phases or {}

    def plan_row(self) -> tuple:
        return (*(self.plan or (None,) * 4), *(self.stop or (None,) * 3), self.newest, self.due, self.gone)

    def fold(self, events: Iterable[Event]) -> RunState:
        """This run after events, which are put in order; replays among them change nothing."""
        number = {p: i for i, p in enumerate(PHASES, 1)}
        for e in sorted(set(events), key=lambda e: place(*e[:3])):
            self.newest = max(self.newest or e.t, e.t)
            told = e.type == "info" and e.phase in number and e.total is not None
            if told or e.type == "run_plan":
                first = number.get(e.phase if told else e.resume_phase, 1)
                self.plan, self.phases = (e.total or 0, e.cursor or 0, first, 0 if told else number.get(e.stop_after, 0)), {}
            elif e.type in ("error", "exit"):
                self.stop = e[:3]
            elif e.phase in number and e.type in (*MOVES, "phase_end"):
                self.phases.setdefault(e.phase, PhaseState()).take(e)
        return self

    def bars(self) -> Iterator[tuple]:
        """``phase, state, done, total, in_run, planned, current_index, current_name, since`` of every phase."""
        planned, cursor, first, last = self.plan or (None, 0, 0, 0)
        for i, phase in enumerate(PHASES, 1):
            p = self.phases.get(phase) or PhaseState()
            before = i < first
            total = next((x for x in (None if before else p.total, planned) if x is not None), 0)
            done = max(min(cursor, planned) if i == first else 0, p.done or 0)
            done = total if before else max(done, total) if p.ended else done
            stopped = self.stop and p.moved and place(*self.stop) > place(*p.moved)
            state = "done" if before or p.ended else "pending" if p.moved is None else "stopped" if stopped else "running"
            kind, index, name, since = p.last
            shown = state == "running" and (kind != "progress" or done < total)
            item = kind == "wine_start"
            at = index if item and index is not None else done
            yield phase, state, done, total, i <= (last if last >= max(first, 1) else len(PHASES)), self.plan is not None, at if shown else None, name if shown and item else None, since if shown else None


class _LiveBars(StatefulProcessor):
    """State of one run: its plan, its phases, and the events that the watermark has not passed."""

    def __init__(self, run: str, idle: int):
        self.run, self.idle = run, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.plan = handle.getValueState("plan", PLAN)
        self.phases = handle.getMapState("phases", "phase string", PHASE)
        self.waiting = handle.getListState("waiting", EVENT)

    def _state(self) -> RunState:
        plan = self.plan.get()
        return RunState(None if plan is None else tuple(plan), {k[0]: PhaseState(*v) for k, v in self.phases.iterator()} if plan is not None else {})

    def _settle(self, state: RunState, events: set[Event], watermark: int) -> set[Event]:
        """Folds what the watermark has passed into the kept state; the events that wait on."""
        passed = {e for e in events if e.t <= watermark * 1000}
        if passed:
            state.fold(passed)
            self.phases.clear()
            for phase, held in state.phases.items():
                self.phases.updateValue((phase,), held.row())
        return events - passed

    def _remember(self, state: RunState, waiting: set[Event], held: bool, newest: int, watermark: int) -> None:
        """Keeps plan and waiting events; ``held`` says whether some waited before.

        A run has one timer for its waiting events and one for its end.  Each goes on by itself and is set anew only when it has come, as asking for timers costs more than an event.
        """
        state.newest = newest
        if waiting:
            self.waiting.put([tuple(e) for e in waiting])
        elif held:
            self.waiting.clear()
        if waiting and (state.due is None or state.due <= watermark):
            state.due = max(e.t for e in waiting) // 1000 + 1
            self.handle.registerTimer(state.due)
        if state.gone is None or state.gone <= watermark:
            state.gone = newest // 1000 + self.idle
            self.handle.registerTimer(state.gone)
        self.plan.update(state.plan_row())

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        state, watermark = self._state(), timerValues.getCurrentWatermarkInMs()
        held = [Event(*e) for e in self.waiting.get()] if state.newest is not None else []
        events = {*held, *(Event(*(row[c] for c in Event._fields)) for row in rows)}
        newest = max([e.t for e in events], default=0)
        newest = max(newest, state.newest or newest)
        waiting = self._settle(state, events, watermark)
        self._remember(state, waiting, bool(held), newest, watermark)
        for bar in state.fold(waiting).bars():
            *shown, since = bar
            yield Row(**dict(zip((self.run, *_names(BARS)), (key[0], *shown, _timestamp(since)), strict=True)))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        state, watermark = self._state(), timerValues.getCurrentWatermarkInMs()
        if state.newest is None or state.newest // 1000 + self.idle <= watermark:
            for kept in (self.plan, self.phases, self.waiting):
                kept.clear()
        else:
            newest, held = state.newest, {Event(*e) for e in self.waiting.get()}
            self._remember(state, self._settle(state, held, watermark), bool(held), newest, watermark)
        return iter(())

    def close(self) -> None:
        pass


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _timestamp(micros: int | None):
    return None if micros is None else dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def live_bars(events: DataFrame, run: str = "run_id", ts: str = "ts", seq: str = "index", late: str = "10 minutes", idle_seconds: int = 30 * 24 * 3600) -> DataFrame:
    """The bars of ``progress.run_bars`` over a stream of its events, in update mode: three rows of a run each time it gets events.

    Events up to ``late`` behind the newest event count in their place, older ones are dropped; a run's state goes ``idle_seconds`` after its
    newest event, and a run that goes on after that starts anew.  Events without a time are passed over, as they have no place in a stream.
    The events of one run that wait for the watermark are held in a task's memory, so ``late`` and the size of a batch bound it.
    """
    c = F.col
    rank = F.array_position(F.array(*map(F.lit, ORDER)), c("type"))
    told = events.where(c(ts).isNotNull()).withColumn("_ts", c(ts).cast("timestamp")).withWatermark("_ts", late)
    rows = told.select(
        run, "_ts", _micros(c("_ts")).alias("t"), F.when(rank > 0, rank).otherwise(len(ORDER) + 1).cast("int").alias("rank"), c(seq).cast("long").alias("seq"), "type", "phase",
        *[c(x).cast("long").alias(x) for x in ("index", "total")], "name", c("cursor").cast("long").alias("cursor"), "resume_phase", "stop_after",
    )
    kind = events.schema[run].dataType.simpleString()
    return rows.groupBy(run).transformWithState(_LiveBars(run, idle_seconds * 1000), f"{run} {kind}, {BARS}", "update", "eventTime")


class _Latest(StatefulProcessor):
    """State of one job: its newest event and the number of its events."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.newest = handle, handle.getValueState("newest", "t long, seq long, type string, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.newest.get()
        *best, n = (None, 0) if held is None else held
        best = best if held is not None else None
        for row in rows:  # one at a time, however many there are
            n += 1
            if best is None or place(row["t"], 0, row["seq"]) > place(best[0], 0, best[1]):
                best = [row["t"], row["seq"], row["type"]]
        self.newest.update((*best, n))
        if held is None:  # its one timer goes on by itself: asking for timers costs more than the event
            self.handle.registerTimer(best[0] // 1000 + self.idle)
        yield Row(job=key[0], latest=best[2], at=_timestamp(best[0]), n_events=n)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self.newest.get()
        if held is not None and held[0] // 1000 + self.idle > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(held[0] // 1000 + self.idle)  # newer events came since
        else:
            self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def live_latest(events: DataFrame, job: str, ts: str = "ts", seq: str = "event_id", late: str = "10 minutes", idle_seconds: int = 30 * 24 * 3600) -> DataFrame:
    """``progress.live_status`` over a stream, in update mode: ``job, latest, at, n_events`` of each job that gets events, whose state goes when it is idle.

    Of events of one time the greater ``seq`` is later.  Late events count, up to ``late`` behind the newest; they do not replace a later one.  Events
    without a time are passed over.  The count starts anew for a job that was idle for longer than ``idle_seconds``.
    """
    c = F.col
    rows = events.where(c(ts).isNotNull()).withColumn("_ts", c(ts).cast("timestamp")).withWatermark("_ts", late)
    rows = rows.select(job, "_ts", _micros(c("_ts")).alias("t"), c(seq).cast("long").alias("seq"), "type")
    kind = events.schema[job].dataType.simpleString()
    out = rows.groupBy(job).transformWithState(_Latest(idle_seconds * 1000), f"job {kind}, latest string, at timestamp, n_events long", "update", "eventTime")
    return out.withColumnRenamed("job", job)


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session whose streams keep their state in RocksDB; other sessions of the application keep their setting."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    return own
