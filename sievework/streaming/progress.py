"""Progress of runs from their events, as a batch fold and as a stream with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds per item that a phase takes before it has a rate of its own.
TYPICAL = {"search": 17.0, "score": 60.0, "tag": 30.0}
PHASES = tuple(TYPICAL)


def seconds(ts: str) -> Column:
    """A time as seconds: of a timestamp with or without zone, or a number of seconds as it is."""
    return F.coalesce(F.col(ts).cast("string").try_cast("double"), F.col(ts).cast("string").try_cast("timestamp").cast("double"))


def event_dedupe(events: DataFrame, keys: list[str], ts: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Each event once, batch or stream.

    A stream knows keys again up to ``late`` after their first event and forgets them then; it takes the watermark of column ``ts``, unless it has one
    already (``ts`` null).  Its events older than the watermark are dropped.
    """
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return (events.withWatermark(ts, late) if ts else events).dropDuplicatesWithinWatermark(keys)


def current_invocation(events: DataFrame, run: str = "run_id", ts: str = "ts", plan: str = "run_plan") -> DataFrame:
    """The events of each run from its last plan on."""
    last = F.max(F.when(F.col("type") == plan, F.col(ts))).over(Window.partitionBy(run))
    return events.withColumn("_plan", last).where(F.col("_plan").isNull() | (F.col(ts) >= F.col("_plan"))).drop("_plan")


def progress(events: DataFrame, run: str = "run_id", ts: str = "ts") -> DataFrame:
    """Per run and phase: ``state, total, done, started, ended`` of the current invocation.

    A phase is done once it has ended, whatever is replayed later; an error or exit stops those that run.
    """
    now = event_dedupe(current_invocation(events, run, ts), [run, "type", ts, "phase", "index"])
    stop = now.where(F.col("type").isin("error", "exit")).groupBy(run).agg(F.max(ts).alias("stopped"))
    of = lambda t, c: F.when(F.col("type") == t, c)
    rows = now.where("phase IS NOT NULL").groupBy(run, "phase").agg(
        F.min(of("phase_start", F.col(ts))).alias("started"), F.max(of("phase_end", F.col(ts))).alias("ended"),
        F.coalesce(F.max(of("progress", F.col("index") + 1)), F.lit(0)).alias("done"), F.max("total").alias("total"),
    )
    joined = rows.join(stop, run, "left")
    state = F.when(F.col("ended").isNotNull(), "done").when(F.col("stopped").isNotNull(), "stopped").when(F.col("started").isNotNull() | (F.col("done") > 0), "active").otherwise("pending")
    done = F.when(F.col("ended").isNotNull(), F.coalesce("total", "done")).otherwise(F.col("done"))
    return joined.select(run, "phase", state.alias("state"), "total", done.alias("done"), "started", "ended")


#: Kinds of one time in the order in which a run emits them; all others come after.
ORDER = ("info", "run_plan", "phase_start", "wine_start", "progress", "phase_end")


def run_bars(events: DataFrame, run: str = "run_id", ts: str = "ts", seq: str = "index", live: bool = True) -> DataFrame:
    """The bar of every phase of every run's last invocation: ``run, phase, state, done, total, in_run, planned, current_index, current_name, since``.

    Columns read: ``type, phase, index, total, name, cursor, resume_phase, stop_after``, the run and the time; events of one time and
    kind come by ``seq``.  A ``run_plan``, or an ``info`` with a phase and a total, plans anew: phases before the one it resumes are done,
    that one starts at the cursor, and those after ``stop_after`` are not in the run.  Starts and items make a phase run, ``phase_end``
    ends it for good, and an ``error`` or ``exit`` stops what runs until it goes on.  Without ``live`` nothing runs any more.

    Replays of an event change nothing, so none need be dropped.  States are folded from maxima, so a run of any number of events is
    counted in the tasks that read it.  Runs without a plan have totals from their events.  An empty table gives an empty result.
    """
    c, of = F.col, lambda cond, what: F.when(cond, what)
    index_of = lambda x: F.array_position(F.array(*map(F.lit, PHASES)), x)  # noqa: E731  from 1; 0: no phase
    rank = F.array_position(F.array(*map(F.lit, ORDER)), c("type"))
    at = F.struct(c(ts).alias("t"), F.when(rank > 0, rank).otherwise(len(ORDER) + 1).alias("rank"), c(seq).alias("seq"))
    told = (c("type") == "info") & (index_of(c("phase")) > 0) & c("total").isNotNull()
    plans = told | (c("type") == "run_plan")
    plan = F.struct(
        F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("cursor", F.lit(0)).alias("cursor"),
        F.greatest(F.lit(1), F.coalesce(index_of(F.when(told, c("phase")).otherwise(c("resume_phase"))), F.lit(0))).alias("first"),
        F.coalesce(index_of(F.when(~told, c("stop_after"))), F.lit(0)).alias("last"),
    )
    timed = events.withColumn("_at", at)
    runs = timed.groupBy(run).agg(
        F.max_by(plan, of(plans, c("_at"))).alias("_plan"), F.max(of(plans, c("_at"))).alias("_from"), F.max(of(c("type").isin("error", "exit"), c("_at"))).alias("_stop"))

    moves = c("type").isin("phase_start", "wine_start") | ((c("type") == "progress") & c("index").isNotNull())
    steps = timed.where((index_of(c("phase")) > 0) & (moves | (c("type") == "phase_end"))).join(runs.select(run, "_from"), run)
    steps = steps.where(c("_from").isNull() | (c("_at") > c("_from")))
    ends = steps.where("type = 'phase_end'").groupBy(run, "phase").agg(F.min("_at").alias("_end"))
    steps = steps.join(ends, [run, "phase"], "left").where(moves & (c("_end").isNull() | (c("_at") < c("_end"))))
    folded = steps.groupBy(run, "phase").agg(
        F.max("_at").alias("_moved"), F.max_by("total", of(c("total").isNotNull(), c("_at"))).alias("_total"), F.max(of(c("type") == "progress", c("index") + 1)).alias("_done"),
        F.max_by(F.struct("type", "index", "name", c(ts).alias("t")), "_at").alias("_last"))

    bars = runs.select("*", F.explode(F.array(*map(F.lit, PHASES))).alias("phase")).join(folded, [run, "phase"], "left").join(ends, [run, "phase"], "left")
    at_phase, planned = index_of(c("phase")), c("_plan").isNotNull()
    before = F.coalesce(at_phase < c("_plan.first"), F.lit(False))
    total = F.when(before, c("_plan.total")).otherwise(F.coalesce("_total", "_plan.total", F.lit(0)))
    start = F.when(at_phase == c("_plan.first"), F.least("_plan.cursor", "_plan.total")).otherwise(0)
    counted = F.greatest(start, F.coalesce("_done", F.lit(0)))
    done = F.when(before, total).when(c("_end").isNotNull(), F.greatest(counted, total)).otherwise(counted)
    stopped = F.coalesce(c("_stop") > c("_moved"), F.lit(False)) | F.lit(not live)
    state = F.when(before | c("_end").isNotNull(), "done").when(c("_moved").isNull(), "pending").when(stopped, "stopped").otherwise("running")
    bars = bars.withColumns({"_t": total.cast("long"), "_n": done.cast("long"), "_state": state})
    kind = c("_last.type")
    shown = (c("_state") == "running") & ((kind != "progress") | (c("_n") < c("_t")))
    last = F.when(c("_plan.last") >= c("_plan.first"), c("_plan.last")).otherwise(len(PHASES))
    return bars.select(
        run, "phase", c("_state").alias("state"), c("_n").alias("done"), c("_t").alias("total"), (at_phase <= last).alias("in_run"), planned.alias("planned"),
        of(shown, F.when(kind == "wine_start", F.coalesce("_last.index", "_n")).otherwise(c("_n"))).cast("long").alias("current_index"),
        of(shown & (kind == "wine_start"), c("_last.name")).alias("current_name"), of(shown, c("_last.t")).alias("since"),
    )


def bars_eta(bars: DataFrame, run: str, rate: Column, now: Column) -> DataFrame:
    """Per run the seconds until its invocation ends or pauses: ``run, eta``; null if nothing runs.

    A running phase takes what is left at its own rate, less what has passed since its last item, or at the typical rate while it has none;
    those to come in this run take their typical time.
    """
    typical = F.create_map(*[F.lit(x) for kv in TYPICAL.items() for x in kv])
    left = F.greatest(F.lit(0), F.col("total") - F.col("done"))
    spent = F.greatest(F.lit(0.0), F.coalesce(now - seconds("since"), F.lit(0.0)))
    own = F.when(rate.isNotNull(), F.greatest(F.lit(0.0), left * rate - spent))
    running = F.col("state") == "running"
    each = F.when(F.col("in_run") & (running | (F.col("state") == "pending")), F.coalesce(F.when(running, own), left * F.try_element_at(typical, F.col("phase"))))
    return bars.groupBy(run).agg(F.when(F.max(running), F.sum(F.coalesce(each, F.lit(0.0)))).alias("eta"))


def phase_rate(events: DataFrame, keys: list[str], ts: str, counted: Column, least: int = 3) -> DataFrame:
    """Mean seconds between counted events per key, null until there are ``least``."""
    prior = F.lag(seconds(ts)).over(Window.partitionBy(*keys).orderBy(ts, "index"))
    gaps = events.withColumn("_gap", seconds(ts) - prior)
    n = F.sum(F.when(counted & F.col("_gap").isNotNull(), 1).otherwise(0))
    mean = F.avg(F.when(counted, F.col("_gap")))
    return gaps.groupBy(*keys).agg(n.alias("n_gaps"), F.when(n >= least, mean).alias("rate"))


def eta(total: Column, done: Column, rate: Column, elapsed: Column) -> Column:
    """Seconds that a phase still takes: what is left times the rate, less what has passed since the last item."""
    return F.when(rate.isNotNull() & (total > done), F.greatest(F.lit(0.0), (total - done) * rate - elapsed))


def overall_eta(phases: DataFrame, run: str) -> DataFrame:
    """Per run the ETA of the active phase and the typical time of those to come; null if idle.

    ``phases(run, phase, state, total, done, eta)``.
    """
    typical = F.create_map(*[F.lit(x) for kv in TYPICAL.items() for x in kv])
    to_come = F.when(F.col("state") == "pending", F.col("total") * F.try_element_at(typical, F.col("phase")))
    active = F.max(F.when(F.col("state") == "active", 1).otherwise(0))
    total = F.sum(F.when(F.col("state") == "active", F.col("eta")).otherwise(F.coalesce(to_come, F.lit(0.0))))
    return phases.groupBy(run).agg(F.when(active == 1, total).alias("overall_eta"))


def overall_fraction(phases: DataFrame, run: str, weight: Column) -> DataFrame:
    """Per run the weighted share done."""
    part = F.when(F.col("total") > 0, F.least(F.lit(1.0), F.col("done") / F.col("total"))).otherwise(F.lit(0.0))
    return phases.groupBy(run).agg((F.sum(weight * part) / F.sum(weight)).alias("fraction"))


def live_status(events: DataFrame, job: str, ts: str, watermark: str | None = None) -> DataFrame:
    """Latest event and number of events per job; with a stream use update mode."""
    rows = events.withWatermark(ts, watermark) if watermark and events.isStreaming else events
    return rows.groupBy(job).agg(F.max_by("type", F.struct(ts, "event_id")).alias("latest"), F.max(ts).alias("at"), F.count("*").alias("n_events"))


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Events per tumbling window and key; late rows within the watermark count."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, watermark).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def fold_state(rows: list[tuple], state: dict | None) -> dict:
    """Progress of one job after more events (ts, type, event_id), in order: done, total, finished, errors.

    ``signup`` plans anew, ``click`` counts an item, ``purchase`` ends, ``error`` counts a failure; a job that has ended
    takes no items until it is planned anew.
    """
    s = dict(state or {"done": 0, "ended": 0, "errors": 0})
    for _, kind, _ in sorted(rows):
        if kind == "signup":
            s = {"done": 0, "ended": 0, "errors": 0}
        elif kind == "click" and not s["ended"]:
            s["done"] += 1
        elif kind == "purchase":
            s["ended"] = 1
        elif kind == "error":
            s["errors"] += 1
    return s


def progress_stream(events: DataFrame, job: str, ts: str = "ts") -> DataFrame:
    """The fold above over a stream, one state per job; each batch is put in order before it is folded."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(("done", "ended", "errors"), state.get, strict=True)) if state.exists else None
        rows = [r for p in parts for r in p[[ts, "type", "event_id"]].itertuples(index=False, name=None)]
        new = fold_state(rows, held)
        state.update((new["done"], new["ended"], new["errors"]))
        yield pd.DataFrame({job: [key[0]], **{k: [v] for k, v in new.items()}})

    out = f"{job} long, done long, ended long, errors long"
    return events.groupBy(job).applyInPandasWithState(fold, out, "done long, ended long, errors long", "update", GroupStateTimeout.NoTimeout)
