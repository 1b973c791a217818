"""Queries of live streams: event lines that arrive late, out of order and more than once, in several batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import scratch, table
from sievework.plans.run_queries import BARS, _run_events
from sievework.sources import catalog, sinks
from sievework.streaming import live, progress

DAY, PARTS = 86_400, 3


def _arriving(events, start):
    """``events`` with the part in which they arrive: up to a day late, and every third of them once more, up to a day after that."""
    first = F.col("event_id") % 97 * (DAY // 97)
    again = F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(DAY))).otherwise(F.array(F.lit(0)))).alias("again")
    at = F.unix_seconds(F.col("ts").cast("timestamp")) + first
    part = F.least(F.greatest(F.floor((at + F.col("again") - start) / (10 * DAY)), F.lit(0)), F.lit(PARTS - 1)).cast("int")
    return events.select("*", again).select("*", part.alias("part")).drop("again")


def _streamed(spark, events, transform, mode="update"):
    """The rows that a stream puts out, by batch: each part is appended as event lines before the stream goes on from its checkpoint."""
    folder, out, state = scratch(spark), scratch(spark), scratch(spark)
    start = events.agg(F.min(F.unix_seconds(F.col("ts").cast("timestamp")))).first()[0] or 0
    lines = _arriving(events, start).withColumn("ts", F.col("ts").cast("string"))
    schema = lines.drop("part").schema
    session = live.with_state_store(spark)

    def keep(rows, batch):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    for part in range(PARTS):
        sinks.append_events(lines.where(F.col("part") == part).drop("part"), folder)
        found = transform(catalog.read_events(session, folder, schema, stream=True))
        query = found.writeStream.outputMode(mode).option("checkpointLocation", state).foreachBatch(keep).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.option("mergeSchema", "true").parquet(out)


def _last(rows, keys):
    """The last row of each key that a stream put out."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, "_last.*")


def live_bars(spark, sf_dir):
    """The bars of all runs after a live stream of their events."""
    rows = _streamed(spark, _run_events(spark, sf_dir), lambda e: live.live_bars(e, seq="event_id", late="3 days", idle_seconds=90 * DAY))
    return _last(rows, ["run_id", "phase"])


def live_events_once(spark, sf_dir):
    """Every event once, of a live stream with replays."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    once = lambda e: progress.event_dedupe(e.withColumn("at", F.col("ts").cast("timestamp")), ["event_id", "event_type"], "at", "3 days")
    return _streamed(spark, events, once, "append").select("event_id", "user_id", "event_type", "value")


def live_latest(spark, sf_dir):
    """Newest event and number of events of every job, replays included, after a live stream."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.col("event_type").alias("type"))
    rows = _streamed(spark, events, lambda e: live.live_latest(e, "user_id", late="3 days", idle_seconds=90 * DAY))
    return _last(rows, ["user_id"])


QUERIES = {f.__name__: f for f in (live_bars, live_events_once, live_latest)}

SQL = {
    "live_bars": BARS + "SELECT * FROM bars",
    "live_events_once": "SELECT event_id, user_id, event_type, value FROM events",
    "live_latest": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS latest, max(ts) AS at, count(*) + sum((event_id % 3 = 0)::INT)::BIGINT AS n_events FROM events GROUP BY 1",
}
