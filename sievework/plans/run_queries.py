"""Queries of the store, the runs, the transcripts, scoring, pages and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import scratch, table
from sievework.operators import analytics, scoring, store
from sievework.sources import html_tables as html
from sievework.streaming import progress as prog


def _store(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    status = F.when(F.col("c_custkey") % 7 == 0, "human").when(F.col("c_custkey") % 3 == 0, "model").otherwise("pending")
    return c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", (F.col("c_acctbal") - 1).alias("c_acctbal"), F.lit("old").alias("note"), status.alias("tag_status"),
                                               F.when(F.col("c_custkey") % 4 == 0, "red").alias("category"), (F.col("c_custkey") % 8 == 0).alias("category_inferred"))


def _feed(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 5 == 0, "white").alias("category"))


def protected_upsert(spark, sf_dir):
    out = store.protected_upsert(_store(spark, sf_dir), _feed(spark, sf_dir), "c_custkey", ["c_name", "c_acctbal", "category"], "category", "category_inferred")
    return out.withColumn("c_acctbal", F.round("c_acctbal", 2))


def apply_tags(spark, sf_dir):
    tags = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 6 == 0, "tagged").alias("note"), F.lit("rose").alias("category"))
    return store.apply_tags(_store(spark, sf_dir), tags, "c_custkey", ["note"]).select("c_custkey", "note", "category", "category_inferred", "tag_status")


def apply_edits(spark, sf_dir):
    edits = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(
        "c_custkey", F.lit(None).cast("string").alias("note"), F.lit("needs_review").alias("tag_status"), F.when(F.col("c_custkey") % 20 == 0, F.array(F.lit("note"))).otherwise(F.array(F.lit("tag_status"))).alias("present"))
    return store.apply_edits(_store(spark, sf_dir), edits, "c_custkey", ["note", "tag_status"]).select("c_custkey", "note", "tag_status")


def reset_human(spark, sf_dir):
    return store.status_counts(store.reset_human(_store(spark, sf_dir)), "tag_status")


def skip_human(spark, sf_dir):
    return store.skip_human(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), _store(spark, sf_dir), "c_custkey").select("o_orderkey", "c_custkey")


def legacy_status(spark, sf_dir):
    old = F.when(F.col("c_custkey") % 4 == 0, "auto").when(F.col("c_custkey") % 4 == 1, "manual").when(F.col("c_custkey") % 4 == 2, "model")
    return table(spark, sf_dir, "customer").select("c_custkey", store.legacy_status(old).alias("status"))


def export_tags(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 9 > 0, F.col("r_name")).alias("country"), F.array("n_name", F.lit(" ")).alias("region"),
                    F.array(F.lower("c_mktsegment")).alias("grapes"), F.lit("model").alias("tag_status"))
    return store.export_rows(rows, status="model")


def render_tags(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    grapes = F.when(F.col("c_custkey") % 2 == 0, F.array("c_mktsegment")).otherwise(F.array().cast("array<string>"))
    empty = F.col("c_custkey") % 3 == 0
    shown = store.render_tags(F.when(~empty, F.lit("France")), F.array().cast("array<string>"), grapes, F.col("c_custkey") % 4 == 0, F.col("c_custkey") % 5 == 0)
    return rows.select("c_custkey", shown.alias("tags"))


def status_counts(spark, sf_dir):
    return store.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P", "Z"])


def retention(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("run_id"))
    return store.retention(orders, 5, [1, 2, 3, 4, 5, 6, 7], ["o_custkey"])


def history_backfill(spark, sf_dir):
    final = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("run_id"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit(-1).cast("long")).alias("tag_run_id"))
    return store.backfill_run(rows, final, "c_custkey")


def product_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("run_id"), "o_orderkey")
    return store.history([o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0")], "id")


def run_results(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    held = _store(spark, sf_dir).select("c_custkey", "c_name", "tag_status")
    line = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    per = items.join(line, "o_orderkey").groupBy("c_custkey").agg(F.sum("n").alias("n"), F.sum("q").alias("q"))
    search = per.select("c_custkey", (F.col("n") % 5).alias("n_snippets"))
    scorer = per.where("n % 5 > 0").select("c_custkey", (F.col("q") % 3 > 0).alias("has_context"))
    final = per.where("n % 7 > 0").select("c_custkey", F.lit("model").alias("tag_status"), (F.col("n") % 3 > 0).alias("submitted"))
    return store.run_results(items, held, "c_custkey", search, scorer, final).select("o_orderkey", "c_name", "search_status", "score_status", "tag_phase", "run_status", "human_in_store")


def run_summary(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("run_id"), F.col("o_orderkey").alias("id"))
    final = items.join(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")).distinct(), "id")
    return store.run_summary(items, final, "id")


def remaining(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select("o_orderkey")
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return store.remaining(items, done, ["o_orderkey"])


def phase_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("run_id", F.year("o_orderdate"))
    search = o.select("run_id", (F.col("o_orderstatus") == "P").alias("skipped"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("o_orderkey") % 4).alias("n_snippets"))
    scorer = o.where("o_orderkey % 4 > 0").select("run_id", (F.col("o_orderkey") % 3 > 0).alias("has_context"))
    final = o.where("o_orderkey % 3 > 0").select("run_id", F.when(F.col("o_totalprice") > 100000, "model").otherwise("needs_review").alias("tag_status"))
    return analytics.phase_counts(search, scorer, final)


def run_outcome(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return analytics.run_outcome(items, _store(spark, sf_dir), "c_custkey")


def _messages(spark, sf_dir):
    """Every event as a JSON message with one tool call, of its user's transcript; arguments are objects or strings of them."""
    e = table(spark, sf_dir, "events")
    args = F.to_json(F.struct(F.concat(F.lit("name "), F.col("event_id") % 9).alias("name"), F.array("event_type").alias("region")))
    told = F.when(F.col("event_id") % 50 == 0, '"not json"').when(F.col("event_id") % 7 == 0, args).otherwise(F.concat(F.lit('"'), F.replace(args, F.lit('"'), F.lit('\\"')), F.lit('"')))
    kind, view = F.when(F.col("event_type") == "click", "submit_tags").otherwise("lookup_region"), F.col("event_type") == "view"
    call = F.concat(F.lit('{"id": "'), "event_id", F.lit('", "function": {"name": "'), kind, F.lit('", "arguments": '), told, F.lit("}}"))
    head = F.when(view, '{"role": "tool", "name": "submit_tags"').otherwise('{"role": "assistant"')
    return e.select("user_id", F.concat(head, F.lit(', "content": "", "tool_calls": ['), call, F.lit("]}")).alias("message"))


def tool_call_counts(spark, sf_dir):
    return analytics.message_tool_calls(_messages(spark, sf_dir), "message", ["lookup_region", "submit_tags"])


def submitted_values(spark, sf_dir):
    return analytics.message_values(_messages(spark, sf_dir), "message", "submit_tags", ["region"])


def submit_attempts(spark, sf_dir):
    return analytics.message_attempts(_messages(spark, sf_dir), "user_id", "message")


def _run_logs(spark, sf_dir):
    """Runs by month of order: what they say of themselves, their products, those tagged, and logs by phase."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("run_id"), F.col("o_orderkey").alias("id"))
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_returnflag", "l_linestatus")
    logs = orders.join(line, "id").select("run_id", F.when(F.col("l_returnflag") == "N", "search").when(F.col("l_returnflag") == "A", "score").otherwise("tag").alias("phase"), "id")
    final = orders.join(line.where("l_linestatus = 'F'"), "id").select("run_id", "id")
    month = F.substring("run_id", 6, 2).cast("int")
    info = lambda done: F.struct(F.when(month % 2 == 0, "done").otherwise("running").alias("state"), done.alias("done"))
    said = F.map_concat(F.create_map(F.lit("search"), info(month)), F.when(month % 3 > 0, F.create_map(F.lit("tag"), info(month * 2))).otherwise(F.create_map().cast("map<string,struct<state:string,done:int>>")))
    runs = orders.select("run_id").distinct().select("run_id", F.when(month % 4 == 0, "paused").otherwise("done").alias("status"), said.alias("phases"))
    return runs, orders, final, logs


def run_overview(spark, sf_dir):
    runs, items, final, logs = _run_logs(spark, sf_dir)
    return store.run_overview(runs, items, final, logs, prog.PHASES, "id").select("run_id", "status", "phase", F.col("info.state").alias("state"), F.col("info.done").alias("done"), "products", "tagged", "logged")


def run_files(spark, sf_dir):
    _, _, final, logs = _run_logs(spark, sf_dir)
    return store.run_files(logs, final, "id")


def matching_runs(spark, sf_dir):
    """Saved lists of all customers: as asked, backwards, without the last, with one more, and with two that changed places."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("id"))
    last, pos = rows.agg(F.max("pos")).first()[0] or 0, F.col("pos")
    run = lambda name, at: rows.select(F.lit(name).alias("run_id"), at.alias("pos"), "id")
    saved = run("same", pos).union(run("backwards", last - pos)).union(run("shorter", pos).where(pos < last)).union(run("longer", pos))
    saved = saved.union(rows.where(pos == last).select(F.lit("longer"), pos + 1, F.col("id") + 1)).union(run("swapped", F.when(pos == 1, 2).when(pos == 2, 1).otherwise(pos)))
    return store.matching_runs(rows, saved, "id", "pos")


def _versions(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("label_fold"), (F.col("n_nationkey") % 4 > 0).alias("is_canonical"), "n_nationkey")
    calls = table(spark, sf_dir, "customer").select(F.concat(F.lit("nation_"), F.col("c_custkey") % 30).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return analytics.replay(calls, n, "name", ["_9"]), analytics.replay(calls, n.where("n_nationkey % 5 > 0"), "name", ["_9"])


def replay_resolve(spark, sf_dir):
    return _versions(spark, sf_dir)[0]


def replay_diff(spark, sf_dir):
    return analytics.replay_diff(*_versions(spark, sf_dir), ["name"])


def usage_rollup(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumns({"n_in": F.length("text"), "n_out": F.col("turn") + 1})
    return analytics.usage_rollup(c, "conv_id", "turn", "turn", ["n_in", "turn"], "n_out", "role", "turn")


def event_dedupe(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"))
    return prog.event_dedupe(e, ["user_id", "event_type", "hour"])


def phase_rate(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("index", F.col("event_id"))
    return prog.phase_rate(e, ["user_id"], "ts", F.col("event_type") != "signup").select("user_id", "n_gaps", F.round("rate", 3).alias("rate"))


def overall_fraction(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("done")).withColumn("total", F.length("event_type"))
    return prog.overall_fraction(e, "user_id", F.length("event_type")).select("user_id", F.round("fraction", 6).alias("fraction"))


def overall_eta(spark, sf_dir):
    phase = F.element_at(F.array(*[F.lit(p) for p in prog.PHASES]), (F.col("event_id") % 3 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select("user_id", phase.alias("phase"), F.when(F.col("event_type") == "click", "active").when(F.col("event_type") == "view", "pending").otherwise("done").alias("state"), (F.col("event_id") % 20).alias("total"), F.col("value").alias("eta"))
    return prog.overall_eta(e, "user_id").select("user_id", F.round("overall_eta", 3).alias("overall_eta"))


def latest_per_job(spark, sf_dir):
    return prog.live_status(table(spark, sf_dir, "events").withColumnRenamed("event_type", "type"), "user_id", "ts")


def _drained(spark, frame, mode):
    """A stream run to its end; what each batch puts out is written under its number, so that one done again replaces itself."""
    out = scratch(spark)

    def keep(rows, batch):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = frame.writeStream.outputMode(mode).option("checkpointLocation", scratch(spark)).foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(sf_dir)


def progress_stream(spark, sf_dir):
    """State of every job after all its events, by the stateful stream."""
    rows = _drained(spark, prog.progress_stream(_event_stream(spark, sf_dir).withColumnRenamed("event_type", "type"), "user_id"), "update")
    return rows.groupBy("user_id").agg(*[F.max_by(c, "batch").alias(c) for c in ("done", "ended", "errors")])


def windowed_status(spark, sf_dir):
    rows = _drained(spark, prog.windowed_counts(_event_stream(spark, sf_dir), "ts", "event_type", "1 day", "1 day"), "update")  # windows that the watermark has passed leave the state
    return rows.groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))


def html_name_tables(spark, sf_dir):
    """The name tables of whole pages, each of which gets one beside another table at its end."""
    k = F.col("page_id")
    row = F.concat(F.lit("<tr><td>Name "), k, F.lit("</td><td><b>kind "), k % 3, F.lit("</b></td><td>Place "), k % 7, F.lit(", North; South and rest</td></tr>"))
    head = "<table><tr><td>other</td></tr></table><table class=wikitable><tr><th>Grape variety</th><th>Colour</th><th>Regions</th></tr>"
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), F.lit(head), row, F.lit("</table>")).alias("html"))
    found = html.name_tables(html.html_tables(pages, "html", ["page_id"]), ["page_id"], "grape|variety")
    return found.select("page_id", "name", "colour", F.array_join("regions", "|").alias("regions"))


def run_progress(spark, sf_dir):
    """Runs of real event kinds: plans, phases that start, count items and end, errors that stop what runs."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.create_map(*[F.lit(x) for x in ("signup", "run_plan", "view", "phase_start", "click", "progress", "purchase", "phase_end", "error", "error")])[F.col("event_type")]
    phase = F.when(~F.col("event_type").isin("signup", "error"), F.element_at(F.array(*map(F.lit, prog.PHASES)), (k % 3 + 1).cast("int")))
    rows = e.select(F.col("user_id").alias("run_id"), kind.alias("type"), "ts", phase.alias("phase"), (k % 10).alias("index"), F.lit(12).cast("long").alias("total"))
    return prog.progress(rows.union(rows)).select("run_id", "phase", "state", "done")  # every event twice: replays count once


def _run_events(spark, sf_dir):
    """Events as those of runs that plan, resume, run, pause, end and stop."""
    k, kind = F.col("event_id"), F.col("event_type")
    name = (
        F.when(kind == "signup", F.when(k % 4 == 0, "run_plan").when(k % 4 == 1, "info").otherwise("paused")).when(kind == "view", F.when(k % 2 == 0, "phase_start").otherwise("wine_start"))
        .when(kind == "click", "progress").when(kind == "purchase", F.when(k % 2 == 0, "phase_end").otherwise("progress")).when(k % 2 == 0, "error").otherwise("exit")
    )
    phase = lambda n: F.element_at(F.array(*map(F.lit, prog.PHASES)), (n % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "event_id", "ts", name.alias("type"), F.when(~name.isin("run_plan", "error", "exit"), phase(k)).alias("phase"), (k % 10).alias("index"),
        F.when(k % 5 < 4, 12 + k % 3).alias("total"), F.concat(F.lit("item "), k % 10).alias("name"), (k % 7).alias("cursor"), phase(k).alias("resume_phase"),
        F.when(k % 3 < 2, phase(F.floor(k / 3))).alias("stop_after"),
    )


def run_bars(spark, sf_dir):
    """Every phase's bar by the full state machine, over each event twice: replays count once."""
    rows = _run_events(spark, sf_dir)
    return prog.run_bars(rows.union(rows), seq="event_id")


def bars_eta(spark, sf_dir):
    """Seconds left at the time of a run's last event; phases of odd totals have a rate of their own, of 10 seconds."""
    rows = _run_events(spark, sf_dir)
    bars = prog.run_bars(rows, seq="event_id").join(rows.groupBy("run_id").agg(F.max(prog.seconds("ts")).alias("now")), "run_id")
    return prog.bars_eta(bars, "run_id", F.when(F.col("total") % 2 == 1, 10.0), F.col("now")).select("run_id", F.round("eta", 3).alias("eta"))


def parse_reply(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    made = F.when(F.col("doc_id") % 10 == 0, "no reply").otherwise(F.concat(F.lit('Sure: {"1": '), F.col("n_chars") % 150, F.lit(', "2": {"score": '), F.col("doc_id") % 90, F.lit(', "facts": ["region", "bad", "grape"]}} ok')))
    reply = d.select("doc_id", scoring.parse_reply(made).alias("r"))
    one = lambda i: F.try_element_at("r", F.lit(i))
    return reply.select("doc_id", one("1").score.alias("s1"), one("2").score.alias("s2"), F.array_join(one("2").facts, ",").alias("f2"))


def _forgetful(name, bodies):
    """The lexical scorer, which leaves out bodies whose length is a multiple of 5."""
    return {i: r for i, r in scoring.lexical_scorer(name, bodies).items() if len(bodies[i]) % 5}


def reask_loop(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("product_id"), "doc_id", F.lit("the and for").alias("name"), F.col("text").alias("body"))
    out = scoring.reask_missing(rows, ["product_id", "doc_id"], [_forgetful, scoring.lexical_scorer])
    return out.select("doc_id", "score", "unscored")


def score_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("hay"), F.split(F.lower("source"), "(?=[0-9])").alias("tokens"), F.lit(None).cast("string").alias("dropped_reason"))
    return scoring.producer_gate(rows, "tokens", "hay").select("doc_id", "dropped_reason")


QUERIES = {f.__name__: f for f in (
    protected_upsert, apply_tags, apply_edits, reset_human, skip_human, legacy_status, export_tags, render_tags, status_counts, retention, history_backfill, product_history, run_results,
    run_summary, run_overview, run_files, matching_runs, remaining, phase_counts, run_outcome, tool_call_counts, submitted_values, submit_attempts, replay_resolve, replay_diff, usage_rollup, event_dedupe, phase_rate,
    overall_fraction, overall_eta, latest_per_job, progress_stream, windowed_status, html_name_tables, run_progress, run_bars, bars_eta, parse_reply, reask_loop, score_gate,
)}

STORE = """WITH s AS (SELECT c_custkey, c_name, c_acctbal - 1 AS c_acctbal, 'old' AS note, CASE WHEN c_custkey % 7 = 0 THEN 'human' WHEN c_custkey % 3 = 0 THEN 'model' ELSE 'pending' END AS tag_status,
  CASE WHEN c_custkey % 4 = 0 THEN 'red' END AS category, c_custkey % 8 = 0 AS category_inferred FROM customer WHERE c_custkey % 2 = 0)
"""
CALLS = """WITH c AS (SELECT user_id, event_type, event_id, CASE WHEN event_type = 'click' THEN 'submit_tags' ELSE 'lookup_region' END AS kind FROM events WHERE event_id % 50 <> 0)
"""
REPLAY = """WITH c AS (SELECT 'nation_' || (c_custkey % 30) AS name, count(*) AS n FROM customer GROUP BY 1), d AS (SELECT lower(n_name) AS l, n_nationkey AS k FROM nation),
a AS (SELECT name, n, CASE WHEN contains(name, '_9') THEN 'phrase' WHEN l IS NULL THEN 'unknown' WHEN k % 4 = 0 THEN 'placeholder' ELSE 'ok' END AS status FROM c LEFT JOIN d ON l = name),
b AS (SELECT name, n, CASE WHEN contains(name, '_9') THEN 'phrase' WHEN l IS NULL THEN 'unknown' WHEN k % 4 = 0 THEN 'placeholder' ELSE 'ok' END AS status FROM c LEFT JOIN (SELECT * FROM d WHERE k % 5 > 0) ON l = name)
"""

RUN_LOGS = """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_id, month(o_orderdate)::INT AS mo, o_orderkey AS id FROM orders),
g AS (SELECT DISTINCT run_id, CASE l_returnflag WHEN 'N' THEN 'search' WHEN 'A' THEN 'score' ELSE 'tag' END AS phase, id FROM o JOIN lineitem ON l_orderkey = id),
f AS (SELECT DISTINCT run_id, id FROM o JOIN lineitem ON l_orderkey = id WHERE l_linestatus = 'F')
"""

BARS = """WITH e AS (SELECT *, CASE event_type WHEN 'signup' THEN ['run_plan', 'info', 'paused', 'paused'][event_id % 4 + 1] WHEN 'view' THEN ['phase_start', 'wine_start'][event_id % 2 + 1]
  WHEN 'click' THEN 'progress' WHEN 'purchase' THEN ['phase_end', 'progress'][event_id % 2 + 1] ELSE 'stop' END AS kind, event_id % 3 AS ph, CASE WHEN event_id % 5 < 4 THEN 12 + event_id % 3 END AS tot FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, coalesce(list_position(['info', 'run_plan', 'phase_start', 'wine_start', 'progress', 'phase_end'], kind), 7), event_id) AS i FROM e),
p AS (SELECT user_id, max(i) FILTER (kind = 'run_plan' OR (kind = 'info' AND tot IS NOT NULL)) AS pi, max(i) FILTER (kind = 'stop') AS si FROM o GROUP BY 1),
r AS (SELECT p.user_id, pi, si, coalesce(tot, 0) AS ptot, event_id % 7 AS cur, ph AS first, CASE WHEN kind = 'run_plan' AND event_id % 3 < 2 THEN (event_id // 3) % 3 END AS last FROM p LEFT JOIN o ON o.user_id = p.user_id AND i = pi),
f AS (SELECT o.* FROM o JOIN p USING (user_id) WHERE kind IN ('phase_start', 'wine_start', 'progress', 'phase_end') AND i > coalesce(pi, 0)),
x AS (SELECT user_id, ph, min(i) FILTER (kind = 'phase_end') AS ei FROM f GROUP BY 1, 2),
g AS (SELECT user_id, ph, max(i) AS mi, arg_max(tot, i) FILTER (tot IS NOT NULL) AS stot, max(event_id % 10 + 1) FILTER (kind = 'progress') AS dn, arg_max(kind, i) AS lk, arg_max(event_id, i) AS le, arg_max(ts, i) AS lt
  FROM f JOIN x USING (user_id, ph) WHERE kind <> 'phase_end' AND (ei IS NULL OR i < ei) GROUP BY 1, 2),
b AS (SELECT r.*, z.ph, ei, mi, lk, le, lt, coalesce(z.ph < first, FALSE) AS pre, CASE WHEN coalesce(z.ph < first, FALSE) THEN ptot ELSE coalesce(stot, CASE WHEN pi IS NULL THEN 0 ELSE ptot END) END AS tot,
  greatest(CASE WHEN z.ph = first THEN least(cur, ptot) ELSE 0 END, coalesce(dn, 0)) AS n FROM r CROSS JOIN (SELECT unnest([0, 1, 2]) AS ph) z LEFT JOIN x ON x.user_id = r.user_id AND x.ph = z.ph LEFT JOIN g ON g.user_id = r.user_id AND g.ph = z.ph),
c AS (SELECT *, CASE WHEN pre THEN tot WHEN ei IS NOT NULL THEN greatest(n, tot) ELSE n END AS done, CASE WHEN pre OR ei IS NOT NULL THEN 'done' WHEN mi IS NULL THEN 'pending' WHEN si > mi THEN 'stopped' ELSE 'running' END AS state FROM b),
bars AS (SELECT user_id AS run_id, ['search', 'score', 'tag'][ph + 1] AS phase, state, done::BIGINT AS done, tot::BIGINT AS total, CASE WHEN last >= first THEN ph <= last ELSE TRUE END AS in_run, pi IS NOT NULL AS planned,
  CASE WHEN sh THEN CASE WHEN lk = 'wine_start' THEN le % 10 ELSE done END END::BIGINT AS current_index, CASE WHEN sh AND lk = 'wine_start' THEN 'item ' || le % 10 END AS current_name, CASE WHEN sh THEN lt END AS since
  FROM (SELECT *, state = 'running' AND (lk <> 'progress' OR done < tot) AS sh FROM c))
"""

SQL = {
    "protected_upsert": STORE + """, f AS (SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 5 = 0 THEN 'white' END AS category FROM customer)
SELECT f.c_custkey, f.c_name, round(f.c_acctbal, 2) AS c_acctbal, note, coalesce(tag_status, 'pending') AS tag_status,
  CASE WHEN category_inferred AND f.category IS NULL THEN s.category ELSE f.category END AS category, CASE WHEN category_inferred AND f.category IS NULL THEN TRUE ELSE FALSE END AS category_inferred
FROM f LEFT JOIN s USING (c_custkey)""",
    "apply_tags": STORE + """, u AS (SELECT *, c_custkey % 3 = 0 AND tag_status <> 'human' AS t FROM s)
SELECT c_custkey, CASE WHEN t THEN CASE WHEN c_custkey % 6 = 0 THEN 'tagged' END ELSE note END AS note, CASE WHEN t AND (category IS NULL OR category_inferred) THEN 'rose' ELSE category END AS category,
  category_inferred OR (t AND category IS NULL) AS category_inferred, tag_status FROM u""",
    "apply_edits": STORE + """SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE note END AS note,
  CASE WHEN c_custkey % 20 = 0 THEN 'human' WHEN c_custkey % 10 = 0 THEN 'needs_review' ELSE tag_status END AS tag_status FROM s""",
    "reset_human": STORE + ", b(pos, status) AS (VALUES (0, 'pending'), (1, 'model'), (2, 'needs_review'), (3, 'human')) SELECT pos, status, (SELECT count(*) FROM s WHERE CASE tag_status WHEN 'human' THEN 'pending' ELSE tag_status END = b.status) AS n FROM b",
    "skip_human": "SELECT o_orderkey, o_custkey AS c_custkey FROM orders WHERE NOT (o_custkey % 14 = 0)",
    "legacy_status": "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'model' WHEN 1 THEN 'human' WHEN 2 THEN 'model' ELSE 'pending' END AS status FROM customer",
    "export_tags": "SELECT c_custkey AS id, c_name AS name, concat_ws('; ', CASE WHEN c_custkey % 9 > 0 THEN r_name END, n_name, lower(c_mktsegment)) AS tags FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "render_tags": """SELECT c_custkey, nullif(concat_ws('; ', CASE WHEN c_custkey % 3 > 0 THEN 'France' END, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END,
  CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'Blend' ELSE 'Single Varietal' END END, CASE WHEN c_custkey % 5 = 0 THEN 'Organic' END), '') AS tags FROM customer""",
    "status_counts": "WITH b(pos, status) AS (VALUES (0, 'F'), (1, 'O'), (2, 'P'), (3, 'Z')) SELECT pos, status, (SELECT count(*) FROM orders WHERE o_orderstatus = status) AS n FROM b",
    "retention": "SELECT o_custkey, o_orderkey AS run_id, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) <= 5 THEN 'keep' WHEN o_orderkey <= 7 AND o_orderkey >= 1 THEN 'skip' ELSE 'delete' END AS action FROM orders",
    "history_backfill": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE (SELECT max(o_orderkey) FROM orders WHERE o_custkey = c_custkey) END AS tag_run_id FROM customer",
    "product_history": "SELECT id, run_id, row_number() OVER (PARTITION BY id ORDER BY run_id DESC)::INT AS run_no FROM (SELECT DISTINCT o_custkey AS id, strftime(o_orderdate, '%Y-%m') AS run_id FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)",
    "run_results": STORE + """, p AS (SELECT o_custkey AS k, count(*) AS n, sum(l_quantity) AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_orderkey, c_name, CASE WHEN n IS NULL THEN NULL WHEN n % 5 > 0 THEN 'ok' ELSE 'empty' END AS search_status, CASE WHEN n % 5 > 0 THEN CASE WHEN q % 3 > 0 THEN 'ok' ELSE 'no_context' END END AS score_status,
  CASE WHEN n % 7 > 0 THEN CASE WHEN n % 3 > 0 THEN 'ok' WHEN n % 5 > 0 AND NOT (q % 3 > 0) THEN 'no_context' ELSE 'no_submit' END END AS tag_phase,
  CASE WHEN n % 7 > 0 THEN 'model' ELSE 'pending' END AS run_status, coalesce(tag_status = 'human', FALSE) AS human_in_store
FROM orders LEFT JOIN s ON o_custkey = c_custkey LEFT JOIN p ON p.k = o_custkey""",
    "run_summary": "SELECT strftime(o_orderdate, '%Y-%m') AS run_id, count(*) AS products, sum((o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'))::INT)::BIGINT AS tagged FROM orders GROUP BY 1",
    "run_overview": RUN_LOGS + """SELECT r.run_id, CASE WHEN mo % 4 = 0 THEN 'paused' ELSE 'done' END AS status, p.phase, CASE WHEN said THEN CASE WHEN mo % 2 = 0 THEN 'done' ELSE 'running' END END AS state,
  CASE WHEN said THEN CASE p.phase WHEN 'search' THEN mo ELSE mo * 2 END END AS done, products, coalesce((SELECT count(*) FROM f WHERE f.run_id = r.run_id), 0) AS tagged,
  coalesce((SELECT count(*) FROM g WHERE g.run_id = r.run_id AND g.phase = p.phase), 0) AS logged
FROM (SELECT run_id, mo, count(*) AS products FROM o GROUP BY ALL) r, (VALUES ('search'), ('score'), ('tag')) p(phase), LATERAL (SELECT p.phase = 'search' OR (p.phase = 'tag' AND mo % 3 > 0) AS said)""",
    "run_files": RUN_LOGS + "SELECT run_id, phase, id FROM g UNION ALL SELECT run_id, 'final', id FROM f",
    "matching_runs": "SELECT run_id, run_id = 'same' AS same FROM (VALUES ('same'), ('backwards'), ('shorter'), ('longer'), ('swapped')) t(run_id)",
    "remaining": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "phase_counts": """WITH o AS (SELECT *, year(o_orderdate)::INT AS run_id, o_orderstatus = 'P' AS sk, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey % 4 END AS sn FROM orders)
SELECT run_id, sum((NOT sk)::INT)::BIGINT AS searched, sum(sk::INT)::BIGINT AS skipped_human, sum((NOT sk AND sn = 0)::INT)::BIGINT AS no_snippets, sum(sn)::BIGINT AS snippets_total,
  sum((o_orderkey % 4 > 0)::INT)::BIGINT AS scored, sum((o_orderkey % 4 > 0 AND o_orderkey % 3 > 0)::INT)::BIGINT AS with_context, sum((o_orderkey % 4 > 0 AND o_orderkey % 3 = 0)::INT)::BIGINT AS no_context,
  sum((o_orderkey % 3 > 0)::INT)::BIGINT AS tagged, sum((o_orderkey % 3 > 0 AND o_totalprice > 100000)::INT)::BIGINT AS model, sum((o_orderkey % 3 > 0 AND NOT o_totalprice > 100000)::INT)::BIGINT AS needs_review FROM o GROUP BY 1""",
    "run_outcome": STORE + "SELECT sum((tag_status = 'model')::INT)::BIGINT AS model, sum((tag_status = 'needs_review')::INT)::BIGINT AS needs_review, sum((tag_status = 'human')::INT)::BIGINT AS human FROM s WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "tool_call_counts": CALLS + "SELECT kind, 'name ' || (event_id % 9) AS name, NULL::VARCHAR AS scope, count(*) AS n FROM c GROUP BY 1, 2",
    "submitted_values": CALLS + "SELECT 'region' AS kind, event_type AS name, count(*) AS n FROM c WHERE kind = 'submit_tags' GROUP BY 2",
    "submit_attempts": "SELECT user_id, sum((event_type = 'view')::INT)::INT AS attempts FROM events GROUP BY 1",
    "replay_resolve": REPLAY + "SELECT name, n, status FROM a",
    "replay_diff": REPLAY + "SELECT a.name, a.n, a.status AS before, b.status AS after FROM a JOIN b USING (name) WHERE a.status <> b.status",
    "usage_rollup": """WITH c AS (SELECT conv_id, turn, role, length(text) + turn AS ctx, row_number() OVER (PARTITION BY conv_id, turn ORDER BY turn) AS rn FROM conversations)
SELECT conv_id, count(*) AS messages, arg_min(ctx, turn) AS base, max(ctx) AS peak, sum(ctx)::BIGINT AS context_sum, sum(turn + 1)::BIGINT AS output_sum, string_agg(DISTINCT role, ',' ORDER BY role) AS models, min(turn) AS started FROM c WHERE rn = 1 GROUP BY 1""",
    "event_dedupe": "SELECT DISTINCT user_id, event_type, date_trunc('hour', ts)::TIMESTAMP AS hour FROM events",
    "phase_rate": """WITH g AS (SELECT user_id, event_type <> 'signup' AS c, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id, sum((c AND gap IS NOT NULL)::INT)::BIGINT AS n_gaps, round(CASE WHEN sum((c AND gap IS NOT NULL)::INT) >= 3 THEN avg(gap) FILTER (c) END, 3) AS rate FROM g GROUP BY 1""",
    "overall_fraction": """WITH e AS (SELECT user_id, length(event_type) AS w, count(*) AS n FROM events GROUP BY user_id, event_type, length(event_type))
SELECT user_id, round(sum(w * least(1.0::DOUBLE, n / w)) / sum(w), 6) AS fraction FROM e GROUP BY 1""",
    "overall_eta": """WITH e AS (SELECT user_id, CASE event_id % 3 WHEN 0 THEN 17.0 WHEN 1 THEN 60.0 ELSE 30.0 END::DOUBLE AS typ, event_type AS t, event_id % 20 AS total, value FROM events)
SELECT user_id, round(CASE WHEN max((t = 'click')::INT) = 1 THEN sum(CASE WHEN t = 'click' THEN value WHEN t = 'view' THEN total * typ ELSE 0 END) END, 3) AS overall_eta FROM e GROUP BY 1""",
    "latest_per_job": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS latest, max(ts) AS at, count(*) AS n_events FROM events GROUP BY 1",
    "progress_stream": """WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type, event_id) AS i FROM events),
p AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN i ELSE 0 END) OVER (PARTITION BY user_id) AS plan FROM s),
q AS (SELECT *, min(CASE WHEN event_type = 'purchase' AND i > plan THEN i END) OVER (PARTITION BY user_id) AS fin FROM p)
SELECT user_id, sum((event_type = 'click' AND i > plan AND (fin IS NULL OR i < fin))::INT)::BIGINT AS done, max((event_type = 'purchase' AND i > plan)::INT)::BIGINT AS ended, sum((event_type = 'error' AND i > plan)::INT)::BIGINT AS errors FROM q GROUP BY 1""",
    "windowed_status": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "html_name_tables": "SELECT page_id, 'Name ' || page_id AS name, 'kind ' || page_id % 3 AS colour, 'Place ' || page_id % 7 || '|North|South|rest' AS regions FROM pages",
    "run_progress": """WITH p AS (SELECT user_id, max(ts) FILTER (event_type = 'signup') AS plan FROM events GROUP BY 1), e AS (SELECT events.*, ['search', 'score', 'tag'][event_id % 3 + 1] AS phase FROM events JOIN p USING (user_id) WHERE plan IS NULL OR ts >= plan),
s AS (SELECT user_id, count(*) AS errors FROM e WHERE event_type = 'error' GROUP BY 1), g AS (SELECT user_id, phase, bool_or(event_type = 'purchase') AS ended, bool_or(event_type = 'view') AS started,
  coalesce(max(event_id % 10 + 1) FILTER (event_type = 'click'), 0) AS done FROM e WHERE event_type NOT IN ('signup', 'error') GROUP BY 1, 2)
SELECT user_id AS run_id, phase, CASE WHEN ended THEN 'done' WHEN errors > 0 THEN 'stopped' WHEN started OR done > 0 THEN 'active' ELSE 'pending' END AS state, CASE WHEN ended THEN 12 ELSE done END AS done FROM g LEFT JOIN s USING (user_id)""",
    "run_bars": BARS + "SELECT * FROM bars",
    "bars_eta": BARS + """, n AS (SELECT user_id AS run_id, epoch(max(ts)) AS now FROM events GROUP BY 1),
l AS (SELECT *, greatest(0, total - done) AS todo, CASE phase WHEN 'search' THEN 17.0 WHEN 'score' THEN 60.0 ELSE 30.0 END::DOUBLE AS typ FROM bars JOIN n USING (run_id))
SELECT run_id, round(CASE WHEN bool_or(state = 'running') THEN sum(CASE WHEN NOT in_run OR state IN ('done', 'stopped') THEN 0 WHEN state = 'running' AND total % 2 = 1
  THEN greatest(0, todo * 10.0::DOUBLE - greatest(0, coalesce(now - epoch(since), 0))) ELSE todo * typ END) END, 3) AS eta FROM l GROUP BY 1""",
    "parse_reply": """SELECT doc_id, CASE WHEN doc_id % 10 > 0 THEN least(100, n_chars % 150)::INT END AS s1, CASE WHEN doc_id % 10 > 0 THEN (doc_id % 90)::INT END AS s2, CASE WHEN doc_id % 10 > 0 THEN 'grape,region' END AS f2 FROM documents""",
    "reask_loop": r"""SELECT doc_id, round_even(100 * (SELECT count(DISTINCT w) FROM unnest(regexp_split_to_array(lower(text), '\s+')) t(w) WHERE w IN ('the', 'and', 'for')) / 3, 0)::INT AS score, FALSE AS unscored FROM documents""",
    "score_gate": "SELECT doc_id, CASE WHEN NOT (contains(lower(text), 'src') OR contains(lower(text), substr(source, 4, 1)) OR (length(source) > 4 AND contains(lower(text), substr(source, 5, 1)))) THEN 'producer_absent' END AS dropped_reason FROM documents",
}
