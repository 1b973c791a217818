"""Round trips through the sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.common import scratch, table
from sievework.operators import rules
from sievework.plans.ingest_queries import CASCADE, decided
from sievework.sources import catalog, entries, sinks

EVENT = "event_id long, ts string, user_id long, event_type string, value double"


def _export(spark, sf_dir):
    """The parts as a CSV export: odd headers, quotes and line ends in a field, blank rows, an empty column."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias(" Part Key"), F.concat("p_name", F.lit(' "a, b"'), F.when(F.col("p_partkey") % 4 == 0, "\nsecond line").otherwise("")).alias("P.Name"),
        F.col("p_retailprice").cast("string").alias("Retail-Price"), F.when(F.col("p_partkey") % 5 > 0, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".9"))).alias("SIZE"), F.lit(None).cast("string").alias("Unused"),
    )
    blank = table(spark, sf_dir, "supplier").select(*[F.lit(" ").alias(c) for c in part.columns])
    path = f"{scratch(spark)}.csv"
    part.union(blank).write.options(header=True, escape='"', quoteAll=True, nullValue="").csv(path)
    return path


def csv_products(spark, sf_dir):
    rows = catalog.read_export(spark, _export(spark, sf_dir), ["part_key", "p_name"], ["unused"])
    typed = catalog.load_products(rows, ["retail_price"], ["size"])
    return typed.select(F.col("part_key").cast("long").alias("p_partkey"), "p_name", "retail_price", "size")


def csv_row_count(spark, sf_dir):
    return spark.createDataFrame([(catalog.row_count(spark, _export(spark, sf_dir)),)], "n long")


def newest_export(spark, sf_dir):
    """Two files in a folder, one after the other, and a folder that is not there: the later file's rows."""
    folder = scratch(spark)
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).coalesce(1).write.mode("append").options(header=True).csv(folder)
    table(spark, sf_dir, "region").select(F.col("r_name").alias("name")).coalesce(1).write.mode("append").options(header=True).csv(folder)
    return catalog.read_export(spark, catalog.newest_file(spark, f"{folder}-none", folder))


def phase_logs(spark, sf_dir):
    """One JSON file per region and phase, one of them unreadable."""
    folder = scratch(spark)
    logs = table(spark, sf_dir, "region").select(F.concat(F.lit("run"), F.col("r_regionkey") % 2).alias("run_id"), F.lit("score").alias("phase"), "r_regionkey", F.col("r_name").alias("name"))
    logs.repartition("r_regionkey").write.option("maxRecordsPerFile", 1).partitionBy("run_id", "phase").json(folder)
    spark.range(1).select(F.lit("{no json").alias("value")).write.mode("append").text(f"{folder}/run_id=run9/phase=score")
    return catalog.read_logs(spark, folder, "r_regionkey long, name string, run_id string, phase string").select("run_id", "phase", "r_regionkey", "name")


def _event_lines(spark, sf_dir, folder, part):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value")
    sinks.append_events(rows.where(F.col("event_id") % 2 == part), folder)


def event_lines(spark, sf_dir):
    """Events appended twice, with lines between that are no JSON."""
    folder = scratch(spark)
    _event_lines(spark, sf_dir, folder, 0)
    table(spark, sf_dir, "nation").select(F.concat(F.lit("{broken "), "n_name").alias("value")).write.mode("append").text(folder)
    _event_lines(spark, sf_dir, folder, 1)
    return rules.event_filter(catalog.read_events(spark, folder, EVENT).withColumnRenamed("event_type", "type"), ["error"])


def event_tail(spark, sf_dir):
    folder = scratch(spark)
    _event_lines(spark, sf_dir, folder, 0)
    return catalog.tail(catalog.read_events(spark, folder, EVENT), 20).select("event_id")


def event_tail_all(spark, sf_dir):
    """The newest of all events, read from appended lines."""
    folder = scratch(spark)
    for part in (0, 1):
        _event_lines(spark, sf_dir, folder, part)
    return catalog.tail(catalog.read_events(spark, folder, EVENT), 50).select("event_id", "event_type")


def event_resume(spark, sf_dir):
    """A stream over appended lines, stopped and resumed from its checkpoint: each event arrives once."""
    folder, out, state = scratch(spark), scratch(spark), scratch(spark)
    for part in (0, 1):
        _event_lines(spark, sf_dir, folder, part)
        query = catalog.read_events(spark, folder, EVENT, stream=True).writeStream.format("parquet").option("checkpointLocation", state).option("path", out).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(out).select("event_id", "event_type", "value")


def written_decisions(spark, sf_dir):
    folder = scratch(spark)
    sinks.write_decided(decided(spark, sf_dir), f"{folder}/kept", f"{folder}/excluded")
    kept, out = (spark.read.options(header=True, escape='"').csv(f"{folder}/{x}") for x in ("kept", "excluded"))
    none = F.lit(None).cast("string")
    rows = kept.select("p_partkey", "ingest_pass", none.alias("excluded_by")).union(out.select("p_partkey", none, "excluded_by"))
    return rows.withColumn("p_partkey", F.col("p_partkey").cast("long"))


def written_summary(spark, sf_dir):
    path = scratch(spark)
    sinks.write_summary(rules.decision_summary(decided(spark, sf_dir), "p_partkey"), path)
    return spark.read.schema("level string, keep boolean, stage string, match string, grp string, n long, first_row long").json(path).select("level", "keep", "stage", "match", "grp", "n")


def rewritten_phase_log(spark, sf_dir):
    """The log of all runs, of which one is written again: the others stay."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("run"), F.col("o_orderkey") % 3).alias("run_id"), F.lit(1).alias("version"))
    sinks.write_phase_log(rows, path)
    sinks.write_phase_log(rows.where("run_id = 'run1'").withColumn("version", F.lit(2)), path)
    return spark.read.parquet(path).groupBy("run_id", "version").agg(F.count("*").alias("n"))


def saved_store(spark, sf_dir):
    """Two versions of a store: the pointer names the second."""
    root = scratch(spark)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sinks.save_store(c, root, "a")
    sinks.save_store(c.withColumn("c_name", F.upper("c_name")), root, "b")
    return sinks.load_store(spark, root).where("generated_at IS NOT NULL").select("c_custkey", "c_name")


def store_commits(spark, sf_dir):
    """A store that two writers change from one version: the second is refused and applies its change to what the first has made of it."""
    root, key = scratch(spark), F.col("c_custkey")
    base = sinks.commit_store(table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("pending").alias("tag_status"), F.lit(0).alias("edits")), root, 0)
    held = sinks.load_store(spark, root, base).drop("generated_at")
    sinks.commit_store(held.withColumns({"tag_status": F.when(key % 3 == 0, "model").otherwise(F.col("tag_status")), "edits": F.col("edits") + 1}), root, base)
    human = lambda df: df.withColumns({"tag_status": F.when(key % 5 == 0, "human").otherwise(F.col("tag_status")), "edits": F.col("edits") + 1})
    refused = False
    try:
        sinks.commit_store(human(held), root, base)
    except sinks.ConflictError:
        refused = True
    version = sinks.update_store(spark, root, human)
    return sinks.load_store(spark, root).select("c_custkey", "tag_status", "edits", F.lit(version).alias("version"), F.lit(refused).alias("refused"))


ENTRY_FIELDS = {
    "name": entries.Field(required=True), "color": entries.Field(pattern="red|white|rose|gris"), "synonyms": entries.Field(many=True), "qid": entries.Field(pattern=r"Q\d+|none"),
}


def _entries(spark, sf_dir):
    """Parts as JSON entries, some with faults, and a lock map of the ids of some."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.when(k % 19 == 0, '" "').when(k % 23 == 0, "17").otherwise(F.concat(F.lit('"'), "p_name", F.lit(" "), k, F.lit(' "')))
    color = F.when(k % 5 == 0, '"red"').when(k % 5 == 1, '"blue"').when(k % 5 == 2, "null").otherwise('"white"')
    synonyms = F.when(k % 4 == 0, F.concat(F.lit('[" a'), k, F.lit('", "", "b"]'))).when(k % 4 == 1, "[]").when(k % 4 == 2, '"one"').otherwise("[1, 2]")
    qid = F.when(k % 6 == 0, F.concat(F.lit(', "qid": "Q'), k, F.lit('"'))).when(k % 6 == 1, ', "qid": "none"').when(k % 6 == 2, ', "qid": "X1"').otherwise("")
    text = F.when(k % 29 == 0, "[no entry").otherwise(F.concat(F.lit('{"name": '), name, F.lit(', "color": '), color, F.lit(', "synonyms": '), synonyms, qid, F.lit("}")))
    lock = p.where(k % 2 == 1).select(F.concat("p_name", F.lit(" "), k).alias("key"), F.concat(F.lit("L"), k).alias("id"))
    return entries.load_entries(p.select("p_partkey", text.alias("entry")), "entry", ENTRY_FIELDS), lock


def loaded_entries(spark, sf_dir):
    rows, lock = _entries(spark, sf_dir)
    return entries.apply_lock(rows, lock, F.col("name")).select("p_partkey", "name", "color", F.array_join("synonyms", "|").alias("synonyms"), "qid", "no_id")


def entry_faults(spark, sf_dir):
    return _entries(spark, sf_dir)[0].select("p_partkey", F.explode("faults").alias("f")).select("p_partkey", "f.rule", "f.message")


QUERIES = {f.__name__: f for f in (
    csv_products, csv_row_count, newest_export, phase_logs, event_lines, event_tail, event_tail_all, event_resume, written_decisions, written_summary, rewritten_phase_log, saved_store, store_commits, loaded_entries, entry_faults,
)}

SQL = {
    "csv_products": """SELECT p_partkey, p_name || ' "a, b"' || CASE WHEN p_partkey % 4 = 0 THEN chr(10) || 'second line' ELSE '' END AS p_name, p_retailprice AS retail_price, CASE WHEN p_partkey % 5 > 0 THEN p_size END AS size FROM part""",
    "csv_row_count": "SELECT count(*) AS n FROM part",
    "newest_export": "SELECT r_name AS name FROM region",
    "phase_logs": "SELECT 'run' || r_regionkey % 2 AS run_id, 'score' AS phase, r_regionkey, r_name AS name FROM region UNION ALL SELECT 'run9', 'score', NULL, NULL",
    "event_lines": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || rtrim(rtrim(strftime(ts, '.%f'), '0'), '.') AS ts, user_id, event_type AS type, value FROM events WHERE event_type <> 'error'",
    "event_tail": "SELECT event_id FROM events WHERE event_id % 2 = 0 ORDER BY ts DESC LIMIT 20",
    "event_tail_all": "SELECT event_id, event_type FROM events ORDER BY ts DESC LIMIT 50",
    "event_resume": "SELECT event_id, event_type, value FROM events",
    "written_decisions": CASCADE + "SELECT p_partkey, CASE WHEN keep THEN stage END AS ingest_pass, CASE WHEN NOT keep THEN stage END AS excluded_by FROM d",
    "written_summary": CASCADE + """
SELECT 'stage' AS level, keep, stage, NULL AS match, NULL AS grp, count(*) AS n FROM d GROUP BY keep, stage
UNION ALL SELECT 'match', keep, stage, match, NULL, count(*) FROM d WHERE match IS NOT NULL GROUP BY keep, stage, match
UNION ALL SELECT 'group', keep, stage, NULL, grp, count(*) FROM d WHERE grp IS NOT NULL GROUP BY keep, stage, grp""",
    "rewritten_phase_log": "SELECT 'run' || o_orderkey % 3 AS run_id, CASE WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END AS version, count(*) AS n FROM orders GROUP BY 1, 2",
    "loaded_entries": """WITH e AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 29 > 0 AND p_partkey % 19 > 0 AND p_partkey % 23 > 0 THEN p_name || ' ' || p_partkey END AS name, p_partkey % 29 > 0 AS ok FROM part)
SELECT k AS p_partkey, name, CASE WHEN ok THEN CASE k % 5 WHEN 0 THEN 'red' WHEN 1 THEN 'blue' WHEN 2 THEN NULL ELSE 'white' END END AS color, CASE WHEN ok AND k % 4 = 0 THEN 'a' || k || '|b' ELSE '' END AS synonyms,
  CASE WHEN ok AND k % 6 = 1 THEN NULL WHEN ok AND k % 6 = 0 THEN 'Q' || k WHEN ok AND k % 6 = 2 THEN 'X1' WHEN name IS NOT NULL AND k % 2 = 1 THEN 'L' || k END AS qid, ok AND k % 6 = 1 AS no_id FROM e""",
    "entry_faults": """WITH e AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 29 > 0)
SELECT p_partkey, 'no_entry' AS rule, 'is no entry' AS message FROM part WHERE p_partkey % 29 = 0
UNION ALL SELECT k, 'required_name', 'is required' FROM e WHERE k % 19 = 0
UNION ALL SELECT k, 'type_name', 'expected a string, got BIGINT' FROM e WHERE k % 23 = 0 AND k % 19 > 0
UNION ALL SELECT k, 'format_color', 'is blue' FROM e WHERE k % 5 = 1
UNION ALL SELECT k, 'type_synonyms', CASE k % 4 WHEN 2 THEN 'expected a list of strings, got STRING' ELSE 'expected a list of strings, got ARRAY<BIGINT>' END FROM e WHERE k % 4 > 1
UNION ALL SELECT k, 'format_qid', 'is X1' FROM e WHERE k % 6 = 2""",
    "store_commits": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'human' WHEN c_custkey % 3 = 0 THEN 'model' ELSE 'pending' END AS tag_status, 2 AS edits, 3 AS version, TRUE AS refused FROM customer",
    "saved_store": "SELECT c_custkey, upper(c_name) AS c_name FROM customer",
}
