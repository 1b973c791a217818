"""Messages as rows against transcripts, batches of products, saved lists and run phases."""

import json
import random


from sievework.operators import analytics, scoring, store

CALL = "struct<id:string,function:struct<name:string,arguments:string>>"


def test_messages_count_what_transcripts_count(spark):
    rng = random.Random(1)
    rows, texts = [], []
    for conv in range(12):
        messages = []
        for _ in range(rng.randrange(8)):
            args = rng.choice(['{"name": "a", "region": ["x", "y"]}', '{"name": "b", "country": "fr"}', "no json", '{"region": []}', '{"name": null}', "{}"])
            calls = [(str(i), (rng.choice(["look", "submit_tags"]), args)) for i in range(rng.randrange(3))]
            role, name = rng.choice([("assistant", None), ("tool", "submit_tags"), ("tool", "look")])
            messages.append((role, "", name, calls))
            as_object = args.startswith("{") and rng.random() < 0.5
            told = [{"id": i, "function": {"name": n, "arguments": json.loads(a) if as_object else a}} for i, (n, a) in calls]
            texts.append((conv, json.dumps({"role": role, "name": name, "tool_calls": told} if told or rng.random() < 0.5 else {"role": role, "name": name})))
        rows.append((conv, messages))
    df = spark.createDataFrame(rows, f"conv int, transcript array<struct<role:string,content:string,name:string,tool_calls:array<{CALL}>>>")
    lines = spark.createDataFrame([*texts, (0, "broken {"), (0, None), (1, "[1, 2]"), (1, '{"tool_calls": 5}')], "conv int, message string")
    same = lambda a, b: sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert same(analytics.tool_calls(df, ["look", "submit_tags"]), analytics.message_tool_calls(lines, "message", ["look", "submit_tags"]))
    assert same(analytics.submitted_values(df, "submit_tags", ["region"]), analytics.message_values(lines, "message", "submit_tags", ["region"]))
    got = {r.conv: r.attempts for r in analytics.message_attempts(lines, "conv", "message").collect()}
    assert got == {r.conv: r.attempts for r in analytics.submit_attempts(df, "conv").collect() if r.conv in got}


def test_batches_follow_products_not_partitions(spark):
    def ranked(name, bodies):
        """Ranks within its batch: the score tells how many rows came with it, and where."""
        return {i: (100 * len(bodies) + sorted(bodies).index(b), [b]) for i, b in enumerate(bodies)}

    rng = random.Random(2)
    rows = [(p, i, f"n{p}", f"b{i % 50:03d}") for i, p in enumerate(rng.choices([None, "a", "b", "c", "hot", "hot", "hot"], k=900))]
    want = {}
    for p in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == p), key=lambda r: r[1])
        for k in range(0, len(own), 8):
            some = [r[3] for r in own[k : k + 8]]
            want |= {r[1]: (100 * len(some) + sorted(some).index(r[3]), [r[3]]) for r in own[k : k + 8]}
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for partitions, batch in ((1, "10000"), (7, "3"), (3, "17")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            df = spark.createDataFrame(rows, "product_id string, i int, name string, body string").repartition(partitions)
            assert {r.i: (r.score, r.facts) for r in scoring.score_batches(df, ranked, order=["i"]).collect()} == want
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert scoring.score_batches(df.limit(0), ranked).count() == 0


def test_saved_lists(spark):
    items = spark.createDataFrame([(0, "a"), (1, "b"), (2, "b")], "pos int, id string")
    saved = [("same", 0, "a"), ("same", 1, "b"), ("same", 2, "b"), ("turned", 0, "b"), ("turned", 1, "a"), ("turned", 2, "b"), ("short", 0, "a"), ("short", 1, "b"), ("null", 0, "a"), ("null", 1, None), ("null", 2, "b")]
    saved += [("long", i, x) for i, x in enumerate("abbb")]
    got = {r.run_id: r.same for r in store.matching_runs(items, spark.createDataFrame(saved, "run_id string, pos int, id string"), "id", "pos").collect()}
    assert got == {"same": True, "turned": False, "short": False, "null": False, "long": False}


def test_overview_of_runs_with_and_without_logs(spark):
    runs = spark.createDataFrame([("r1", "done", {"search": ("ok", 3)}), ("r2", "paused", None)], "run_id string, status string, phases map<string,struct<state:string,n:int>>")
    items, final = spark.createDataFrame([("r1", 1), ("r1", 2), ("r1", 2)], "run_id string, id int"), spark.createDataFrame([("r1", 2)], "run_id string, id int")
    logs = spark.createDataFrame([("r1", "search", 1), ("r1", "search", 1), ("r1", "tag", 2)], "run_id string, phase string, id int")
    rows = store.run_overview(runs, items, final, logs, ("search", "tag"), "id").collect()
    assert [(r.run_id, r.phase, r.info and tuple(r.info), r.products, r.tagged, r.logged) for r in rows] == [
        ("r2", "search", None, 0, 0, 0), ("r2", "tag", None, 0, 0, 0), ("r1", "search", ("ok", 3), 2, 1, 1), ("r1", "tag", None, 2, 1, 1),
    ]
    assert sorted(map(tuple, store.run_files(logs, final, "id").collect())) == [("r1", "final", 2), ("r1", "search", 1), ("r1", "tag", 2)]


def test_retention_of_all_runs_and_of_groups(spark):
    runs = spark.createDataFrame([("a", i) for i in range(6)] + [("b", i) for i in range(10, 13)], "g string, run_id int")
    got = {r.run_id: r.action for r in store.retention(runs, 2, [1, 12]).collect()}
    assert got == {12: "keep", 11: "keep", 10: "delete", 1: "skip", **{i: "delete" for i in (0, 2, 3, 4, 5)}}
    assert {r.run_id: r.action for r in store.retention(runs, 2, [1], ["g"]).collect()} == {5: "keep", 4: "keep", 12: "keep", 11: "keep", 1: "skip", **{i: "delete" for i in (0, 2, 3, 10)}}
    assert store.retention(runs.limit(0), 2).count() == 0
