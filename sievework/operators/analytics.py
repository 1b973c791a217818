"""Counts over runs, phases and transcripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _n(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def phase_counts(search: DataFrame, scorer: DataFrame, final: DataFrame) -> DataFrame:
    """One row per run: what each phase did."""
    a = search.groupBy("run_id").agg(_n(~F.col("skipped")).alias("searched"), _n(F.col("skipped")).alias("skipped_human"),
                                     _n(~F.col("skipped") & (F.col("n_snippets") == 0)).alias("no_snippets"), F.sum("n_snippets").alias("snippets_total"))
    b = scorer.groupBy("run_id").agg(F.count("*").alias("scored"), _n(F.col("has_context")).alias("with_context"), _n(~F.col("has_context")).alias("no_context"))
    c = final.groupBy("run_id").agg(F.count("*").alias("tagged"), _n(F.col("tag_status") == "model").alias("model"), _n(F.col("tag_status") == "needs_review").alias("needs_review"))
    return a.join(b, "run_id", "full").join(c, "run_id", "full")


def best_score(scored: DataFrame, key: str, score: str = "match_score") -> DataFrame:
    """Best score per key, 0 for none."""
    return scored.groupBy(key).agg(F.coalesce(F.max(score), F.lit(0)).alias("best_score"))


def run_outcome(items: DataFrame, store: DataFrame, key: str, statuses: Sequence[str] = ("model", "needs_review", "human")) -> DataFrame:
    """How many of a run's products have each status."""
    return store.join(items.select(key).distinct(), key, "left_semi").agg(*[_n(F.col("tag_status") == s).alias(s) for s in statuses])


def tool_calls(transcripts: DataFrame, names: Sequence[str], argument: str = "name", scope: str = "country") -> DataFrame:
    """Calls of the named tools by (kind, name, scope), from ``transcript ARRAY<STRUCT<..., tool_calls>>``.

    Arguments that are no JSON object are skipped.
    """
    call = transcripts.select(F.explode("transcript").alias("m")).select(F.explode("m.tool_calls").alias("c"))
    call = call.select(F.col("c.function.name").alias("kind"), F.from_json("c.function.arguments", "map<string,string>").alias("a")).where("a IS NOT NULL")
    rows = call.where(F.col("kind").isin(list(names))).select("kind", F.try_element_at("a", F.lit(argument)).alias("name"), F.try_element_at("a", F.lit(scope)).alias("scope"))
    return rows.where("name IS NOT NULL").groupBy("kind", "name", "scope").agg(F.count("*").alias("n"))


def submitted_values(transcripts: DataFrame, tool: str, fields: Sequence[str]) -> DataFrame:
    """Each value of array arguments of a tool, counted by field."""
    call = transcripts.select(F.explode("transcript").alias("m")).select(F.explode("m.tool_calls").alias("c")).where(F.col("c.function.name") == tool)
    schema = "struct<" + ",".join(f"{f}:array<string>" for f in fields) + ">"
    args = call.select(F.from_json("c.function.arguments", schema).alias("a"))
    every = [args.select(F.lit(f).alias("kind"), F.explode(f"a.{f}").alias("name")) for f in fields]
    out = every[0]
    for e in every[1:]:
        out = out.union(e)
    return out.groupBy("kind", "name").agg(F.count("*").alias("n"))


def message_calls(messages: DataFrame, message: str) -> DataFrame:
    """``(kind, arguments)``: the tool calls of ``messages``, one JSON message per row, with arguments as a variant.

    A conversation's messages are rows of their own, so one of any length is read by many tasks.  Arguments may be an object or a string that holds one;
    what is no JSON is skipped, as are messages without calls.
    """
    calls = messages.select(F.explode(F.try_variant_get(F.try_parse_json(message), "$.tool_calls", "array<variant>")).alias("c"))
    told = F.try_variant_get("c", "$.function.arguments", "string")
    return calls.select(F.try_variant_get("c", "$.function.name", "string").alias("kind"), F.try_parse_json(told).alias("arguments")).where("arguments IS NOT NULL")


def message_tool_calls(messages: DataFrame, message: str, names: Sequence[str], argument: str = "name", scope: str = "country") -> DataFrame:
    """``tool_calls`` of messages that are rows of their own: calls of the named tools by (kind, name, scope)."""
    rows = message_calls(messages, message).where(F.col("kind").isin(list(names)))
    rows = rows.select("kind", *[F.try_variant_get("arguments", f"$.{path}", "string").alias(c) for c, path in (("name", argument), ("scope", scope))])
    return rows.where("name IS NOT NULL").groupBy("kind", "name", "scope").agg(F.count("*").alias("n"))


def message_values(messages: DataFrame, message: str, tool: str, fields: Sequence[str]) -> DataFrame:
    """``submitted_values`` of messages that are rows of their own: each value of array arguments of a tool, counted by field."""
    calls = message_calls(messages, message).where(F.col("kind") == tool)
    every = F.array(*[F.struct(F.lit(f).alias("kind"), F.try_variant_get("arguments", f"$.{f}", "array<string>").alias("names")) for f in fields])
    rows = calls.select(F.explode(every).alias("x")).select("x.kind", F.explode("x.names").alias("name"))
    return rows.groupBy("kind", "name").agg(F.count("*").alias("n"))


def message_attempts(messages: DataFrame, key: str, message: str, tool: str = "submit_tags") -> DataFrame:
    """``submit_attempts`` of messages that are rows of their own: answers of one tool in each conversation."""
    of = lambda path: F.try_variant_get(F.try_parse_json(message), path, "string")
    answer = F.coalesce((of("$.role") == "tool") & (of("$.name") == tool), F.lit(False))
    return messages.groupBy(key).agg(F.sum(answer.cast("int")).cast("int").alias("attempts"))


def replay(calls: DataFrame, dims: DataFrame, fold: str, phrases: Sequence[str] = ()) -> DataFrame:
    """Counted names against a library version: phrase, unknown, placeholder or ok."""
    best = dims.groupBy(F.col("label_fold").alias(fold)).agg(F.max(F.col("is_canonical").cast("int")).alias("_c"))
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.contains(F.col(fold), F.lit(p))
    status = F.when(hit, "phrase").when(F.col("_c").isNull(), "unknown").when(F.col("_c") == 0, "placeholder").otherwise("ok")
    return calls.join(best, fold, "left").withColumn("status", status).drop("_c")


def replay_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Names whose status differs between two versions, most asked first."""
    both = a.select(*keys, "n", F.col("status").alias("before")).join(b.select(*keys, F.col("status").alias("after")), list(keys), "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).orderBy(F.col("n").desc_nulls_last(), *keys)


def submit_attempts(transcripts: DataFrame, key: str, tool: str = "submit_tags") -> DataFrame:
    """Answers of one tool in each transcript."""
    return transcripts.select(key, F.size(F.filter("transcript", lambda m: (m["role"] == "tool") & (m["name"] == tool))).alias("attempts"))


def usage_rollup(messages: DataFrame, file: str, message: str, order: str, parts: Sequence[str], out: str, model: str, ts: str) -> DataFrame:
    """Per transcript: base, peak and sums of tokens over the first occurrence of each message; one shuffle."""
    first = F.row_number().over(Window.partitionBy(file, message).orderBy(order))
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    rows = messages.repartition(file).withColumn("_rn", first).where("_rn = 1").withColumn("_ctx", total)
    return rows.groupBy(file).agg(
        F.count("*").alias("messages"), F.min_by("_ctx", order).alias("base"), F.max("_ctx").alias("peak"), F.sum("_ctx").alias("context_sum"),
        F.sum(out).alias("output_sum"), F.array_join(F.array_sort(F.collect_set(model)), ",").alias("models"), F.min(ts).alias("started"),
    )


def phase_status(df: DataFrame) -> DataFrame:
    """``search``, ``score`` and ``tag`` status from ``n_snippets``, ``has_context`` and ``submitted`` (null: no log)."""
    none = F.lit(None).cast("string")
    context = F.coalesce(F.col("has_context"), F.lit(True))
    return df.withColumns(
        {
            "search": F.when(F.col("n_snippets").isNull(), none).when(F.col("n_snippets") > 0, "ok").otherwise("empty"),
            "score": F.when(F.col("has_context").isNull(), none).when(F.col("has_context"), "ok").otherwise("no_context"),
            "tag": F.when(F.col("submitted").isNull(), none).when(F.col("submitted"), "ok").when(context, "no_submit").otherwise("no_context"),
        }
    )
