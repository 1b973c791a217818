"""A product store whose human edits are protected, and the views over its runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast

STATUSES = ("pending", "model", "needs_review", "human")
LEGACY = {"auto": "model", "manual": "human"}


def legacy_status(status: Column) -> Column:
    """Old names of a status replaced, null as pending."""
    out = F.coalesce(status, F.lit("pending"))
    for old, new in LEGACY.items():
        out = F.when(out == old, new).otherwise(out)
    return out


def protected_upsert(store: DataFrame, feed: DataFrame, key: str, refresh: Sequence[str], inferred: str | None = None, marker: str | None = None) -> DataFrame:
    """The store after a feed: new rows inserted as pending, ``refresh`` columns of known rows renewed.

    All other columns of known rows stay.  A column ``inferred`` by the model, which ``marker`` says, stays while
    the feed has none, and the marker goes when the feed has one.  One full join on the key.
    """
    new = feed.select(F.col(key).alias("_key"), F.lit(True).alias("_fed"), *[F.col(c).alias(f"_{c}") for c in refresh])
    both = store.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col("_key"), "full")
    out = {key: F.coalesce(key, "_key")}
    for c in refresh:
        fresh = F.when(F.col("_fed"), F.col(f"_{c}")).otherwise(F.col(c))
        if c == inferred and marker:
            kept = F.coalesce(F.col(marker), F.lit(False)) & (F.coalesce(F.col(f"_{c}"), F.lit("")) == "")
            fresh = F.when(F.col("_fed") & ~kept, F.col(f"_{c}")).otherwise(F.col(c))
            out[marker] = F.when(F.col("_fed") & ~kept, F.lit(False)).otherwise(F.col(marker))
        out[c] = fresh
    if "tag_status" in store.columns:
        out["tag_status"] = F.when(F.col("_old"), F.col("tag_status")).otherwise(F.lit("pending"))
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in store.columns])


def apply_tags(store: DataFrame, tags: DataFrame, key: str, columns: Sequence[str], category: str = "category", marker: str = "category_inferred") -> DataFrame:
    """Tags written over non-human rows; a row tagged with nulls is cleared; the feed's category is kept."""
    new = tags.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in [*columns, *([category] if category in tags.columns else [])]])
    both = store.join(new, F.col(key) == F.col("_key"), "left")
    use = F.col("_key").isNotNull() & (F.coalesce(F.col("tag_status"), F.lit("pending")) != "human")
    out = {c: F.when(use, F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    if category in tags.columns:
        empty = (F.coalesce(F.col(category), F.lit("")) == "") | F.coalesce(F.col(marker), F.lit(False))
        infer = use & empty & F.col(f"_{category}").isNotNull()
        out |= {category: F.when(infer, F.col(f"_{category}")).otherwise(F.col(category)), marker: F.coalesce(infer, F.lit(False)) | F.coalesce(F.col(marker), F.lit(False))}
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in store.columns])


def skip_human(items: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Items whose store row no human has edited."""
    return items.join(store.where("tag_status = 'human'").select(key), key, "left_anti")


def apply_edits(store: DataFrame, edits: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Human edits: of each row the fields in its ``present`` array are set (also to null), status human unless given."""
    new = edits.select(F.col(key).alias("_key"), F.col("present").alias("_present"), *[F.col(c).alias(f"_{c}") for c in fields])
    both = store.join(new, F.col(key) == F.col("_key"), "left")
    has = lambda c: F.coalesce(F.array_contains("_present", c), F.lit(False))
    out = {c: F.when(has(c), F.col(f"_{c}")).otherwise(F.col(c)) for c in fields}
    given = out.get("tag_status", F.col("tag_status"))
    out["tag_status"] = F.when(F.col("_key").isNotNull() & ~has("tag_status"), "human").otherwise(given)
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in store.columns])


def reset_human(store: DataFrame) -> DataFrame:
    """Human rows pending again; count them with ``store.where("tag_status = 'human'").count()``."""
    return store.withColumn("tag_status", F.when(F.col("tag_status") == "human", "pending").otherwise(F.col("tag_status")))


def render_tags(country: Column, region: Column, grapes: Column, is_blend: Column, organic: Column, sep: str = "; ") -> Column:
    """Tags on one line, null if there is none."""
    full = lambda xs: F.filter(F.coalesce(xs, F.array().cast("array<string>")), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    kind = F.when(F.size(full(grapes)) > 0, F.when(is_blend, "Blend").otherwise("Single Varietal"))
    parts = F.concat(F.array(country), full(region), full(grapes), F.array(kind, F.when(organic, F.lit("Organic"))))
    return F.nullif(F.array_join(full(parts), sep), F.lit(""))


def export_rows(store: DataFrame, key: str = "id", name: str = "name", status: str | None = None, sep: str = "; ") -> DataFrame:
    """Id, name and tags of each row, of one status if it is given."""
    rows = store.where(F.col("tag_status") == status) if status else store
    full = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    parts = F.filter(F.concat(F.array("country"), full("region"), full("grapes")), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    return rows.select(key, name, F.array_join(parts, sep).alias("tags"))


def status_counts(df: DataFrame, status: str, buckets: Sequence[str] = STATUSES) -> DataFrame:
    """Rows per status, with a row for every bucket."""
    fixed = df.sparkSession.createDataFrame([(i, b) for i, b in enumerate(buckets)], "pos int, status string")
    n = df.groupBy(F.coalesce(F.col(status), F.lit(buckets[0])).alias("status")).agg(F.count("*").alias("n"))
    return fixed.join(n, "status", "left").select("pos", "status", F.coalesce("n", F.lit(0)).alias("n"))


def backfill_run(store: DataFrame, final: DataFrame, key: str, run: str = "tag_run_id") -> DataFrame:
    """Rows without a run take the newest one that has a final log of them."""
    newest = final.groupBy(F.col(key).alias("_key")).agg(F.max("run_id").alias("_run"))
    return store.join(newest, F.col(key) == F.col("_key"), "left").withColumn(run, F.coalesce(run, "_run")).drop("_key", "_run")


def history(logs: Sequence[DataFrame], key: str) -> DataFrame:
    """Per product the runs that have any log of it, newest first: ``run_no`` counts from 1."""
    every = logs[0].select(key, "run_id")
    for log in logs[1:]:
        every = every.union(log.select(key, "run_id"))
    return every.distinct().withColumn("run_no", F.row_number().over(Window.partitionBy(key).orderBy(F.col("run_id").desc())))


def run_results(items: DataFrame, store: DataFrame, key: str, search: DataFrame, scorer: DataFrame, final: DataFrame) -> DataFrame:
    """A run's products in order beside their store row and their logs, with the status of each phase."""
    out = items.join(store.withColumn("_in_store", F.lit(True)), key, "left")
    out = out.join(search.select(key, "n_snippets"), key, "left").join(scorer.select(key, "has_context"), key, "left")
    out = out.join(final.select(key, F.col("tag_status").alias("final_status"), "submitted"), key, "left")
    human = F.coalesce(F.col("tag_status") == "human", F.lit(False))
    return out.withColumns(
        {
            "search_status": F.when(F.col("n_snippets").isNull(), F.lit(None).cast("string")).when(F.col("n_snippets") > 0, "ok").otherwise("empty"),
            "score_status": F.when(F.col("has_context").isNull(), F.lit(None).cast("string")).when(F.col("has_context"), "ok").otherwise("no_context"),
            "tag_phase": F.when(F.col("submitted").isNull(), F.lit(None).cast("string")).when(F.col("submitted"), "ok").when(~F.coalesce("has_context", F.lit(True)), "no_context").otherwise("no_submit"),
            "run_status": F.coalesce("final_status", F.lit("pending")),
            "human_in_store": human,
        }
    ).drop("_in_store")


def run_summary(items: DataFrame, final: DataFrame, key: str) -> DataFrame:
    """Per run its number of products and of tagged ones, newest first."""
    done = final.select("run_id", key).distinct().withColumn("_done", F.lit(1))
    return items.join(done, ["run_id", key], "left").groupBy("run_id").agg(F.count("*").alias("products"), F.count("_done").alias("tagged")).orderBy(F.col("run_id").desc())


def run_overview(runs: DataFrame, items: DataFrame, final: DataFrame, logs: DataFrame, phases: Sequence[str], key: str) -> DataFrame:
    """``run_summary`` with each phase: a row for every run and phase, newest run first.

    ``runs(run_id, ..., phases MAP<STRING, STRUCT<...>>)`` is what a run says of itself, carried along; ``info`` is what it says of the phase, null where it says
    nothing.  ``items(run_id, key)`` are its products, ``final(run_id, key)`` those tagged, ``logs(run_id, phase, key)`` the phase logs; ``logged`` counts the products
    of each phase, which ``run_files`` lists.  Runs without items or logs count 0.
    """
    of = lambda df, name: df.select("run_id", key).distinct().groupBy("run_id").agg(F.count("*").alias(name))
    logged = logs.select("run_id", "phase", key).distinct().groupBy("run_id", "phase").agg(F.count("*").alias("logged"))
    every = runs.select("*", F.explode(F.array(*map(F.lit, phases))).alias("phase"))
    every = every.withColumn("info", F.try_element_at("phases", F.col("phase"))).drop("phases")
    out = every.join(of(items, "products"), "run_id", "left").join(of(final, "tagged"), "run_id", "left").join(logged, ["run_id", "phase"], "left")
    return out.fillna(0, ["products", "tagged", "logged"]).orderBy(F.col("run_id").desc(), F.array_position(F.array(*map(F.lit, phases)), F.col("phase")))


def run_files(logs: DataFrame, final: DataFrame, key: str) -> DataFrame:
    """``(run_id, phase, key)``: the products that each phase of each run has a log of, those tagged as phase ``final``; rows, so a run of any size is many tasks'."""
    return logs.select("run_id", "phase", key).union(final.select("run_id", F.lit("final"), key)).distinct()


def retention(runs: DataFrame, keep_latest: int, protect: Sequence[str] = (), by: Sequence[str] = (), order: str = "run_id") -> DataFrame:
    """``runs`` with ``action``: keep the newest, skip protected ones, delete the rest.

    Without ``by`` the newest are found as the first ``keep_latest`` of all, a few rows that are joined back, so no task gets every run; rows of one ``order`` then fare alike.
    """
    safe = F.col(order).isin(list(protect)) if protect else F.lit(False)
    if by:
        rows = runs.withColumn("_new", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc())) <= keep_latest)
    else:
        newest = runs.select(F.col(order).alias("_o")).orderBy(F.col("_o").desc()).limit(keep_latest).distinct().withColumn("_hit", F.lit(True))
        rows = runs.join(bounded_broadcast(newest), F.col(order).eqNullSafe(F.col("_o")), "left").withColumn("_new", F.coalesce("_hit", F.lit(False))).drop("_o", "_hit")
    return rows.withColumn("action", F.when(F.col("_new"), "keep").when(safe, "skip").otherwise("delete")).drop("_new")


def remaining(items: DataFrame, done: DataFrame, keys: Sequence[str], limit: int | None = None, order: str | None = None) -> DataFrame:
    """Items not done yet, the first ``limit`` in order if given."""
    rows = items.join(done.select(*keys).distinct(), list(keys), "left_anti")
    return rows.orderBy(order).limit(limit) if limit else rows


def same_list(items: DataFrame, saved: DataFrame, key: str, order: str) -> bool:
    """Whether a saved run has exactly the requested products in the same order."""
    a, b = items.select(F.col(order).alias("_o"), F.col(key).alias("_a")), saved.select(F.col(order).alias("_o"), F.col(key).alias("_b"))
    return a.join(b, "_o", "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).isEmpty()


def matching_runs(items: DataFrame, saved: DataFrame, key: str, order: str, run: str = "run_id") -> DataFrame:
    """``(run, same)``: which saved runs have exactly the requested products in the same order, so that they may be resumed.

    ``items(order, key)`` and ``saved(run, order, key)`` have one row for each place of a list.  Places meet by equality and are counted, so no list is
    gathered.  An empty request is the same as no run.
    """
    asked = items.select(F.col(order).alias("_o"), F.col(key).alias("_k"))
    places = saved.select(run, F.col(order).alias("_o"), F.col(key).alias("_s")).join(asked, "_o", "left")
    counted = places.groupBy(run).agg(F.count("*").alias("_n"), F.sum(F.coalesce((F.col("_s") == F.col("_k")).cast("int"), F.lit(0))).alias("_met"))
    n = asked.count()
    return counted.select(run, ((F.col("_n") == n) & (F.col("_met") == n)).alias("same"))
