"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Each source gets a target: its share of all words by weight, at most ``cap`` times its own words,
the excess reshared by weight (water filling).  A source's weight schedule over training time
``t`` in [0, 1] is ``target * (1 + a * (2 t - 1))``; its integral is the cumulative token demand
``D(t) = target * (t + a * (t * t - t))``.  The documents of a source stand in a hashed order that
repeats in epochs; a copy whose middle word is the c-th of that order is taken while c is within
the target, and trains at position ``t = D^-1(c)``.  Copies are then range-sorted by position.

The running word count of a source is built in two levels, over hash buckets and within each
bucket, so a source with a third of all rows never meets in one task.  A document's place is hashed from its id and text, so
neither does an id; the number of buckets grows with the counted rows.  Only the targets are settled in one task, over one
short row per source.

Defined results: a null text counts no words; a document without words is never taken; a null
source is a source of its own, last in order; repeated rows are rows of their own; an empty table
gives an empty result.  Extra columns are carried along; columns named like those added give way to
them, and ``mix`` leaves its own out instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source that a hash bucket holds, about, at most.
BUCKET_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), slopes: Sequence[float] = (0.5, 0.0, -0.5), cap: float = 3.0
) -> DataFrame:
    """One row per source of ``sized(source_key, size)``: its words, target and schedule slope.

    The windows run over one row per source.  With caps in the order of ``cap * words / weight``,
    the fill level that follows k capped sources is ``(total - their caps) / weight of the rest``;
    the level that holds is the greatest of these.
    """
    per = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source_key").substr(1, 1), "source_key")) - 1) % len(weights)
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (turn + 1).cast("int"))
    per = per.select("source_key", "source_size", pick(weights).alias("weight"), pick(slopes).alias("slope"))
    most = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy(most / F.col("weight"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    )
    per = per.withColumn("level", F.max("level").over(every))
    return per.select("source_key", "source_size", "slope", F.least(most, F.col("level") * F.col("weight")).alias("target"))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    slopes: Sequence[float] = (0.5, 0.0, -0.5),
    cap: int = 3,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (the columns in ``keep``, all by default) with ``size, source_size, target, copies,
    taken`` and ``positions``, the ascending training positions of its copies.
    """
    keep = list(docs.columns if keep is None else keep)
    key = F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1"))
    order_key = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))))
    digits = max(1, math.ceil(math.log(max(1, docs.count() / BUCKET_ROWS), 16)))
    held = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]  # so that no name clashes with those below
    sized = docs.select(*held, key.alias("source_key"), word_count(F.col(text_col)).alias("size"), order_key.alias("order_key"))
    sized = sized.withColumn("bucket", F.substring("order_key", 1, digits))
    if text_col not in keep:  # read twice below: without the texts it is cheaper to store than to make again
        sized = stored(sized)

    # One pass over the texts for all sums; the sources' come from the buckets'.
    sums = stored(sized.select("source_key", "bucket", "size").groupBy("source_key", "bucket").agg(F.sum("size").alias("in_bucket")))
    per_bucket = sums.select("source_key", F.col("in_bucket").alias("size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_key", "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("base"))
    targets = source_targets(per_bucket, weights, slopes, cap)
    bases = sums.join(targets, "source_key")

    within = Window.partitionBy("source_key", "bucket").orderBy("order_key", "size")
    run = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sized.withColumn("run", run).join(bases, ["source_key", "bucket"])
    middle = F.col("base") + F.col("run") + F.col("size") / F.lit(2.0)
    offsets = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda e: e * F.col("source_size") + middle)
    taken = F.filter(offsets, lambda c: (c <= F.col("target")) & (F.col("size") > 0))
    placed = placed.withColumn("_at", taken)
    a = F.col("slope")

    def when(c: Column) -> Column:
        u = c / F.col("target")
        return F.when(a == 0, u).otherwise((a - 1 + F.sqrt((1 - a) * (1 - a) + 4 * a * u)) / (2 * a))

    return placed.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep) if c not in ("size", "source_size", "target", "copies", "taken", "positions")],
        "size",
        "source_size",
        "target",
        F.size("_at").alias("copies"),
        (F.size("_at") * F.col("size")).cast("long").alias("taken"),
        F.transform("_at", when).alias("positions"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The training stream: one row per copy taken, with ``docs``' columns, range-sorted by position.

    ``epoch`` and ``position`` follow, unless ``docs`` has a column of either name.
    """
    columns = docs.columns
    carried = docs.select(*[F.col(c).alias(f"_in{i}") for i, c in enumerate(columns)])
    names = {f"{k}_col": f"_in{columns.index(options.get(f'{k}_col', d))}" for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))}
    stream = plan_mix(carried, **options | names).select(*carried.columns, F.posexplode("positions").alias("epoch", "position"))
    added = [] if {"position", "epoch"} & set(columns) else ["epoch", "position"]
    return stream.orderBy("position", names["id_col"]).select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(columns)], *added)
