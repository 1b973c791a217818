"""Reference data: checks as violation tables, arbitration of labels, linking, merging and diffs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import cut


def violation(rule: str, key: Column, message: Column, severity: str = "error") -> list[Column]:
    """The columns that every check returns."""
    return [F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), message.alias("message")]


def check_unique(df: DataFrame, cols: Sequence[str], rule: str) -> DataFrame:
    """One violation per value of ``cols`` that several rows have; nulls do not count."""
    known = df
    for c in cols:
        known = known.where(F.col(c).isNotNull())
    dup = known.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")
    key = F.concat_ws("|", *cols)
    return dup.select(*violation(rule, key, F.concat(F.lit("appears "), F.col("n").cast("string"), F.lit(" times"))))


def check_label_collisions(labels: DataFrame, rule: str = "label_collision") -> DataFrame:
    """``labels(scope, label, owner)``: one violation per folded label that several owners of a scope claim."""
    clash = labels.groupBy("scope", F.lower("label").alias("label")).agg(F.count_distinct("owner").alias("n"), F.min("owner").alias("a"), F.max("owner").alias("b")).where("n > 1")
    return clash.select(*violation(rule, F.concat_ws("|", "scope", "label"), F.concat(F.lit("claimed by "), F.col("a").cast("string"), F.lit(" and "), F.col("b").cast("string"))))


def check_references(df: DataFrame, key: str, refs: Sequence[str], targets: DataFrame, target_cols: Sequence[str], rule: str) -> DataFrame:
    """Rows whose reference, if not null, no target has."""
    known = df
    for c in refs:
        known = known.where(F.col(c).isNotNull())
    there = targets.select(*[F.col(t).alias(r) for t, r in zip(target_cols, refs, strict=True)]).distinct()
    lost = known.join(there, list(refs), "left_anti")
    return lost.select(*violation(rule, F.col(key), F.concat(F.lit("unknown "), F.concat_ws("|", *refs))))


def check_cycles(edges: DataFrame, child: str = "id", parent: str = "parent_id", rule: str = "cycle") -> DataFrame:
    """Nodes that are their own ancestor, where each node has one parent.

    Steps double each round: on a forest until nobody can go further up, which takes the logarithm of its depth.  Who can still go up
    after as many steps as there are nodes has gone round, and where that leads lies on a cycle.
    """
    jump = cut(edges.where(F.col(parent).isNotNull()).select(F.col(child).alias("n"), F.col(parent).alias("up")).distinct())
    reach, nodes = 1, jump.select("n").distinct().count()
    while reach <= nodes and not jump.isEmpty():
        jump = cut(jump.join(jump.select(F.col("n").alias("up"), F.col("up").alias("_far")), "up").select("n", F.col("_far").alias("up")).distinct())
        reach *= 2
    return jump.select(F.col("up").alias("n")).distinct().select(*violation(rule, F.col("n"), F.lit("is its own ancestor")))


def check_required(df: DataFrame, key: str, pin: str, lock: DataFrame, source: str, rule: str = "missing_id") -> DataFrame:
    """Rows without an external id, neither pinned nor locked, unless pinned to ``none`` with a source."""
    joined = df.join(lock.select(key, F.col("qid").alias("_lock")), key, "left").withColumn("_id", F.coalesce(pin, "_lock"))
    bad = F.col("_id").isNull() | ((F.col("_id") == "none") & (F.coalesce(F.col(source), F.lit("")) == ""))
    return joined.where(bad).select(*violation(rule, F.col(key), F.when(F.col("_id").isNull(), F.lit("no id")).otherwise(F.lit("no id and no source"))))


def check_slice(rows: DataFrame, others: DataFrame, class_words: Sequence[str], known_grapes: DataFrame | None = None) -> DataFrame:
    """A research slice held against the merged view: parents, labels, class words, grapes, synonyms, sources.

    ``rows(name, country, parent, synonyms[], source, was, grapes[])``; ``others(name, country, slug)`` is the view without the slice, rows that
    the slice replaces (same country and old or same name) taken out before labels are counted.  ``known_grapes(label)`` holds the
    labels of the allowlist and of all slices.
    """
    has_class = F.rlike(F.lower("name"), F.lit(r"(^|\s)(" + "|".join(class_words) + r")(\s|$)"))
    gone = rows.select("country", F.coalesce("was", "name").alias("name")).distinct()
    merged = rows.select("name", "country", F.lit(1).alias("own")).union(others.join(gone, ["country", "name"], "left_anti").select("name", "country", F.lit(0)))
    twice = merged.groupBy("name", "country").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 AND own = 1")
    found = twice.select(*violation("duplicate_label", F.concat_ws("|", "name", "country"), F.concat(F.lit("appears "), F.col("n").cast("string"), F.lit(" times"))))
    found = found.union(check_references(rows, "name", ["parent", "country"], merged, ["name", "country"], "unknown_parent"))
    found = found.union(rows.where(has_class).select(*violation("class_word", F.col("name"), F.lit("has a classification word"), "warning")))
    syn = rows.select("name", F.explode("synonyms").alias("s")).join(others.select(F.col("name").alias("s")).distinct(), "s")
    found = found.union(syn.select(*violation("synonym_is_name", F.col("name"), F.concat(F.col("s"), F.lit(" is a name elsewhere")), "warning")))
    if known_grapes is not None:
        asked = rows.select("name", F.explode("grapes").alias("label"))
        lost = asked.join(known_grapes.select("label").distinct(), "label", "left_anti")
        found = found.union(lost.select(*violation("unknown_grape", F.col("name"), F.concat(F.col("label"), F.lit(" is in no list")))))
    return found.union(rows.where(F.coalesce(F.col("source"), F.lit("")) == "").select(*violation("no_source", F.col("name"), F.lit("has no source"), "warning")))


def check_fields(rows: DataFrame, key: str, formats: dict[str, str]) -> DataFrame:
    """One violation per value that does not fit its column's pattern (the whole value must); nulls do not count."""
    found = None
    for c, pattern in formats.items():
        bad = rows.where(F.col(c).isNotNull() & ~F.rlike(F.col(c).cast("string"), F.lit(f"^(?:{pattern})$")))
        part = bad.select(*violation(f"format_{c}", F.col(key), F.concat(F.lit("is "), F.col(c).cast("string"))))
        found = part if found is None else found.union(part)
    return found


def arbitrate(labels: DataFrame, scope: Sequence[str], fold: str, order: Sequence[str]) -> DataFrame:
    """The first claim on each folded label of a scope; the others go."""
    rn = F.row_number().over(Window.partitionBy(*scope, fold).orderBy(*order))
    return labels.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def pick_country(items: DataFrame, key: str, sovereign: str, order: str) -> DataFrame:
    """One item per key: a sovereign state if there is one, else the first."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce(F.col(sovereign), F.lit(False)).desc(), order))
    return items.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def admit(candidates: DataFrame, known_ids: DataFrame, taken: DataFrame, id_col: str, label: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """Candidates whose id is new and whose folded label, also without a suffix, is free."""
    bare = F.regexp_replace(F.col(label), r"\s+(" + "|".join(suffixes) + r")$", "") if suffixes else F.col(label)
    fresh = candidates.join(known_ids.select(id_col), id_col, "left_anti").withColumn("_bare", bare)
    return fresh.join(taken.select(label), label, "left_anti").join(taken.select(F.col(label).alias("_bare")), "_bare", "left_anti").drop("_bare")


def link_edges(edges: DataFrame, left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Label pairs to distinct id pairs, through ``(label_fold, entity)`` tables."""
    l2 = left.select(F.col("label_fold").alias(a), F.col("entity").alias("left_id"))
    r2 = right.select(F.col("label_fold").alias(b), F.col("entity").alias("right_id"))
    return edges.join(l2, a).join(r2, b).select("left_id", "right_id").distinct()


def fill_null(df: DataFrame, updates: DataFrame, key: str, col: str) -> DataFrame:
    """A column set from updates only where it is null."""
    return df.join(updates.select(key, F.col(col).alias("_new")), key, "left").withColumn(col, F.coalesce(col, "_new")).drop("_new")


def link_entities(entries: DataFrame, candidates: DataFrame, weights: dict[str, int], review_below: int = 20) -> DataFrame:
    """The best candidate per entry: ``entry, candidate, score, note`` (ok, review or none).

    ``candidates(entry, candidate, ord, <features>)``: each feature in ``weights`` is a boolean column that adds
    its weight.  Best by score, then by order.
    """
    score = sum((F.when(F.coalesce(F.col(c), F.lit(False)), w).otherwise(0) for c, w in weights.items()), F.lit(0))
    scored = candidates.withColumn("score", score)
    rn = F.row_number().over(Window.partitionBy("entry").orderBy(F.col("score").desc(), "ord"))
    best = scored.withColumn("_rn", rn).where("_rn = 1").select("entry", "candidate", "score")
    note = F.when(F.col("candidate").isNull(), "none").when(F.col("score") < review_below, "review").otherwise("ok")
    return entries.join(best, "entry", "left").withColumn("note", note)


def link_on_shared(entries: DataFrame, candidates: DataFrame, block: str, weights: dict[str, int], bonus: str | None = None, review_below: int = 20) -> DataFrame:
    """``link_entities`` where the features are equal columns of ``entries(entry, ...)`` and ``candidates(candidate, ord, ...)``.

    Only candidates with the entry's ``block`` count, never the entry itself; ``bonus`` is an entry's own column, added to
    each score.  For every set of features the two best candidates of each value stay, and entries meet only those.
    """
    best = None
    for chosen in product((False, True), repeat=len(weights)):
        shared = [block, *[c for c, use in zip(weights, chosen, strict=True) if use]]
        once = candidates.groupBy(*shared, "candidate").agg(F.min("ord").alias("ord"))
        rn = F.row_number().over(Window.partitionBy(*shared).orderBy("ord", "candidate"))
        two = once.withColumn("_rn", rn).where("_rn <= 2").drop("_rn")
        score = F.lit(sum(weights[c] for c in shared[1:])) + (F.coalesce(bonus, F.lit(0)) if bonus else F.lit(0))
        met = entries.join(two, shared).where("entry <> candidate").select("entry", score.alias("score"), "ord", "candidate")
        best = met if best is None else best.union(met)
    top = best.groupBy("entry").agg(F.min(F.struct((-F.col("score")).alias("less"), "ord", "candidate")).alias("b"))
    top = top.select("entry", "b.candidate", (-F.col("b.less")).alias("score"))
    note = F.when(F.col("candidate").isNull(), "none").when(F.col("score") < review_below, "review").otherwise("ok")
    return entries.select("entry").join(top, "entry", "left").withColumn("note", note)


def lock_prune(lock: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """Locked ids of entries that still exist, sorted."""
    return lock.join(entries.select(key), key, "left_semi").orderBy(key)


def lock_report(lock: DataFrame, entries: DataFrame, key: str, id_col: str = "qid", note: str = "note") -> DataFrame:
    """What a person should look at: entries that no lock gives an id (``unresolved``), and locked ids whose note is not ``ok``."""
    known = lock.where(F.col(id_col).isNotNull())
    lost = entries.select(key).distinct().join(known.select(key), key, "left_anti").select(key, F.lit("unresolved").alias("why"))
    return lost.union(lock.join(entries.select(key), key, "left_semi").where((F.col(note) != "ok") & F.col(id_col).isNotNull()).select(key, F.col(note)))


def merge_slice(base: DataFrame, slice_: DataFrame, keys: Sequence[str], name: str, was: str, attrs: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """``base`` with a slice merged: rows renamed by ``was``, replaced, added; unreturned rows stay.

    ``carry`` columns (an external id) fall back to the base's.  ``change`` says what happened.
    """
    rest = [k for k in keys if k != name]
    new = slice_.select(*[F.col(k).alias(f"_{k}") for k in rest], F.coalesce(was, name).alias("_old"), F.col(name).alias("_new"), *[F.col(a).alias(f"_{a}") for a in attrs])
    on = [F.col(k) == F.col(f"_{k}") for k in rest] + [F.col(name) == F.col("_old")]
    both = base.join(new, on, "full")
    has, had = F.col("_new").isNotNull(), F.col(name).isNotNull()
    change = F.when(~has, "kept").when(~had, "added").when(F.col("_new") != F.col(name), "renamed").otherwise("replaced")
    out = [F.coalesce(k, f"_{k}").alias(k) for k in rest] + [F.coalesce("_new", name).alias(name)]
    out += [F.when(has, F.coalesce(f"_{a}", a) if a in carry else F.col(f"_{a}")).otherwise(F.col(a)).alias(a) for a in attrs]
    return both.select(*out, change.alias("change"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Per key: added, removed, changed or kept, and which attributes changed."""
    a = old.select(*keys, F.struct(*attrs).alias("_a"))
    b = new.select(*keys, F.struct(*attrs).alias("_b"))
    both = a.join(b, list(keys), "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in attrs]))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("kept")
    cols = F.when(kind == "changed", F.array_join(changed, ",")).otherwise("")
    return both.select(*keys, kind.alias("change"), cols.alias("columns"))


def synonym_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Elements of an array that a key gained and lost."""
    both = old.select(*keys, F.col(col).alias("_a")).join(new.select(*keys, F.col(col).alias("_b")), list(keys))
    return both.select(*keys, F.array_sort(F.array_except("_b", "_a")).alias("gained"), F.array_sort(F.array_except("_a", "_b")).alias("lost"))


def merge_names(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Labels of an incoming list added to known ``(owner, label, seq)``: labels of another owner are skipped, the first claim wins."""
    every = known.select("owner", "label", F.lit(0).alias("tier"), "seq").unionByName(incoming.select("owner", "label", F.lit(1).alias("tier"), "seq"))
    return arbitrate(every.withColumn("_fold", F.lower("label")), [], "_fold", ["tier", "seq", "owner"]).drop("_fold")


def label_find(labels: DataFrame, wanted: DataFrame, fold: str) -> DataFrame:
    """Entries whose folded label is asked for."""
    return labels.join(wanted.select(fold).distinct(), fold)


def siblings(slices: DataFrame, slug: str = "slug", country: str = "country") -> DataFrame:
    """Slices that share a country with another: ``slug, sibling``."""
    other = slices.select(F.col(slug).alias("sibling"), country).distinct()
    return slices.select(slug, country).distinct().join(other, country).where(F.col(slug) != F.col("sibling")).select(slug, "sibling").distinct()


def tree_listing(nodes: DataFrame, tree: DataFrame, node: str = "id", name: str = "name") -> DataFrame:
    """Depth-first listing: depth, path of names, and how many nodes lie below each."""
    named = nodes.select(F.col(node).alias("ancestor"), F.col(name).alias("_n"))
    up = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("d"), F.col("_n").alias("n"))))
    paths = tree.join(named, "ancestor").groupBy(F.col("descendant").alias(node)).agg(F.max("distance").alias("depth"), F.array_join(F.transform(up, lambda x: x.n), " / ").alias("path"))
    below = tree.groupBy(F.col("ancestor").alias(node)).agg((F.count("*") - 1).alias("below"))
    return paths.join(below, node).orderBy("path")


def label_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of several files, of each key the row of the first file that has it; no file orders its own rows."""
    every = None
    for i, df in enumerate(frames):
        part = df.withColumn("_file", F.lit(i))
        every = part if every is None else every.unionByName(part, True)
    return every.dropDuplicates([*keys, "_file"]).withColumn("_first", F.min("_file").over(Window.partitionBy(*keys))).where("_file = _first").drop("_file", "_first")


def build_stats(tables: dict[str, DataFrame], canonical: str = "is_canonical") -> DataFrame:
    """Rows and canonical rows of each table."""
    parts = [df.agg(F.lit(n).alias("table"), F.count("*").alias("n"), F.sum(F.when(F.col(canonical), 1).otherwise(0)).alias("canonical")) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
