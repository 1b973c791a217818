"""What was submitted for a product, held against its sources: counts, upgrades, checks and verdict in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast, shuffled, spread, stored
from sievework.operators import evidence


def _spelled(labels: DataFrame, least: int = 4) -> DataFrame:
    """``region, _run``: the entities of ``labels(entity, alias)`` by the words of their aliases."""
    words = F.array_join(F.regexp_extract_all("alias", F.lit("([a-z0-9]+)"), 1), " ")
    return labels.where(F.length("alias") >= least).select(F.col("entity").alias("region"), words.alias("_run")).where("_run <> ''").distinct()


def mentions(said: DataFrame, spelled: DataFrame) -> DataFrame:
    """``row, region``: the entities whose words, see ``_spelled``, are among the word runs of a row's texts, ``said(row, _run)``."""
    return said.select("row", "_run").distinct().join(bounded_broadcast(spelled), "_run").select("row", "region").distinct()


def _claims(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """``row, region`` of the regions that rows have and the tree knows."""
    return rows.select("row", F.explode(F.array_distinct("regions")).alias("region")).join(tree.select(F.col("descendant").alias("region")).distinct(), "region", "left_semi").select("row", "region")


def _by_name(rows: DataFrame, named: DataFrame, labels: DataFrame, tree: DataFrame, longer: DataFrame) -> DataFrame:
    """``row, new, action``: the region that a row's name holds, and whether it is an upgrade of what the row has, or a conflict."""
    held = stored(mentions(named, _spelled(labels.where("is_canonical"))))
    found = stored(evidence.name_region(held, "row", "region", tree).withColumnRenamed("region", "new"))
    scopes = labels.select(F.col("entity").alias("new"), F.col("scope").alias("_scope")).distinct()
    found = found.join(scopes, "new").join(shuffled(rows.select("row", "scope")), "row").where("scope IS NULL OR scope = _scope").select("row", "new").distinct()
    leaves = stored(evidence.submitted_leaves(_claims(rows, tree), "row", "region", tree))
    held = found.join(shuffled(leaves), "row", "left")
    for flag, pairs in (
        ("_within", tree.select(F.col("ancestor").alias("new"), F.col("descendant").alias("region"))),
        ("_above", tree.where("distance > 0").select(F.col("descendant").alias("new"), F.col("ancestor").alias("region"))),
        ("_longer", longer.select(F.col("shorter").alias("new"), F.col("longer").alias("region"))),
    ):
        held = held.join(pairs.distinct().withColumn(flag, F.lit(True)), ["new", "region"], "left").fillna(False, [flag])
    judged = held.groupBy("row", "new").agg(F.count("region").alias("_n"), F.bool_or("_within").alias("_in"), F.bool_and("_above").alias("_up"), F.bool_or("_longer").alias("_wide"))
    action = F.when(F.col("_n") == 0, "upgrade").when(F.col("_in"), None).when(F.col("_up"), "upgrade").when(F.col("_wide"), None).otherwise("conflict")
    return judged.select("row", "new", action.alias("action")).where("action IS NOT NULL")


def _replaced(rows: DataFrame, new: DataFrame, tree: DataFrame, told: str) -> DataFrame:
    """``rows`` with the chains of ``new(row, new)`` in front of their regions, and ``told``: what became what."""
    chains = tree.groupBy(F.col("descendant").alias("new")).agg(F.transform(F.array_sort(F.collect_list(F.struct("distance", "ancestor"))), lambda x: x["ancestor"]).alias("_chain"))
    out = rows.join(shuffled(new), "row", "left").join(chains, "new", "left")
    was = F.coalesce(F.get("regions", 0), F.lit("none"))
    change = F.when(F.col("new").isNotNull(), F.array(F.concat(was, F.lit("→"), "new"))).otherwise(F.array().cast("array<string>"))
    regions = F.when(F.col("new").isNotNull(), evidence.replace_region(F.col("regions"), F.col("_chain"))).otherwise(F.col("regions"))
    return out.withColumns({told: change, "regions": regions}).drop("new", "_chain")


def review(rows: DataFrame, blocks: DataFrame, grapes: DataFrame, labels: DataFrame, tree: DataFrame, threshold: int = 80, review_upgrades: bool = False) -> DataFrame:
    """``rows`` with ``reasons`` in order, ``confidence`` clamped, ``status``, and ``regions`` as upgraded.

    Grapes are counted first; then the region named by the product's name and the one finer or longer region that its sources settle
    on each replace what they outweigh, and the region checks look at what that leaves.

    ``rows(row, name, category, scope, submitted, is_blend, confidence, grapes[], colours[], regions[], named_whole)``, one per ``row``;
    ``blocks(row, family, body)``; ``grapes(claim, alias)``; ``labels(scope, entity, alias, is_canonical)``, where an entity is its canonical
    name; ``tree(ancestor, descendant, distance)``.  Names, bodies and aliases are folded.

    Null arrays count as empty, null bodies as empty texts; regions that the tree lacks are kept and never checked.  Rows without blocks have no
    context.  An empty table gives an empty result.

    Rows and texts are dealt out to all tasks and stored first, as a small file of many rows is one task's.  Names and texts are split once, into those of their
    word runs that are aliases; the sources are weighed anew only for rows that the first weighing changed.  Each step is stored, as the driver plans a long chain
    of joins anew after each of its stages.
    """
    empty = F.array().cast("array<string>")
    labels, tree = stored(labels.select("scope", "entity", "alias", "is_canonical")), bounded_broadcast(stored(tree))
    wider, pairs = bounded_broadcast(stored(evidence.longer_names(labels))), bounded_broadcast(stored(evidence.longer_pairs(labels, tree)))
    labels, any_longer = bounded_broadcast(labels), not pairs.isEmpty()
    rows = stored(spread(rows).withColumns({x: F.coalesce(x, empty) for x in ("grapes", "colours", "regions")} | {"is_blend": F.coalesce("is_blend", F.lit(False))}))
    said = stored(spread(blocks.select("row", "family", F.coalesce("body", F.lit("")).alias("body"))))
    names = rows.select("row", F.coalesce("name", F.lit("")).alias("name"))

    sources = stored(said.groupBy("row").agg(F.count_distinct("family").alias("n_sources"), F.max(evidence.calls_it_a_blend(F.col("body"))).alias("_called")))
    each = rows.select("row", F.posexplode("grapes").alias("pos", "claim"))
    counted = stored(evidence.corroboration(stored(each.select("row", "claim").distinct()), said, grapes, "row"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", F.col("claim").alias("name"), F.col("n_sources").alias("n"))))
    counted = each.join(shuffled(counted), ["row", "claim"]).groupBy("row").agg(F.transform(in_order, lambda g: F.struct(g["name"].alias("name"), g["n"].alias("n"))).alias("_counted"))
    counted = stored(counted)

    spelled = bounded_broadcast(stored(_spelled(labels)))
    runs = said.withColumn("_name", F.lit(False)).unionByName(names.select("row", F.col("name").alias("body"), F.lit(True).alias("_name")), allowMissingColumns=True)
    runs = stored(evidence.said_runs(runs, spelled))
    named, heard = runs.where("_name").select("row", "_run"), runs.where("NOT _name").drop("_name")
    by_name = stored(_by_name(rows, named, labels, tree, wider))
    rows = stored(_replaced(rows, by_name.where("action = 'upgrade'").select("row", "new"), tree, "name_upgrade"))

    spoken = stored(mentions(heard, spelled))
    canonical = labels.where("is_canonical").select(F.col("entity").alias("descendant")).distinct()
    above = bounded_broadcast(stored(tree.where("distance > 0").join(canonical, "descendant").select(F.col("ancestor").alias("region"), F.col("descendant").alias("_low"))))

    def outweighing(rows: DataFrame) -> DataFrame:
        """``row, kind, region``: each ``leaf`` of the rows' regions, and the finer (``coarse``) and the ``longer`` regions that outweigh it."""
        leaves = stored(evidence.submitted_leaves(_claims(rows, tree), "row", "region", tree))
        own = spoken.join(shuffled(leaves), ["row", "region"], "left_semi")
        below = spoken.withColumnRenamed("region", "_low").join(above, "_low").join(shuffled(leaves), ["row", "region"], "left_semi").select("row", F.col("_low").alias("region"))
        counts = stored(evidence.origin_counts(stored(own.union(below).distinct()), "row", "region", labels, said, names, said=heard))
        finer = evidence.finer_regions(leaves, "row", "region", tree, counts).select("row", F.lit("coarse").alias("kind"), F.col("finer").alias("region"))
        found = leaves.select("row", F.lit("leaf").alias("kind"), "region").union(stored(finer.distinct()))
        if any_longer:  # else no name holds another
            longer = evidence.longer_regions(leaves, "row", "region", labels, tree, said, names, pairs, heard)
            found = found.union(stored(longer.select("row", F.lit("longer").alias("kind"), F.col("longer").alias("region")).distinct()))
        return found

    first = outweighing(rows)
    leaves = first.where("kind = 'leaf'").select("row", "region")
    found = stored(first.where("kind <> 'leaf'").groupBy("row", F.col("region").alias("new")).agg(F.min(F.when(F.col("kind") == "coarse", 2).otherwise(0)).alias("_least")))
    up = tree.where("distance > 0").select(F.col("ancestor").alias("new"), F.col("descendant").alias("_low"))
    parents = found.select("row", "new").join(up, "new").join(shuffled(found.select("row", F.col("new").alias("_low"))), ["row", "_low"]).select("row", "new").distinct()
    one = stored(found.join(shuffled(parents), ["row", "new"], "left_anti").groupBy("row").agg(F.count("*").alias("_n"), F.min("new").alias("new"), F.min("_least").alias("_least")).where("_n = 1"))
    n = evidence.origin_counts(one.select("row", F.col("new").alias("region")), "row", "region", labels, said, names, said=heard).select("row", F.col("n_sources").alias("_new_n"))
    n, asked = stored(n), stored(leaves.join(shuffled(one.select("row", "new")), "row"))
    own = stored(evidence.origin_counts(asked, "row", "region", labels, said, names, hide="new").groupBy("row").agg(F.max("n_sources").alias("_own_n")))
    settled = stored(one.join(shuffled(n), "row").join(shuffled(own), "row").where("_new_n >= greatest(_own_n, _least)").select("row", "new"))
    rows = stored(_replaced(rows, settled, tree, "source_upgrade"))

    kept = first.join(shuffled(settled.select("row")), "row", "left_anti")
    last = stored(kept.union(outweighing(rows.where(F.size("source_upgrade") > 0))))
    anywhere = stored(spoken.union(mentions(named, spelled)).distinct().withColumn("n_sources", F.lit(1)))
    nowhere = evidence.unsupported_regions(last.where("kind = 'leaf'").select("row", "region"), "row", "region", tree, anywhere)
    conflicts = by_name.where("action = 'conflict'").select("row", F.lit("name_conflict").alias("kind"), F.col("new").alias("region"))
    noted = last.where("kind <> 'leaf'").union(stored(nowhere.select("row", F.lit("unsupported").alias("kind"), "region"))).union(conflicts)
    listed = [F.sort_array(F.collect_set(F.when(F.col("kind") == k, F.col("region")))).alias(k) for k in ("name_conflict", "coarse", "longer", "unsupported")]
    all_in = rows
    for more in (sources, counted, stored(noted.groupBy("row").agg(*listed))):
        all_in = all_in.join(shuffled(more), "row", "left")
    counts_of = F.coalesce("_counted", F.array().cast("array<struct<name:string,n:bigint>>"))
    flags = {x: F.coalesce(x, empty) for x in ("name_conflict", "coarse", "longer", "unsupported")} | {
        "has_context": F.col("n_sources").isNotNull(), "called_blend": F.coalesce("_called", F.lit(False)) | F.col("is_blend"), "incomplete_blend": F.col("is_blend") & (F.size("grapes") == 1),
        "white_only": evidence.white_grapes_only(F.col("category"), F.col("colours"), F.col("grapes")), "named_whole": F.coalesce("named_whole", F.lit(False)), "grapes": counts_of,
    }
    out = evidence.evidence_rules(all_in.withColumns(flags), threshold, review_upgrades=review_upgrades)
    return out.drop("_called", "_counted", "called_blend", "incomplete_blend", "white_only", "name_upgrade", "name_conflict", "source_upgrade", "coarse", "longer", "unsupported")
