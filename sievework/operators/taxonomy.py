"""Labels to entities, and a tree of entities: resolution, closure, canonical tag sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import bounded_broadcast, cut, stored

# Classification words that labels attach to a place name, folded.
CLASS_WORDS = (
    "appellation d'origine controlee", "appellation d'origine protegee", "appellation controlee", "appellation", "aoc", "aop", "ac",
    "denominazione di origine controllata e garantita", "denominazione di origine controllata", "indicazione geografica tipica",
    "docg", "doc", "igt", "igp", "dop", "denominacion de origen calificada", "denominacion de origen", "vino de la tierra", "vino de pago",
    "doca", "doq", "do", "vp", "denominacao de origem controlada", "vinho regional", "vr", "vin de pays", "indication geographique protegee",
    "american viticultural area", "ava", "wine of origin", "wo", "qualitatswein", "pradikatswein", "dac", "geographical indication", "gi", "ig",
    "pdo", "pgi", "vqa", "premier cru", "1er cru", "grand cru", "pge", "pop",
)


def closure(edges: DataFrame, child: str = "id", parent: str = "parent_id") -> DataFrame:
    """``(ancestor, descendant, distance)`` of a forest of any depth, each node its own at distance 0.

    Paths double each round until a round finds no new pair, so a tree of depth d takes log2(d) joins; nodes on or
    below a cycle are left out (see ``refdata.check_cycles``).
    """
    nodes = edges.select(F.col(child).alias("n")).union(edges.select(F.col(parent).alias("n"))).where("n IS NOT NULL").distinct()
    step = edges.where(F.col(parent).isNotNull()).select(F.col(parent).alias("ancestor"), F.col(child).alias("descendant"), F.lit(1).alias("distance")).distinct()
    paths, reach = cut(step), 1
    while True:
        up = paths.select(F.col("ancestor").alias("_top"), F.col("descendant").alias("_mid"), F.col("distance").alias("_d"))
        far = paths.where(F.col("distance") == reach).join(up, F.col("ancestor") == F.col("_mid")).select(F.col("_top").alias("ancestor"), "descendant", (F.col("distance") + F.col("_d")).alias("distance"))
        # Only on a cycle is a pair met again, at a greater distance.
        far = cut(far.groupBy("ancestor", "descendant").agg(F.min("distance").alias("distance")).join(paths, ["ancestor", "descendant"], "left_anti"))
        if far.isEmpty():
            break
        paths, reach = cut(paths.union(far)), reach * 2
    looped = paths.where("ancestor = descendant").select(F.col("descendant").alias("_l")).distinct()
    below = paths.join(looped, F.col("ancestor") == F.col("_l")).select(F.col("descendant").alias("_b")).union(looped).distinct()
    own = nodes.select(F.col("n").alias("ancestor"), F.col("n").alias("descendant"), F.lit(0).alias("distance"))
    return paths.union(own).join(below, F.col("descendant") == F.col("_b"), "left_anti")


def path_to_root(tree: DataFrame) -> DataFrame:
    """Per node its ancestors, nearest first, without itself."""
    up = F.array_sort(F.collect_list(F.when(F.col("distance") > 0, F.struct("distance", "ancestor"))))
    return tree.groupBy(F.col("descendant").alias("id")).agg(F.transform(up, lambda x: x.ancestor).alias("parents"))


def descendants(tree: DataFrame, node: object) -> DataFrame:
    """Everything below a node."""
    return tree.where((F.col("ancestor") == F.lit(node)) & (F.col("distance") > 0)).select(F.col("descendant").alias("id"))


def tree_intervals(edges: DataFrame, child: str = "id", parent: str = "parent_id") -> DataFrame:
    """``(id, root, depth, pre, post)`` of a forest of any depth: a node is below another if its interval lies within the other's, and both have one root.

    Leaves are numbered among their siblings and weigh two steps of the walk right behind their parent's first, so only the other nodes walk.
    The walk round each tree enters and leaves each of those once.  A step's place is its distance to the end of the walk, found by pointer jumping:
    each round doubles what a step sees ahead, so n nodes take at most log2(2n) joins of the steps that go on with all, whatever the depth, where a closure has n rows for every level.
    ``pre`` and ``post`` count down to 0, the last step out of the root.  Siblings are linked within the tasks that numbered them, then task by task, so a
    node with any number of children is no task's alone.  An edge given twice counts once.  Nodes on or below a cycle are left out, as in ``closure``.
    """
    given = edges.select(F.col(child).alias("id"), F.col(parent).alias("up")).where("id IS NOT NULL").distinct()
    tops = given.where("up IS NOT NULL").select(F.col("up").alias("id")).distinct().join(given.select("id"), "id", "left_anti")
    # Numbers that the written table fixes: one per node, those of a task in a row.
    nodes = stored(given.unionByName(tops.withColumn("up", F.lit(None).cast(given.schema["up"].dataType))).withColumn("key", F.monotonically_increasing_id()))
    linked = stored(nodes.join(nodes.select(F.col("id").alias("up"), F.col("key").alias("over")), "up", "left").select("key", "over", F.shiftright("key", 33).alias("task")))
    parents = linked.where("over IS NOT NULL").select(F.col("over").alias("key")).distinct().withColumn("_inner", F.lit(True))
    linked = stored(linked.join(parents, "key", "left").select("key", "over", "task", (F.col("over").isNotNull() & F.col("_inner").isNull()).alias("leaf")))

    leaves = linked.where("leaf")
    runs = leaves.groupBy("over", "task").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("over").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    nth = F.row_number().over(Window.partitionBy("over", "task").orderBy("key")) - 1
    leaves = leaves.withColumn("nth", nth).join(runs.withColumn("earlier", F.coalesce(earlier, F.lit(0))), ["over", "task"]).select("key", "over", (F.col("earlier") + F.col("nth")).alias("nth"))
    hung = runs.groupBy(F.col("over").alias("key")).agg(F.sum("n").alias("hung"))

    inner = linked.where("NOT leaf")
    kids = inner.where("over IS NOT NULL")
    runs = kids.groupBy("over", "task").agg(F.min("key").alias("first"))
    runs = runs.withColumn("onward", F.lead("first").over(Window.partitionBy("over").orderBy("task"))).drop("first")
    beside = F.lead("key").over(Window.partitionBy("over", "task").orderBy("key"))
    siblings = kids.withColumn("beside", beside).join(runs, ["over", "task"]).select("key", F.coalesce("beside", "onward").alias("beside"))
    eldest = kids.groupBy(F.col("over").alias("key")).agg(F.min("key").alias("eldest"))
    known = inner.join(siblings, "key", "left").join(eldest, "key", "left").join(hung, "key", "left")
    step = lambda at, nxt, w, n: F.struct(at.alias("at"), nxt.alias("nxt"), F.lit(w).cast("long").alias("level"), n.cast("long").alias("n"))
    key, out, wide = F.col("key") * 2, F.col("key") * 2 + 1, F.coalesce("hung", F.lit(0)) * 2 + 1
    walk = known.select(F.explode(F.array(step(key, F.coalesce(F.col("eldest") * 2, out), 1, wide), step(out, F.coalesce(F.col("beside") * 2, F.col("over") * 2 + 1), -1, F.lit(1)))).alias("s")).select("s.*")
    walk = stored(walk.select("at", "nxt", "level", F.when(F.col("nxt").isNull(), 0).otherwise(F.col("n")).alias("ahead"), F.coalesce("nxt", "at").alias("end")))
    seen, n = 1, walk.count()
    while seen < n and not walk.where("nxt IS NOT NULL").isEmpty():
        far = walk.select(F.col("at").alias("nxt"), F.col("nxt").alias("then"), F.col("level").alias("l"), F.col("ahead").alias("a"), F.col("end").alias("e"))
        on = walk.where("nxt IS NOT NULL").join(far, "nxt")  # steps that have come to the end would all meet in one task
        on = on.select("at", F.col("then").alias("nxt"), (F.col("level") + F.col("l")).alias("level"), (F.col("ahead") + F.col("a")).alias("ahead"), F.col("e").alias("end"))
        walk = stored(walk.where("nxt IS NULL").unionByName(on))
        seen *= 2
    done = walk.where("nxt IS NULL")
    entered = done.where("at % 2 = 0").select((F.col("at") / 2).cast("long").alias("key"), (-F.col("ahead")).alias("pre"), (-F.col("level")).alias("depth"), ((F.col("end") - 1) / 2).cast("long").alias("top"))
    left = done.where("at % 2 = 1").select(((F.col("at") - 1) / 2).cast("long").alias("key"), (-F.col("ahead")).alias("post"))
    placed = stored(entered.join(left, "key"))
    at = F.col("pre") + F.col("nth") * 2 + 1
    hanging = leaves.join(placed.withColumnRenamed("key", "over"), "over").select("key", at.alias("pre"), (F.col("depth") + 1).alias("depth"), "top", (at + 1).alias("post"))
    named = placed.unionByName(hanging).join(nodes.select("id", "key").distinct(), "key")
    return named.join(nodes.select(F.col("id").alias("root"), F.col("key").alias("top")), "top").select("id", "root", "depth", "pre", "post")


def subtree_size(pre: Column, post: Column) -> Column:
    """Nodes of a subtree, its top included."""
    return ((post - pre + 1) / 2).cast("long")


def below_any(intervals: DataFrame, tops: DataFrame) -> DataFrame:
    """``(top, id, distance)``: the nodes below each of ``tops(top)``, by intervals; tops meet the nodes of their own tree only."""
    t = intervals.join(tops.select(F.col("top").alias("id")).distinct(), "id").select(F.col("id").alias("top"), "root", F.col("depth").alias("_d"), F.col("pre").alias("_from"), F.col("post").alias("_to"))
    met = intervals.join(bounded_broadcast(t), "root").where((F.col("pre") > F.col("_from")) & (F.col("post") < F.col("_to")))
    return met.select("top", "id", (F.col("depth") - F.col("_d")).alias("distance"))


def children(entities: DataFrame, parent: object, only_canonical: bool = True) -> DataFrame:
    """Entities one level below a node, by name."""
    rows = entities.where(F.col("parent_id") == F.lit(parent))
    return (rows.where("is_canonical") if only_canonical else rows).orderBy("name")


def strip_classification(folded: Column, class_words: Sequence[str] = CLASS_WORDS) -> Column:
    """A folded place name without classification words at its ends, a bracket at its end, a wrapping, or dashes around it.

    The name is a list of words, shortened from both ends by the longest classification that stands there (short ones also with
    dots), over and over: one turn for each word and bracket it has is enough to come to rest.
    """
    by_size: dict[int, list[str]] = {}
    for w in class_words:
        by_size.setdefault(len(w.split()), []).append(w)
    dotted = F.array(*[F.lit(w) for w in by_size.get(1, []) if len(w) <= 4])

    def ends_in(words: Column, last: bool) -> Column:
        """How many words at one end are a classification."""
        out = F.lit(0)
        for n, known in sorted(by_size.items()):
            part = F.array_join(F.slice(words, F.size(words) - n + 1 if last else F.lit(1), F.lit(n)), " ")
            hit = F.array_contains(F.array(*[F.lit(w) for w in known]), part)
            if n == 1:
                hit = hit | F.array_contains(dotted, F.replace(part, F.lit("."), F.lit("")))
            out = F.when(F.when(F.size(words) >= n, hit).otherwise(False), n).otherwise(out)
        return out

    def let(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of a value that is worked out once, however often it stands there."""
        return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))

    def unbracketed(name: Column) -> Column:
        def without(bracket: Column) -> Column:
            closes = (F.length(bracket) < F.length(name)) & (F.length(bracket) > 0) & (F.instr(bracket, ")") == F.length(bracket))
            return F.when(closes, F.substring(name, F.lit(1), F.length(name) - F.length(bracket) - 1)).otherwise(name)

        return let(F.substring_index(name, "(", -1), without)

    def unwrapped(words: Column) -> Column:
        within = (F.size(words) > 2) & (F.element_at(words, 1) == "appellation") & F.element_at(words, -1).isin("controlee", "protegee")
        return F.when(within, F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))).otherwise(words)

    def turn(name: Column, _: Column) -> Column:
        name = let(F.btrim(name, F.lit(" -\u2013")), unbracketed)
        words = let(F.split(F.trim(name), " +"), unwrapped)
        words = let(words, lambda w: F.slice(w, ends_in(w, False) + 1, F.size(w)))
        words = let(words, lambda w: F.slice(w, F.lit(1), F.size(w) - ends_in(w, True)))
        return F.array_join(words, " ")

    def onward(held: Column, i: Column) -> Column:
        """The next turn, while the last one has changed the name; a name that has come to rest is left alone."""
        return F.when(held["rests"], held).otherwise(let(turn(held["name"], i), lambda name: F.struct(name.alias("name"), (name == held["name"]).alias("rests"))))

    turns = F.sequence(F.lit(0), F.size(F.split(folded, r"\s+|\(")))
    plain = F.replace(folded, F.lit("\u2019"), F.lit("'"))
    rested = F.aggregate(turns, F.struct(plain.alias("name"), F.lit(False).alias("rests")), onward, lambda held: held["name"])
    return F.btrim(rested, F.lit(" -\u2013"))


def region_variants(folded: Column, class_words: Sequence[str] = CLASS_WORDS) -> Column:
    """Spellings to try in order: as given, bare, dash opened; where the label lists several names each of them, as it is and bare."""
    spaced_dash = F.regexp_replace(folded, " [-\u2013] ", ";")
    parts = F.filter(F.transform(F.split(spaced_dash, "[,;/]"), lambda p: F.trim(p)), lambda p: p != "")
    each = F.flatten(F.transform(parts, lambda p: F.array(p, strip_classification(p, class_words))))
    whole = F.array(folded, strip_classification(folded, class_words), F.regexp_replace(folded, " [-\u2013] ", " "))
    every = F.when(F.size(parts) > 1, F.concat(whole, each)).otherwise(whole)
    return F.array_distinct(F.filter(every, lambda v: v != ""))


def resolve_labels(df: DataFrame, label: str, dims: DataFrame, prefer: str | None = None) -> DataFrame:
    """Folded labels to entities: ``entity, canonical, known, alternatives``.

    ``dims(label_fold, entity, name, scope, is_canonical, rank)``.  Of several entities with a label
    one in the preferred scope (a column of ``df``) wins, then canonical ones, then by rank and
    id; ``alternatives`` are canonical names in other scopes.  Distinct labels are resolved once and joined back.
    """
    if prefer:  # a null preference must still meet itself in the joins below
        df = df.withColumn("_want", F.coalesce(F.col(prefer).cast("string"), F.lit("\u0000")))
    keys = [label, *(["_want"] if prefer else [])]
    asked = df.select(*keys).distinct()
    met = asked.join(dims, F.col(label) == F.col("label_fold"))
    same = (F.col("scope") == F.col("_want")) if prefer else F.lit(False)
    order = [F.coalesce(same, F.lit(False)).desc(), F.col("is_canonical").desc(), F.col("rank"), F.col("entity")]
    numbered = met.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    best = numbered.where("_rn = 1").select(*keys, "entity", F.col("name").alias("canonical"), F.col("scope").alias("_scope"))
    others = numbered.join(best.select(*keys, "_scope"), keys).where((F.col("scope") != F.col("_scope")) & F.col("is_canonical"))
    others = others.groupBy(*keys).agg(F.array_sort(F.collect_set(F.concat_ws(", ", "name", "scope"))).alias("alternatives"))
    found = best.drop("_scope").join(others, keys, "left")
    joined = df.join(found, keys, "left").drop("_want")
    return joined.withColumns({"known": F.col("entity").isNotNull(), "alternatives": F.coalesce("alternatives", F.array().cast("array<string>"))})


def region_candidates(df: DataFrame, folded: str, dims: DataFrame, country_labels: DataFrame) -> DataFrame:
    """For each row the entities of the first spelling that any entity has; country names come last."""
    rows = df.withColumn("_row", F.xxhash64(folded))  # equal labels have equal candidates
    tried = rows.select("_row", folded).dropDuplicates(["_row"]).select("_row", F.posexplode(region_variants(F.col(folded))).alias("_pos", "_variant"))
    tried = tried.join(country_labels.select(F.col("label_fold").alias("_variant"), F.lit(1).alias("_country")).distinct(), "_variant", "left")
    late = F.when((F.col("_pos") > 0) & F.col("_country").isNotNull(), 1).otherwise(0)
    met = tried.withColumn("_late", late).join(dims, F.col("_variant") == F.col("label_fold"))
    first = F.dense_rank().over(Window.partitionBy("_row").orderBy("_late", "_pos"))
    return rows.join(met.withColumn("_r", first).where("_r = 1").drop("_r", "_late", "_country", "_pos", "label_fold"), "_row").drop("_row")


def is_phrase(folded: Column, patterns: Sequence[str]) -> Column:
    """Whether a folded name is blank or holds a filler phrase."""
    return (F.coalesce(folded, F.lit("")) == "") | F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(folded, p))


def resolve_category(folded: Column, aliases: dict[str, str]) -> Column:
    """One of the categories by its folded aliases, null for none."""
    pairs = [F.lit(x) for kv in sorted(aliases.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), folded) if pairs else F.lit(None).cast("string")


def infer_country(candidates: DataFrame, row: str) -> DataFrame:
    """Per row the one country that its unambiguous canonical regions agree on.

    ``candidates(row, region, country, is_canonical)``: all readings of each region of a row.
    """
    per = candidates.where("is_canonical").groupBy(row, "region").agg(F.count_distinct("country").alias("n"), F.min("country").alias("country"))
    agreed = per.where("n = 1").groupBy(row).agg(F.count_distinct("country").alias("n"), F.min("country").alias("inferred"))
    return agreed.where("n = 1").select(row, "inferred")


def canonicalise(proposals: DataFrame, row: str, countries: DataFrame, regions: DataFrame, grapes: DataFrame, tree: DataFrame,
                 categories: dict[str, str], phrases: Sequence[str]) -> DataFrame:
    """Proposed tag sets checked and made canonical: ``ok, normalized, issues, hints, warnings``.

    ``proposals(row, country, region[], grapes[], is_blend, organic, confidence, category)`` hold folded
    labels; ``countries``, ``regions`` and ``grapes`` are dims as in ``resolve_labels`` (scope of a region: its
    country; of a grape: none); ``tree(ancestor, descendant, distance)`` is over region entities.
    Issues come in a fixed order, each with a hint that names its values; any issue means not ok.  An empty grape list, or a blend of one, is a warning.
    """
    base = resolve_labels(proposals, "country", countries).withColumnsRenamed({"canonical": "c_name", "known": "c_known"}).drop("entity", "alternatives")
    exploded = base.select(row, "c_name", F.posexplode("region").alias("r_pos", "r_label"))
    readings = exploded.join(regions.where("is_canonical"), F.col("r_label") == F.col("label_fold")).select(row, F.col("r_label").alias("region"), F.col("scope").alias("country"), "is_canonical")
    guess = infer_country(readings, row)
    exploded = exploded.join(guess, row, "left").withColumn("want", F.coalesce("c_name", "inferred"))
    named = resolve_labels(exploded, "r_label", regions, prefer="want")
    place = regions.select(F.col("entity").alias("_e"), F.col("scope").alias("r_country"), F.col("is_canonical").alias("r_canonical")).distinct()
    named = named.join(place, F.col("entity") == F.col("_e"), "left")
    is_country = countries.select(F.col("label_fold").alias("r_label"), F.lit(True).alias("r_is_country")).distinct()
    named = named.join(is_country, "r_label", "left").withColumn("r_is_country", F.coalesce("r_is_country", F.lit(False)))
    names = regions.where("is_canonical OR NOT is_canonical").select(F.col("entity").alias("ancestor"), F.col("name").alias("a_name")).distinct()
    chain = tree.join(names, "ancestor").groupBy(F.col("descendant").alias("_d")).agg(F.array_sort(F.collect_list(F.struct("distance", "a_name"))).alias("chain"))
    named = named.join(chain, F.col("entity") == F.col("_d"), "left")
    reading = F.struct("r_pos", "r_label", "known", "r_country", "r_canonical", "r_is_country", F.transform("chain", lambda x: x.a_name).alias("chain"),
                   (F.col("want").isNull() & (F.size("alternatives") > 0)).alias("ambiguous"))
    per_region = named.groupBy(row).agg(F.array_sort(F.collect_list(reading)).alias("rs"), F.first("inferred", True).alias("inferred"))

    g = base.select(row, F.posexplode("grapes").alias("g_pos", "g_label"))
    g = resolve_labels(g, "g_label", grapes)
    tier = grapes.select(F.col("entity").alias("_e"), F.col("is_canonical").alias("g_canonical")).distinct()
    g = g.join(tier, F.col("entity") == F.col("_e"), "left").withColumn("phrase", is_phrase(F.col("g_label"), phrases))
    per_grape = g.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("g_pos", "g_label", "known", "canonical", "g_canonical", "phrase"))).alias("gs"))

    out = base.join(per_region, row, "left").join(per_grape, row, "left")
    rs, gs = F.coalesce("rs", F.expr("filter(rs, x -> true)")), F.coalesce("gs", F.expr("filter(gs, x -> true)"))
    good = F.filter(rs, lambda x: x.known & x.r_canonical)
    lands = F.array_distinct(F.transform(F.filter(rs, lambda x: x.known), lambda x: x.r_country))
    country = F.coalesce("c_name", F.when(F.size(lands) == 1, F.element_at(F.when(F.size(lands) == 1, lands), 1)))
    fine = F.array_distinct(F.transform(F.filter(gs, lambda x: x.known & x.g_canonical & ~x.phrase), lambda x: x.canonical))
    fine = F.coalesce(fine, F.array().cast("array<string>"))
    category = resolve_category(F.col("category"), categories)
    blend = F.coalesce("is_blend", F.size(fine) >= 2)
    none = F.array().cast("array<string>")
    regions_where = lambda f: F.coalesce(F.transform(F.filter(rs, f), lambda x: x.r_label), none)
    grapes_where = lambda f: F.coalesce(F.transform(F.filter(gs, f), lambda x: x.g_label), none)
    mismatch = F.col("c_name").isNotNull() & (F.coalesce(F.size(lands), F.lit(0)) > 0) & ~F.coalesce(F.array_contains(lands, F.col("c_name")), F.lit(False))
    one = lambda cond, value: F.when(F.coalesce(cond, F.lit(False)), F.array(value)).otherwise(none)
    # Each issue with the values that raise it: no value, no issue.
    checks = [
        ("unknown_country", one(F.col("country").isNotNull() & ~F.col("c_known"), F.col("country"))),
        ("ambiguous_region", regions_where(lambda x: x.ambiguous)),
        ("country_in_region_slot", regions_where(lambda x: ~x.known & x.r_is_country)),
        ("unknown_region", regions_where(lambda x: ~x.known & ~x.r_is_country)),
        ("non_canonical_region", regions_where(lambda x: x.known & ~x.r_canonical)),
        ("region_country_mismatch", one(mismatch, F.concat_ws(" / ", "c_name", F.array_join(lands, ", ")))),
        ("phrase_grapes", grapes_where(lambda x: x.phrase)),
        ("non_canonical_grape", grapes_where(lambda x: ~x.phrase & ~x.known)),
        ("placeholder_grape", grapes_where(lambda x: ~x.phrase & x.known & ~x.g_canonical)),
        ("unknown_category", one(F.col("category").isNotNull() & category.isNull(), F.col("category"))),
        ("is_blend_mismatch", one(~F.col("is_blend") & (F.size(fine) >= 2), F.lit("false"))),
    ]
    issues = F.array_compact(F.array(*[F.when(F.size(v) > 0, F.lit(name)) for name, v in checks]))
    hints = F.array_compact(F.array(*[F.when(F.size(v) > 0, F.concat(F.lit(f"{name}: "), F.array_join(v, ", "))) for name, v in checks]))
    warnings = F.array_compact(F.array(F.when(F.size(fine) == 0, F.lit("empty_grapes")), F.when(F.coalesce("is_blend", F.lit(False)) & (F.size(fine) == 1), F.lit("blend_of_one"))))
    normal = F.struct(
        country.alias("country"), F.coalesce(F.array_distinct(F.flatten(F.transform(good, lambda x: x.chain))), F.array().cast("array<string>")).alias("region"), fine.alias("grapes"),
        blend.alias("is_blend"), F.coalesce("organic", F.lit(False)).alias("organic"), F.col("confidence").cast("int").alias("confidence"), category.alias("category"),
    )
    return out.select(row, issues.alias("issues"), hints.alias("hints"), warnings.alias("warnings"), normal.alias("normalized"), (F.size(issues) == 0).alias("ok"))


def lookup(df: DataFrame, label: str, dims: DataFrame, tree: DataFrame, prefer: str | None = None) -> DataFrame:
    """Folded labels to records: ``known, canonical, is_placeholder, parents, synonyms, alternatives``."""
    found = resolve_labels(df, label, dims, prefer)
    about = dims.groupBy(F.col("entity").alias("_e")).agg(
        (~F.max("is_canonical")).alias("is_placeholder"), F.array_sort(F.collect_set(F.when(F.col("rank") > 0, F.col("label_fold")))).alias("synonyms")
    )
    names = dims.select(F.col("entity").cast("string").alias("_a"), F.col("name").alias("_n")).distinct()
    up = tree.where("distance > 0").select(F.col("ancestor").cast("string").alias("_a"), F.col("descendant").cast("string").alias("_d"), "distance").join(names, "_a")
    parents = up.groupBy("_d").agg(F.array_sort(F.collect_list(F.struct("distance", "_n"))).alias("_p"))
    out = found.join(about, F.col("entity") == F.col("_e"), "left").join(parents, F.col("entity").cast("string") == F.col("_d"), "left")
    listed = F.coalesce(F.transform("_p", lambda x: x["_n"]), F.array().cast("array<string>"))
    return out.withColumn("parents", F.when(F.col("known"), listed)).drop("_e", "_d", "_p")


def list_names(entities: DataFrame, scope: str | None = None, edges: DataFrame | None = None, region: object = None) -> DataFrame:
    """Canonical names in order, of one country, or of the grapes that ``edges(left_id, right_id)`` give a region."""
    rows = entities.where("is_canonical")
    if scope is not None:
        rows = rows.where(F.col("scope") == scope)
    if edges is not None:
        rows = rows.join(edges.where(F.col("left_id") == F.lit(region)).select(F.col("right_id").alias("id")).distinct(), "id", "left_semi")
    return rows.select("id", "name").distinct().orderBy("name")
