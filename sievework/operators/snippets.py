"""From search results to clean, distinct snippets: query plan, URL rules, splices, near-duplicates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.common import Shared, bounded_broadcast, cut, stored
from sievework.functions import text, urls
from sievework.operators import seeds


def expand_queries(products: DataFrame, templates: DataFrame, supplier_domains: Sequence[tuple[str, str]] = (), id_col: str = "id") -> DataFrame:
    """Every product with every template it has the values for: ``plan_idx, label, scope, query``.

    ``templates`` is (plan_idx, label, scope, query); ``{name}``, ``{sku}`` and ``{dist}`` are filled in.
    Templates with ``{sku}`` need 8 to 14 digits, those with ``{dist}`` a supplier that contains one of
    ``supplier_domains`` (substring, domain; the first that fits).  The templates, a list somebody wrote, become one array
    that each product opens: no join.
    """
    supplier = F.lower(F.coalesce(F.col("supplier"), F.lit("")))
    domain = F.coalesce(*[F.when(F.contains(supplier, F.lit(s.lower())), F.lit(d)) for s, d in supplier_domains], F.lit(None).cast("string"))
    sku = F.when(F.rlike(F.coalesce(F.col("sku").cast("string"), F.lit("")), F.lit("^[0-9]{8,14}$")), F.col("sku").cast("string"))
    known = products.select(F.col(id_col), F.col("name").alias("_name"), sku.alias("_sku"), domain.alias("_dist"))
    rows = templates.select("plan_idx", "label", "scope", "query").collect()
    each = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("plan_idx", "label", "scope", "query")]) for r in rows])
    planned = known.withColumn("_t", F.explode(each)).select(*known.columns, "_t.*")
    needs = lambda mark: F.contains(F.concat_ws(" ", "label", "scope", "query"), F.lit(mark))
    planned = planned.where((~needs("{sku}") | F.col("_sku").isNotNull()) & (~needs("{dist}") | F.col("_dist").isNotNull()))

    def filled(c: str) -> Column:
        out = F.replace(F.col(c), F.lit("{name}"), F.coalesce("_name", F.lit("")))
        out = F.replace(out, F.lit("{sku}"), F.coalesce("_sku", F.lit("")))
        return F.replace(out, F.lit("{dist}"), F.coalesce("_dist", F.lit(""))).alias(c)

    return planned.select(id_col, "plan_idx", filled("label"), filled("scope"), filled("query"))


def url_dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], url: str = "url") -> DataFrame:
    """Of the rows of a key with one URL the first in order stays; blank URLs all stay."""
    key = urls.url_key(F.col(url))
    rn = F.row_number().over(Window.partitionBy(*keys, "_url").orderBy(*order))
    blank, named = df.where(key == ""), df.where(key != "").withColumn("_url", key)
    return named.withColumn("_rn", rn).where("_rn = 1").drop("_rn", "_url").unionByName(blank)


def number_sources(df: DataFrame, keys: Sequence[str], label: str, order: Sequence[str]) -> DataFrame:
    """``source``: the label, numbered where a key has several rows of it."""
    of = Window.partitionBy(*keys, label)
    n, i = F.count("*").over(of), F.row_number().over(of.orderBy(*order))
    return df.withColumn("source", F.when(n > 1, F.concat(F.col(label), F.lit(" #"), i)).otherwise(F.col(label)))


def drop_counters(results: DataFrame, keys: Sequence[str], on_site: Column, blocked: Column) -> DataFrame:
    """Results off their site, and of those on it the blocked ones, per key."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return results.groupBy(*keys).agg(n(~on_site).alias("off_site"), n(on_site & blocked).alias("blocked"))


def mostly_failed(results: DataFrame, errors: DataFrame, key: str, label: str = "label", share: float = 0.5) -> DataFrame:
    """Per key: whether it has no result, or its failed queries are at least ``share`` of all."""
    good = results.groupBy(key).agg(F.countDistinct(label).alias("answered"))
    bad = errors.groupBy(key).agg(F.count("*").alias("failed"))
    both = good.join(bad, key, "full").fillna(0, ["answered", "failed"])
    return both.withColumn("mostly_failed", (F.col("answered") == 0) | (F.col("failed") / (F.col("failed") + F.col("answered")) >= share))


def _hash_pair(c: Column, names: Sequence[str]) -> list[Column]:
    """96 bits that stand for a text in joins."""
    return [F.xxhash64(c).alias(names[0]), F.hash(c).alias(names[1])]


def trim_splices(
    bodies: DataFrame, segments: DataFrame, keys: Sequence[str], body: str = "body", least_body: int = 800,
    least_segment: int = 80, segments_needed: int = 2, least_rest: int = 40, distinct: Column | None = None,
) -> DataFrame:
    """Cuts a long body before the first of the other texts it holds, if it holds enough of them.

    ``segments(keys..., segment)`` are compared as they came, not as cut.  ``distinct`` may forbid
    pairs (columns of both sides but their texts).  Rows whose rest is too short are dropped; ``spliced`` marks cut ones.

    Bodies and segments meet by anchors (``seeds``), of which every segment of ``least_segment`` characters has one that any text holding it has
    too, whatever its words.  Of a segment's anchors the one that fewest bodies hold is its seed.  Bodies' anchors that no segment has are
    left where they are read, if the segments' are few enough to broadcast; else anchors, keys and hashes are shuffled.  A body
    is read again for its candidates only, and a segment is known by the hashes and length of its bytes, so its text goes nowhere.  ``least_segment`` is
    at least the length of an anchor's gram, 32.  With keys only texts of a key meet.  A null body is never cut, a null segment found nowhere.
    """
    window = least_segment - seeds.GRAM + 1
    if window < 1:
        raise ValueError(f"segments have {seeds.GRAM} characters at least")
    same = [f"_same{i}" for i in range(len(keys))]
    of_key = lambda df: df.withColumns({n: F.struct(k) for n, k in zip(same, keys, strict=True)})  # noqa: E731  a null key is a key
    rows = bodies.withColumns({"_a": F.xxhash64(*bodies.columns), "_b": F.hash(*bodies.columns)})  # equal rows fare equally
    raw = F.col("segment").cast("binary")
    others = [c for c in segments.columns if c not in ("segment", *keys)]
    parts = of_key(segments.where(F.length("segment") >= least_segment)).withColumns(dict(zip(("_s", "_t"), _hash_pair(raw, ("_s", "_t")), strict=True)))
    parts = parts.withColumns({"_chars": F.length("segment"), "_bytes": F.length(raw)})
    long = of_key(rows.where(F.length(body) >= least_body)).dropDuplicates(["_a", "_b"])

    known = [*same, "_s", "_t"]
    marks = stored(seeds.text_anchors(parts.dropDuplicates(known), [*known, "_chars", "_bytes"], "segment", window))
    wanted = marks.select(*same, "seed").distinct()
    spots = stored(seeds.text_anchors(long, [*same, "_a", "_b"], body, window).join(bounded_broadcast(wanted), [*same, "seed"], "left_semi"))
    common = spots.groupBy(*same, "seed").agg(F.count("*").alias("_often"))
    rarest = F.min_by(F.struct("seed", "place"), F.struct("_often", "seed", "place")).alias("m")
    seeded = marks.join(common, [*same, "seed"]).groupBy(*known, "_chars", "_bytes").agg(rarest).select(*known, "_chars", "_bytes", "m.seed", F.col("m.place").alias("_off"))
    met = spots.join(seeded, [*same, "seed"]).withColumn("_from", F.col("place") - F.col("_off")).where("_from >= 0").drop("seed", "place", "_off", *same).distinct()
    pairs = met.join(long, ["_a", "_b"])
    if distinct is not None:
        pairs = pairs.join(parts.select(*known, *others).distinct(), known).where(distinct)
    data = F.col(body).cast("binary")
    there = F.substring(data, F.col("_from").cast("int") + 1, F.col("_bytes"))
    on = (F.col("_chars") < F.length(body)) & (F.length(there) == F.col("_bytes")) & (F.xxhash64(there) == F.col("_s")) & (F.hash(there) == F.col("_t"))
    at = F.length(F.substring(data, F.lit(1), F.col("_from").cast("int")).cast("string")) + 1
    found = pairs.where(on).groupBy("_a", "_b").agg(F.count_distinct("_s", "_t").alias("_n"), F.min(at).alias("_at"))
    cut = rows.join(found.where(F.col("_n") >= segments_needed), ["_a", "_b"], "left")
    rest = F.when(F.col("_at").isNotNull(), F.rtrim(F.expr(f"substring(`{body}`, 1, _at - 1)"))).otherwise(F.col(body))
    cut = cut.withColumn("spliced", F.col("_at").isNotNull()).withColumn(body, rest)
    return cut.where(~F.col("spliced") | (F.length(body) >= least_rest)).drop("_a", "_b", "_n", "_at")


def word_set(col: Column) -> Column:
    """Distinct words of three or more letters a-z, lower-cased but not folded."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit("([a-z]{3,})"), 1))


def near_duplicates(
    df: DataFrame, group: Sequence[str], body: str, order: Sequence[str], jaccard: float = 0.9, containment: float = 0.9, least_long: int = 800
) -> DataFrame:
    """``df`` with ``is_dup``: like an earlier row of its group that is itself no duplicate.

    Sets are of 64-bit hashes of group and word.  Equal sets of a group are one class, of which only the first row may stay.  Texts are read once, to sets.  The classes of a group meet
    in blocks (``_group_links``), without words that one of them alone has.  The greedy fold is settled in rounds: a class with no earlier link left stays, and what it links goes.
    """
    rows = stored(df.withColumn("_id", F.monotonically_increasing_id()), "zstd")
    at = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], F.col("_id"))
    text_ = F.coalesce(F.col(body), F.lit(""))
    of = F.xxhash64(F.to_json(F.struct(*group)))
    hashed = F.array_sort(F.transform(word_set(text_), lambda w: F.xxhash64(of, w)))
    sets = rows.select(of.alias("g"), F.col("_id").alias("id"), at.alias("at"), (F.length(text_) >= least_long).alias("long"), hashed.alias("w")).where("size(w) > 0")
    sets = stored(sets.withColumns({"k1": F.xxhash64("long", "w"), "k2": F.xxhash64(F.lit(1), F.col("long"), F.col("w"))}))
    keys = sets.select("id", "at", "k1", "k2")
    heads = stored(keys.groupBy("k1", "k2").agg(F.min("at").alias("at")).select("k1", "k2", "at", F.col("at._id").alias("id")))
    copies = stored(keys.select("id", "k1", "k2").join(heads.select("k1", "k2", F.col("id").alias("first")), ["k1", "k2"]).where("id <> first").select("id"))
    classes = sets.join(bounded_broadcast(copies), "id", "left_anti").select("g", "id", "long", "w")

    levels = _magnitudes(_counts(classes))
    near = stored(_group_links(classes, levels, jaccard, containment))
    times = heads.select("id", "at")
    near = near.join(times, "id").join(times.select(F.col("id").alias("other"), F.col("at").alias("other_at")), "other")
    earlier = F.col("at") < F.col("other_at")
    links = cut(near.select(F.when(earlier, F.col("id")).otherwise(F.col("other")).alias("a"), F.when(earlier, F.col("other")).otherwise(F.col("id")).alias("b")).distinct())

    gone = links.select(F.col("b").alias("id")).limit(0)
    while not links.isEmpty():
        stay = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        out = cut(stay.select(F.col("b").alias("id")).distinct())
        gone = cut(gone.union(out))
        links = cut(links.join(out.withColumnRenamed("id", "a"), "a", "left_anti").join(out.withColumnRenamed("id", "b"), "b", "left_anti"))

    settled = heads.select("k1", "k2", F.col("id").alias("_head")).join(gone.select(F.col("id").alias("_head"), F.lit(True).alias("_gone")), "_head", "left")
    marks = keys.join(settled, ["k1", "k2"]).select(F.col("id").alias("_id"), ((F.col("id") != F.col("_head")) | F.coalesce("_gone", F.lit(False))).alias("is_dup"))
    return rows.join(marks, "_id", "left").select(*df.columns, F.coalesce("is_dup", F.lit(False)).alias("is_dup"))


#: Words of most sets whose counts order all words; the others count as the rarest.
FREQUENT = 100_000
#: Places of the table of words' counts, of four bits each: 8 MB, whatever the vocabulary.
PLACES = 1 << 24
#: Longs of a set's odd signature.
SIGNED = 4


def _magnitudes(counts: DataFrame) -> Shared:
    """The powers of two of the greatest counts of the words ``counts(word, n)`` of each place, 15 at most, 16 in a long; 0 where no word counts over 1.

    A fixed number of cells is collected.  Words that share a place only seem more frequent than they are.
    """
    level = F.least(F.lit(15), F.floor(F.log2("n") + 1e-9)).cast("long")
    placed = counts.where("n > 1").select(F.pmod("word", F.lit(PLACES)).alias("place"), level.alias("level")).groupBy("place").agg(F.max("level").alias("level"))
    cells = placed.groupBy(F.shiftright("place", 4).alias("cell")).agg(F.expr("bit_or(shiftleft(level, CAST(place % 16 * 4 AS INT)))").alias("levels"))
    table = np.zeros(PLACES // 16, np.int64)
    for batch in cells.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return Shared(counts.sparkSession, table.view(np.uint64))


def _level(table: Shared, words: np.ndarray) -> np.ndarray:
    """The levels of words by the table of ``_magnitudes``."""
    spot = words.view(np.uint64) % np.uint64(PLACES)
    return (table.value[(spot >> np.uint64(4)).astype(np.int64)] >> (spot % np.uint64(16) * np.uint64(4))) & np.uint64(15)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all sets of a batch, the row of each, and the sets' sizes."""
    size = lists.value_lengths().to_numpy()
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), size), size


def _signature(words: np.ndarray, row: np.ndarray, rows: int, longs: int, odd: bool) -> np.ndarray:
    """Of each set the places that an odd number of its words has, or else any.

    Two sets differ in one word at least for each place at which their odd signatures differ, and a set lacks one word of another's for each
    place that only the other's signature has; so signatures turn away no sets that are alike.
    """
    wide = 64 * longs
    spot = (words.view(np.uint64) >> np.uint64(40)).astype(np.int64) % wide
    held = np.bincount(row * wide + spot, minlength=rows * wide).reshape(rows, wide)
    return np.packbits(held % 2 == 1 if odd else held > 0, axis=1).view(np.int64)


def _apart(of: str, longs: int) -> Column:
    """Places of ``of``, a function of the longs of two signatures."""
    return F.expr(" + ".join(f"bit_count({of.replace('@', f'[{i}]')})" for i in range(longs)))


def _longs(table: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]), pa.array(table.ravel()))


def _counts(classes: DataFrame) -> DataFrame:
    """``(word, n)`` of the words that several sets of ``classes(w)`` have."""
    return stored(classes.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n")).where("n > 1"))


def _rare_prefixes(classes: DataFrame, threshold: float, counts: DataFrame, levels: Shared) -> DataFrame:
    """``(word, ..., size, place, odd)``: of each set of ``classes(..., w)`` the rarest words, as many as a set alike may lack and one more, but for those that no other set has.

    Any order of words that all sets share will do, and rare words first make few sets meet; so the ``FREQUENT`` most frequent words are ordered by their counts and
    the others come before them, by the powers of two of theirs and by hash.  Each set is cut where it is read, and has its odd signature beside it.
    """
    top = sorted((r["word"], r["n"]) for r in counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).collect())  # a fixed number of words
    shared = Shared(classes.sparkSession, np.array(top or [(0, 0)], np.int64))
    own = [c for c in classes.columns if c != "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, often = shared.value.T
            flat, row, size = _flat(batch.column(len(own)))
            at, level = np.minimum(np.searchsorted(words, flat), len(words) - 1), _level(levels, flat)
            order = np.lexsort((flat, level, np.where(words[at] == flat, often[at], 0), row))
            place = np.arange(len(flat)) - (np.cumsum(size) - size)[row] + 1
            keep = (place <= (size - np.ceil(size * threshold - 1e-9) + 1)[row]) & (level[order] > 0)
            odd = _signature(flat, row, len(batch), SIGNED, True)
            taken = row[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[order][keep]), *(batch.column(i).take(pa.array(taken)) for i in range(len(own))), pa.array(size[taken].astype(np.int32)), pa.array(place[keep].astype(np.int32)), _longs(odd[taken])],
                names=["word", *own, "size", "place", "odd"],
            )

    kinds = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in own)
    return classes.select(*own, "w").mapInArrow(run, f"word long, {kinds}, size int, place int, odd array<long>")


def _shared_words(classes: DataFrame, levels: Shared) -> DataFrame:
    """``(id, w)``: the sets of ``classes(id, w)`` without words that surely no other set has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, row, _ = _flat(batch.column(1))
            keep = _level(levels, flat) > 0
            ends = np.append(0, np.cumsum(np.bincount(row[keep], minlength=len(batch)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[keep]))], names=["id", "w"])

    return classes.select("id", "w").mapInArrow(run, f"id {classes.schema['id'].dataType.simpleString()}, w array<long>")


def _alike(prefix: DataFrame, threshold: float) -> DataFrame:
    """``id, other, size, other_size`` of the sets of ``_rare_prefixes`` that meet on a word after which enough may be left in both, and whose signatures allow the threshold."""
    other = prefix.select("word", *[F.col(c).alias(f"other_{c}" if c != "id" else "other") for c in ("id", "size", "place", "odd")])
    met = prefix.join(other, "word").where("id < other").where(F.least("size", "other_size") >= F.lit(threshold) * F.greatest("size", "other_size") - 1e-9)
    common = 1 + F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    both = F.col("size") + F.col("other_size")
    met = met.where(common >= F.lit(threshold / (1 + threshold)) * both - 1e-9).where(_apart("odd@ ^ other_odd@", SIGNED) <= F.lit((1 - threshold) / (1 + threshold)) * both + 1e-9)
    return met.select("id", "other", "size", "other_size")


def _turned(met: DataFrame, right: Column) -> DataFrame:
    """Pairs in the order that ``right`` says."""
    return met.select(*[F.when(right, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("id", "other"), ("other", "id"), ("size", "other_size"), ("other_size", "size"))])


def _compared(met: DataFrame, classes: DataFrame, levels: Shared) -> DataFrame:
    """``met(id, other, ...)`` with ``both``, the number of words that the sets of ``classes(id, w)`` share.  Pairs come once, the smaller set first, which goes to the larger one.  Sets that met none are left where they are."""
    met = stored(_turned(met, (F.col("size") < F.col("other_size")) | ((F.col("size") == F.col("other_size")) & (F.col("id") < F.col("other")))).distinct())
    wanted = met.select("id").union(met.select("other")).distinct()
    sets = _shared_words(classes.join(bounded_broadcast(wanted), "id", "left_semi"), levels)
    pairs = met.join(sets, "id").join(sets.select(F.col("id").alias("other"), F.col("w").alias("v")), "other")
    return pairs.select(*met.columns, F.size(F.array_intersect("w", "v")).alias("both"))


#: Words that other sets share, of the sets of a block: two blocks of a group are compared at a time.
BLOCK = 1 << 22
#: Longs of the signatures by which pairs of a block are turned away; pairs, and words, that are looked at together.
WIDE, PAIRS = 16, 1 << 18


def _by_rarity(classes: DataFrame, levels: Shared) -> DataFrame:
    """``(..., size, alone, w)``: the sets of ``classes(..., w)``, rarest words first, with their sizes; of words that no other set has only the number is left."""
    own = [c for c in classes.columns if c != "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, row, size = _flat(batch.column(len(own)))
            level = _level(levels, flat)
            order = np.lexsort((flat, level, row))
            order = order[level[order] > 0]
            left = np.bincount(row[order], minlength=len(batch))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(left)).astype(np.int32)), pa.array(flat[order]))
            made = [pa.array(size.astype(np.int32)), pa.array((size - left).astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *made], names=[*own, "size", "alone", "w"])

    kinds = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in own)
    return classes.select(*own, "w").mapInArrow(run, f"{kinds}, size int, alone int, w array<long>")


def _block_links(table: pa.Table, jaccard: float, containment: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs alike of one block (``i = j``), or of one with another (rows of different ``block``), the smaller set first.

    A pair alike shares ``share`` of its smaller set, so one of that set's first words is among the other's.
    """
    share = min(jaccard, containment)
    column = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
    size, alone, long, block = (column(c) for c in ("size", "alone", "long", "block"))
    flat, row, left = _flat(table.column("w").combine_chunks())
    start, within = np.cumsum(left) - left, len(table) > 0 and column("i")[0] == column("j")[0]
    spare = size - np.ceil(size * share - 1e-9).astype(np.int64)  # words of a set that another may lack
    head = np.arange(len(flat)) - start[row] < (spare + 1 - alone)[row]
    order = np.argsort(flat[head], kind="stable")
    words, holder = flat[head][order], row[head][order]
    ends = np.append(start, len(flat))
    signed = np.empty((len(table), WIDE), np.int64)
    for i in range(0, len(table), 1000):
        k = min(i + 1000, len(table))
        signed[i:k] = _signature(flat[ends[i] : ends[k]], row[ends[i] : ends[k]] - i, k - i, WIDE, False)
    met = [np.empty(0, np.int64)]
    for some in range(0, len(flat), PAIRS):
        asked = flat[some : some + PAIRS]
        low = np.searchsorted(words, asked, "left")
        many = np.searchsorted(words, asked, "right") - low
        sums, at = np.cumsum(many), 0
        while at < len(asked):
            to = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, "right")))
            n = many[at:to]
            a = holder[np.repeat(low[at:to] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            b = np.repeat(row[some + at : some + to], n)
            fit = ((size[a] < size[b]) | ((size[a] == size[b]) & (a < b))) & ((block[a] != block[b]) | within)
            fit &= (long[a] & long[b]) | (size[a] >= jaccard * size[b] - 1e-9)
            pair = np.unique(a[fit] * len(table) + b[fit])
            a, b = pair // len(table), pair % len(table)
            lacked = alone[a] + np.bitwise_count((signed[a] & ~signed[b]).view(np.uint64)).sum(axis=1, dtype=np.int64)
            met.append(pair[lacked <= spare[a]])
            at = to
    pair = np.unique(np.concatenate(met))
    a, b = pair // max(len(table), 1), pair % max(len(table), 1)
    order = np.argsort(b, kind="stable")
    a, b, both = a[order], b[order], np.zeros(len(pair), np.int64)
    for group in np.split(np.arange(len(pair)), np.flatnonzero(np.diff(b)) + 1) if len(pair) else ():
        other = b[group[0]]
        have = np.sort(flat[start[other] : start[other] + left[other]])
        for some in np.split(group, range(PAIRS // 64, len(group), PAIRS // 64)):
            n = left[a[some]]
            asked = flat[np.repeat(start[a[some]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            found = have[np.minimum(np.searchsorted(have, asked), max(len(have) - 1, 0))] == asked if len(have) else np.zeros(len(asked), bool)
            both[some] = np.bincount(np.repeat(np.arange(len(some)), n), found, minlength=len(some)).astype(np.int64)
    alike = (both / (size[a] + size[b] - both) >= jaccard) | (long[a] & long[b] & (both / size[a] >= containment))
    return a[alike], b[alike]


def _group_links(classes: DataFrame, levels: Shared, jaccard: float, containment: float) -> DataFrame:
    """``id, other`` of the pairs alike of ``classes(g, id, long, w)`` with one ``g``.

    The sets of a group are dealt into blocks of ``BLOCK`` words or so, whose pairs are compared in a task each: most groups have one block, and each set is
    shuffled as often as its group has blocks.
    """
    ranked = _by_rarity(classes.select("g", "id", "long", "w"), levels)
    large = ranked.groupBy("g").agg(F.ceil(F.sum(F.size("w")) / F.lit(BLOCK)).alias("blocks")).where("blocks > 1")
    dealt = ranked.join(bounded_broadcast(large), "g", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)).cast("int")).withColumn("block", F.pmod(F.hash("id"), F.col("blocks")))
    dealt = dealt.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("x", "block")).withColumn("j", F.greatest("x", "block"))

    def run(table: pa.Table) -> pa.Table:
        a, b = _block_links(table, jaccard, containment)
        return pa.table({"id": table.column("id").take(pa.array(a)), "other": table.column("id").take(pa.array(b))})

    return dealt.select("g", "i", "j", "block", "id", "long", "size", "alone", "w").groupBy("g", "i", "j").applyInArrow(run, "id long, other long")


def near_duplicate_pairs(df: DataFrame, id_col: str, body: str, threshold: float = 0.9) -> DataFrame:
    """Pairs of different word sets with Jaccard at or over the threshold, and who has each set.

    Texts are read twice, to keys of their sets of 64-bit word hashes, and to the sets of one row of each class: no set is shuffled to be told apart.  Prefix filter: with a set's words in order of rarity, two sets that alike share one of the first
    ``n - ceil(t n) + 1``; sets meet on those words only, and only if enough words are left in both after the first they share and their signatures
    are near enough.  Words that one set alone has, and sets that meet none, are not shuffled.  Equal sets are one class, so a group of
    copies counts once: ``(id, other)`` are the smallest ids of two classes, or of a class and each further row of it.
    """
    hashed = F.array_sort(F.transform(word_set(F.col(body)), lambda w: F.xxhash64(w)))
    sets = df.select(F.col(id_col).alias("id"), hashed.alias("w")).where("size(w) > 0").withColumns({"k1": F.xxhash64("w"), "k2": F.xxhash64(F.lit(1), F.col("w"))})
    rows = stored(sets.select("id", "k1", "k2"))
    least = rows.groupBy("k1", "k2", "id").agg(F.count("*").alias("n")).groupBy("k1", "k2").agg(F.min(F.struct("id", "n")).alias("m"))
    least = stored(least.select("k1", "k2", "m.*"))
    classes = sets.join(bounded_broadcast(least.drop("n")), ["k1", "k2", "id"], "left_semi")
    classes = classes if least.where("n > 1").isEmpty() else classes.dropDuplicates(["k1", "k2"])  # rows repeated whole
    classes = stored(classes.select("id", "w", "k1", "k2"))
    counts = _counts(classes)
    levels = _magnitudes(counts)
    both = _compared(_alike(stored(_rare_prefixes(classes.select("id", "w"), threshold, counts, levels)), threshold), classes, levels)
    like = F.col("both") / (F.col("size") + F.col("other_size") - F.col("both"))
    pairs = both.withColumn("jaccard", like).where(F.col("jaccard") >= threshold).select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other"), "jaccard")
    copies = rows.select("id", "k1", "k2").join(classes.select("k1", "k2", F.col("id").alias("first")), ["k1", "k2"]).where("id > first")
    return pairs.unionByName(copies.select(F.col("first").alias("id"), F.col("id").alias("other"), F.lit(1.0).alias("jaccard")))


def gather_snippets(
    results: DataFrame, product: str, phrases: Sequence[str] = (), sentences: Sequence[str] = (), blocked: Sequence[str] = (), ad_hosts: Sequence[str] = (),
) -> DataFrame:
    """Fetched ``results(product, plan_idx, pos, label, scope, url, body)`` to snippets, every rule in turn."""
    url = F.col("url")
    rows = results.where(urls.on_site(url, F.col("scope"), ad_hosts) & ~urls.within_any(urls.host(url), blocked))
    rows = rows.withColumn("body", text.truncate(F.col("body"))).where("body IS NOT NULL")
    rows = url_dedupe(rows, [product], ["plan_idx", "pos"])
    rows = number_sources(rows, [product], "label", ["plan_idx", "pos"]).withColumn("domain", urls.host(url))
    rows = rows.withColumn("_clean", text.clean_text(F.col("body"), phrases, sentences)).where(text.keep_body(F.col("body"), F.col("_clean")))
    rows = rows.withColumn("body", F.col("_clean")).drop("_clean").withColumn("_key", urls.url_key(url))
    segments = rows.select(product, F.col("body").alias("segment"), F.col("_key").alias("_segment_key"))
    rows = trim_splices(rows, segments, [product], distinct=F.col("_key") != F.col("_segment_key")).drop("_key")
    return near_duplicates(rows, [product], "body", ["plan_idx", "pos"]).where("NOT is_dup").drop("is_dup", "spliced")

