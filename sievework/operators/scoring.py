"""Batch scoring with a pluggable scorer, its gates, and the loop that asks again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.common import cut
from sievework.functions import text
from sievework.operators import selection

#: Rows that are scored at once, in batches; texts of so many are held as Python objects.
SLICE = 256
Scorer = Callable[[str, list[str]], dict[int, tuple[int, list[str]]]]


def lexical_scorer(name: str, bodies: list[str]) -> dict[int, tuple[int, list[str]]]:
    """Share of the name's words in each body, from 0 to 100: deterministic and offline."""
    want = {w for w in name.lower().split() if len(w) >= 3}
    out = {}
    for i, body in enumerate(bodies):
        have = set(body.lower().split())
        out[i] = (round(100 * len(want & have) / len(want)) if want else 0, ["producer"] if want & have else [])
    return out


def score_batches(df: DataFrame, scorer: Scorer = lexical_scorer, name: str = "name", body: str = "body", key: str = "product_id", batch_size: int = 8, order: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``score`` and ``facts``; both null where the scorer's reply leaves a row out.

    Rows of one product go to the scorer in batches, in the order of ``order`` (all columns, if none is given), whatever partitions and Arrow batches
    they come in: a product is one task's, sorted, and a batch that Arrow cuts waits for its rest.  Put filters before: they do not pass a mapInArrow.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, score int, facts array<string>"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    by = [key, *(order or [c for c in df.columns if c != key and "map<" not in kinds[c] and "variant" not in kinds[c]])]
    reads = [df.columns.index(c) for c in (key, name, body)]

    def scored(rows: pa.Table, ends: list[int]) -> Iterator[pa.RecordBatch]:
        """Rows with what the scorer says of each batch, which ends where told."""
        names, bodies, every = rows.column(reads[1]).to_pylist(), rows.column(reads[2]).to_pylist(), []
        for start, end in zip([0, *ends], ends, strict=False):
            reply = scorer(names[start] or "", [b or "" for b in bodies[start:end]])
            every += [reply.get(j, (None, None)) for j in range(end - start)]
        out = rows.append_column("score", pa.array([s for s, _ in every], pa.int32())).append_column("facts", pa.array([f for _, f in every], pa.list_(pa.string())))
        yield from out.combine_chunks().to_batches()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            for at in range(0, part.num_rows, SLICE):  # few rows at a time become Python objects
                rows = pa.Table.from_batches([part.slice(at, SLICE)])
                rows = rows if held is None else pa.concat_tables([held, rows])
                products = rows.column(reads[0]).to_pylist()
                ends, start = [], 0
                for i in range(1, len(products)):
                    if products[i] != products[i - 1] or i - start == batch_size:
                        ends.append(i)
                        start = i
                if ends:
                    yield from scored(rows.slice(0, start), ends)
                held = rows.slice(start)  # it may go on
        if held is not None and held.num_rows:
            yield from scored(held, [held.num_rows])

    return df.repartition(key).sortWithinPartitions(*by).mapInArrow(run, schema)


def reask_missing(df: DataFrame, keys: Sequence[str], scorers: Sequence[Scorer], **options) -> DataFrame:
    """Scores ``df`` with the first scorer, what it left out with the next, and so on; ``unscored`` rows get 0.

    Each round is cut from its lineage, so no row is scored twice.
    """
    done, left = None, df
    for scorer in scorers:
        scored = cut(score_batches(left, scorer, **options))
        got = scored.where("score IS NOT NULL").withColumn("unscored", F.lit(False))
        done = got if done is None else done.unionByName(got)
        left = scored.where("score IS NULL").drop("score", "facts")
        if left.isEmpty():
            return done
    rest = left.withColumns({"score": F.lit(0), "facts": F.array().cast("array<string>"), "unscored": F.lit(True)})
    return done.unionByName(rest)


def parse_reply(reply: Column, allowed: Sequence[str] = ("grape", "producer", "region")) -> Column:
    """A reply's first to last brace as map index -> (score 0..100, allowed facts sorted); null if it is no JSON.

    An entry is a number, or an object with ``score`` and ``facts``.
    """
    raw = F.from_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0), "map<string,string>")
    known = F.array(*[F.lit(a) for a in allowed])

    def entry(k: Column, v: Column) -> Column:
        obj = F.from_json(v, "struct<score:string,facts:array<string>>")
        number = F.coalesce(v.try_cast("double"), obj.score.try_cast("double"))
        facts = F.coalesce(F.array_sort(F.array_intersect(F.array_distinct(obj.facts), known)), F.array().cast("array<string>"))
        return F.struct(F.when(number.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), F.round(number).cast("int")))).alias("score"), facts.alias("facts"))

    return F.map_filter(F.transform_values(raw, entry), lambda k, v: v.score.isNotNull())


def content_gates(df: DataFrame, echo: str, conflicts: dict[str, Sequence[str]], own: str, body: str = "body", url: str = "url", category: str = "category") -> DataFrame:
    """``dropped_reason`` search_page or colour_conflict, where none is set yet."""
    slug = text.slug_words(F.col(url))
    reason = F.when(text.is_search_echo(F.col(body), echo), "search_page").when(text.value_conflict(slug, F.col(category), conflicts, F.col(own)), "colour_conflict")
    return df.withColumn("dropped_reason", F.coalesce("dropped_reason", reason))


def producer_gate(df: DataFrame, tokens: str, hay: str) -> DataFrame:
    """``dropped_reason`` producer_absent where no token of name or brand is in body or URL."""
    return df.withColumn("dropped_reason", F.coalesce("dropped_reason", F.when(~text.contains_any(F.col(hay), F.col(tokens)), F.lit("producer_absent"))))


def name_coverage(tokens: Column, hay: Column, body: Column) -> Column:
    """Whether body or URL hold all tokens of the name and the body is no list page."""
    return text.contains_all(hay, tokens) & ~text.is_list_page(body)


def score_and_assemble(
    snippets: DataFrame, scorers: Sequence[Scorer], echo: str, conflicts: dict[str, Sequence[str]], threshold: int = 70, top_n: int = 5, key: str = "product_id"
) -> tuple[DataFrame, DataFrame]:
    """Scored snippets, and the context of each product that has one.

    ``snippets(key, pos, name, category, tokens, own, hay, body, url, source, n_grapes, n_regions)``: gates come
    before the scorer, since a filter does not pass a mapInArrow; snippets they drop score 0.
    """
    gated = producer_gate(content_gates(snippets.withColumn("dropped_reason", F.lit(None).cast("string")), echo, conflicts, "own"), "tokens", "hay")
    scored = reask_missing(gated.where("dropped_reason IS NULL"), [key, "pos"], scorers, key=key)
    scored = scored.withColumn("dropped_reason", F.when(F.col("unscored"), F.lit("unscored")))
    out = gated.where("dropped_reason IS NOT NULL").withColumns({"score": F.lit(0), "facts": F.array().cast("array<string>"), "unscored": F.lit(False)})
    every = scored.unionByName(out).withColumnRenamed("score", "match_score").withColumn("family", selection.source_family(F.col("source")))
    rank = [*selection.fact_rank(F.col("n_grapes"), F.col("n_regions"), F.col("match_score")), F.col("pos")]
    picked = selection.pick_diverse(selection.survivors(every, threshold), [key], "family", rank, F.contains("source", F.lit("(distributor)")), top_n)
    return every, selection.build_context(picked, [key])
