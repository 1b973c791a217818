"""A corpus pipeline of five operators: documents in, encoded training stream out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs.  All stages but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.common import stored, table
from sievework.llm import bpe, langid, mixing, simhash, substring


def carried(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that clash with no operator's, and those names by the old ones."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(c).alias(n) for c, n in names.items()]), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter or with narrow margins go.

    Null and empty texts have no letter and go.  Languages whose dictionaries compress a text equally well leave it unclear: it goes.  Repeated rows
    are judged alike and all stay or go.  Very long texts are judged whole.  Columns of any name are carried.  An empty table, or one without any ``lang``, gives an empty table.
    """
    dictionaries = langid.learn(docs.where(~langid.held_out("doc_id")))
    rows, names = carried(docs)
    return restored(langid.identify(rows, dictionaries, rows.columns, names["text"]).where("accepted"), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: five-word shingles, similarity 0.8 or more.

    Null, empty and blank texts are one group.  Of rows that share the smallest id one stays, by a hash of all columns; repeated rows
    become one.  Very long texts are compared whole.  A null id stays only where its whole group has none.  Columns of any name are carried.  An empty table stays empty.
    """
    return simhash.keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of passages of 35 words or more that stand anywhere else too: all copies go, the first as well.

    Words that stay are joined by one space and ``n_chars`` counts them anew.  Null and empty texts become the empty text; a text all of
    whose words are repeated becomes empty and stays.  Repeated rows are copies of each other.  Very long texts are searched whole.  Columns of any name are carried.  An
    empty table stays empty.
    """
    rows, names = carried(docs)
    text, n_chars = names["text"], names["n_chars"]
    rest = [c for c in rows.columns if c not in (text, n_chars)]
    kept = substring.remove_repeats(rows, rest, names["doc_id"], text)
    return restored(kept.withColumns({text: F.col("kept"), n_chars: F.length("kept").cast("long")}), names)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: a row for each copy of a document that the mix takes, sorted by training position.

    Texts without words are never taken; a null source is a source of its own; repeated rows are rows of their own; copies at one position
    come by id.  Very long texts are taken whole or not at all.  Columns of any name are carried.  An empty table stays empty.
    """
    return mixing.mix(docs).select(*docs.columns)


def in_stream_order(docs: DataFrame, own: list[str]) -> DataFrame:
    """``docs``' columns ``own``, sorted as they were written: with ``stream_part``, the number of the task that wrote a row, and ``stream_row``, its place there.

    A sorted result is written as one range of rows per task, in their order; reading packs files by size, so order comes back only by sorting.
    """
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    part = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long").alias("stream_part")
    file = F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long").alias("_file")  # a task may write several files
    return docs.select(*own, part, file, row.alias("stream_row")).orderBy("stream_part", "_file", "stream_row").drop("_file")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream as token ids, in its order, with digests of the ids and of what they decode to.

    ``docs`` is a table read from Parquet; its order is that in which the stage before wrote it, and ``stream_part, stream_row`` tell a row's place in it.
    A null text encodes like the empty one, to no ids.  Repeated rows are encoded row by row.  Very long texts are encoded whole.  Columns other
    than id, language and source are left out.  An empty table gives an empty one.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    kept = ["doc_id", "lang", "source"]
    return bpe.encode(in_stream_order(docs, [*kept, "text"]), path, public_tokenizers.PATTERN, [*kept, "stream_part", "stream_row"], digests=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing_sources", mixing_sources),
    ("encoding", encoding),
]

#: SQL has no zstandard, XXH64, BPE or reachability over fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
