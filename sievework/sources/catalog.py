"""Catalogue exports and logs read with Spark's readers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class InputError(ValueError):
    """An export that lacks a required column or is no CSV."""


def norm_col(name: str | None) -> str:
    """A header in lower case, every run of other characters one underscore, none at the ends."""
    return "_".join(re.findall("[a-z0-9]+", (name or "").lower()))


def validate_headers(columns: Sequence[str], required: Sequence[str]) -> None:
    """Raises where a required column is missing."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise InputError(f"missing columns: {', '.join(missing)}; found: {', '.join(columns)}")


def read_export(spark: SparkSession, path: str, required: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """A CSV export as strings: normalised headers, blank rows and unwanted columns gone.

    Of a repeated header the last column stays; short rows have nulls.
    """
    if not path.split("?")[0].lower().endswith(".csv"):
        raise InputError(f"not a CSV file: {path}")
    raw = spark.read.options(header=False, multiLine=True, escape='"', quote='"', mode="PERMISSIVE").csv(path)
    head = raw.first()
    names = [norm_col((h or "").lstrip("﻿")) for h in head] if head else []
    validate_headers([n for n in names if n], required)
    body = spark.read.options(header=True, multiLine=True, escape='"', quote='"', mode="PERMISSIVE", enforceSchema=True)
    body = body.schema(", ".join(f"_{i} string" for i in range(len(names)))).csv(path)
    last = {n: i for i, n in enumerate(names) if n and n not in drop}
    rows = body.where(F.concat_ws("", *[F.trim(f"_{i}") for i in range(len(names))]) != "")
    return rows.select(*[F.col(f"_{i}").alias(n) for n, i in sorted(last.items(), key=lambda x: x[1])])


def newest_file(spark: SparkSession, *folders: str, pattern: str = "*.csv") -> str | None:
    """Path of the newest file of the first folder that has any."""
    for folder in folders:
        try:
            files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime")
            found = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]
        except Exception as error:  # a folder that is not there
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found = None
        if found:
            return found
    return None


def load_products(df: DataFrame, doubles: Sequence[str] = (), ints: Sequence[str] = ()) -> DataFrame:
    """Typed products: blank text null, numbers parsed, integers cut off."""
    def of(c: str):
        bare = F.nullif(F.trim(c), F.lit(""))
        if c in doubles:
            return bare.try_cast("double").alias(c)
        return bare.try_cast("double").cast("int").alias(c) if c in ints else bare.alias(c)

    return df.select(*[of(c) for c in df.columns])


def row_count(spark: SparkSession, path: str) -> int:
    """Data rows of an upload."""
    return read_export(spark, path).count()


def read_logs(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON logs partitioned by run and phase; unreadable ones have nulls."""
    return spark.read.schema(schema).options(multiLine=True, mode="PERMISSIVE").json(folder)


def read_events(spark: SparkSession, folder: str, schema: str, stream: bool = False) -> DataFrame:
    """Event lines, batch or stream; lines that are no JSON are skipped."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("mode", "DROPMALFORMED").json(folder)


def tail(events: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """The newest ``n`` events, oldest first."""
    return events.orderBy(F.col(ts).desc()).limit(n).orderBy(ts)


def label_dims(entities: DataFrame, kind: str, fold) -> DataFrame:
    """``(kind, label_fold, entity, name, scope, is_canonical, rank)``: names first, then synonyms, then codes."""
    each = F.concat(F.array(F.struct(F.lit(0).alias("rank"), F.col("name").alias("label"))),
                    F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda s: F.struct(F.lit(1).alias("rank"), s.alias("label"))),
                    F.transform(F.array_compact(F.array("code")), lambda s: F.struct(F.lit(2).alias("rank"), s.alias("label"))))
    rows = entities.select("id", "name", "scope", "is_canonical", F.explode(each).alias("x"))
    return rows.select(F.lit(kind).alias("kind"), fold(F.col("x.label")).alias("label_fold"), F.col("id").alias("entity"), "name", "scope", "is_canonical", F.col("x.rank").alias("rank"))
