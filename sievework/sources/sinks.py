"""Sinks: every write is one job whose committer makes it whole or nothing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.rules import split_decided


def write_decided(decided: DataFrame, kept_path: str, excluded_path: str) -> None:
    """Kept and excluded rows as CSV, from one cached scan."""
    held = decided.persist()
    try:
        for part, path in zip(split_decided(held), (kept_path, excluded_path), strict=True):
            part.write.mode("overwrite").options(header=True, escape='"').csv(path)
    finally:
        held.unpersist()


def write_summary(summary: DataFrame, path: str) -> None:
    """Counts as JSON lines."""
    summary.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_phase_log(rows: DataFrame, path: str) -> None:
    """One record per product, partitioned by run; only the runs at hand are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


class ConflictError(Exception):
    """Another writer has committed a version since the one that a change was made from."""


def _versions(spark: SparkSession, root: str) -> dict[int, object]:
    """The manifests of a store by number, as paths of its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifests")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(path)] if files.exists(path) else []
    return {int(p.getName()): p for p in found if p.getName().isdigit()}


def store_version(spark: SparkSession, root: str) -> int:
    """The number of the newest version of a store; 0 where there is none."""
    return max(_versions(spark, root), default=0)


def commit_store(store: DataFrame, root: str, base: int, name: str | None = None) -> int:
    """A new version of the store made from version ``base``, stamped: its number, ``base + 1``.

    The rows are written first, where no reader looks.  A manifest that names them is then renamed to the version's number, which fails if
    that number is taken: the second of two writers from one base gets a ``ConflictError``, and its rows are removed.  Nothing is ever replaced or deleted, so readers see
    whole versions only.  The rename is atomic where the file system's is, as on HDFS.
    """
    spark, jvm = store.sparkSession, store.sparkSession._jvm
    data = f"data/{name or 'version'}-{uuid.uuid4().hex}"
    store.withColumn("generated_at", F.current_timestamp()).write.mode("errorifexists").parquet(f"{root}/{data}")
    conf, fs = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs
    final, waiting = fs.Path(f"{root}/manifests/{base + 1:012d}"), fs.Path(f"{root}/waiting/{uuid.uuid4().hex}")
    files = final.getFileSystem(conf)
    out = files.create(waiting, False)
    out.write(bytearray(json.dumps({"data": data, "name": name}).encode()))
    out.close()
    files.mkdirs(final.getParent())
    how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.NONE
    taken = base != store_version(spark, root)
    try:
        if not taken:
            fs.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(waiting), files.makeQualified(final), how)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        taken = True
    if taken:
        for own in (waiting, fs.Path(f"{root}/{data}")):
            files.delete(own, True)
        raise ConflictError(f"{root} is not at version {base} any more")
    return base + 1


def update_store(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], tries: int = 5) -> int:
    """The store changed: ``change`` is applied to its newest version, and anew if another writer was faster."""
    for left in reversed(range(tries)):
        base = store_version(spark, root)
        try:
            return commit_store(change(load_store(spark, root, base).drop("generated_at")), root, base)
        except ConflictError:
            if not left:
                raise
    raise ValueError("tries is at least 1")


def save_store(store: DataFrame, root: str, version: str) -> str:
    """A new version of the store after the newest, by a name; the path of its rows."""
    number = commit_store(store, root, store_version(store.sparkSession, root), version)
    return _data(store.sparkSession, root, number)


def _data(spark: SparkSession, root: str, number: int) -> str:
    path = _versions(spark, root).get(number)
    if path is None:
        raise FileNotFoundError(f"{root} has no version {number}")
    return f"{root}/{json.loads(spark.read.text(path.toString()).first()[0])['data']}"


def load_store(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the store, the newest if none is given."""
    return spark.read.parquet(_data(spark, root, store_version(spark, root) if version is None else version))


def append_events(events: DataFrame, path: str) -> None:
    """Events appended as JSON lines."""
    events.write.mode("append").json(path)
