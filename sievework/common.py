"""Small helpers that every part of the library shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.cloudpickle import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when its counted rows do not exceed this.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    One of our own is made only where that is unset and the master is local, as in tests; on a cluster it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _tables(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession) -> str:
    """A path of its own in the shared folder, among those of this application."""
    return f"{_tables(spark)}/{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Removes what this application has stored in the shared folder; results that still read it are to be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the cluster's shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for a broadcast join if it has at most ``rows`` rows, else unhinted.

    The count reads no more than ``rows + 1`` rows; beyond the bound Spark joins by shuffle, with
    skewed keys split by AQE.  A table that comes from here is not counted again.
    """
    if vars(df).get("_few") or df.limit(rows + 1).count() > rows:
        return df
    few = F.broadcast(df)
    few._few = True
    return few


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` hinted for a join by shuffle, as it grows with the rows of the input.

    Spark takes a stored table for no larger than its compressed files, the less the fewer columns are read, so unhinted it sends
    millions of rows by way of the driver's memory to every task.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to as many tasks as shuffles have, before dear work on each row: small files of many rows make few tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written as a compressed table in the cluster's shared folder, and read from there.

    Like ``cut``, for larger intermediate results: columns compress, checkpoints do not. The table
    stays in the folder until ``clear`` removes the application's, or whoever runs the cluster does.
    """
    path = scratch(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """A value of bounded size for all tasks, made once per Python worker and kept between tasks.

    It travels pickled by value, so executors need no copy of the package.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    @property
    def value(self) -> object:
        held = self._sent.value
        if "value" not in held:
            held["value"] = cloudpickle.loads(held["pickled"])
        return held["value"]
