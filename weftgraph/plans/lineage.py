"""Lineage cuts that survive the loss of executors.

``materialize`` writes a DataFrame as Parquet below ``spark.checkpoint.dir`` (a
folder all executors share) and reads it back, so iterative plans stay short and
a later stage restarts from files instead of from lost shuffle blocks.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="weftgraph-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/weftgraph-{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of what was written."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job, deleted together as soon as their readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """Write ``df`` to the shared folder and return a reader of what was written."""
        path = new_path(self.spark, tag)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        for path in self.paths:
            discard(self.spark, path)
        self.paths.clear()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written folder through the Hadoop file system that owns it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    if path in _written:
        _written.remove(path)


def _cleanup() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_written):
        try:
            if spark is not None:
                discard(spark, path)
        except Exception:  # the session may be gone already
            return


atexit.register(_cleanup)
