"""Change detection by content hash, for batches and for a stream of records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..sources.readers import path_exists


def changed_rows(now: DataFrame, before: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of ``now`` with ``state``: new, changed or same; null hashes are equal to each other."""
    old = before.select(key, F.col(content).alias("_old"), F.lit(True).alias("_known"))
    state = F.when(F.col("_known").isNull(), "new").when(F.col(content).eqNullSafe(F.col("_old")), "same").otherwise("changed")
    return now.join(old, key, "left").withColumn("state", state).drop("_old", "_known")


def upsert_stream(stream: DataFrame, folder: str, key: str, content: str, process: Callable[[DataFrame], DataFrame], checkpoint: str, order: str = "ord") -> DataStreamWriter:
    """Process only what is new or changed in each micro-batch and append it to ``folder``.

    Of several rows of a key in a batch the one with the largest ``order`` holds.
    Results stand below ``folder/rows/batch=N``; what is known of each key, its
    last content, is a table of one row a key below ``folder/state/batch=N``, so a
    batch reads the table that the batch before it left and no history. A batch
    that is run again after a failure replaces itself.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        last = batch.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
        known_path = f"{folder}/state/batch={number - 1}"
        if path_exists(spark, known_path):
            before = spark.read.parquet(known_path)
        else:
            before = last.select(key, content).limit(0)
        fresh = changed_rows(last, before, key, content).where("state <> 'same'").drop("state")
        process(fresh).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        now = last.select(key, content)
        before.join(now, key, "left_anti").unionByName(now).write.mode("overwrite").parquet(f"{folder}/state/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
