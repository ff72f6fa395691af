"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows uniformly into memory-sized buckets by a seeded hash;
pass 2 reads one bucket at a time, puts it into a fixed order, applies a
Fisher-Yates permutation seeded by the bucket's number, and writes it. The
buckets one after another are the shuffled order; row p of it goes to shard
p mod n, so the shards' counts are at most one apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import materialize
from .common import map_batches, table

SHARDS = 16
SEED = 20_240_607
BUCKET_BYTES = 24 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The permutation of ``range(n)`` that bucket ``bucket`` gets: n - 1 swaps, each with a place drawn from what is left."""
    rng = np.random.Generator(np.random.PCG64([seed, bucket]))
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else []):
        order[i], order[j] = order[j], order[i]
    return np.asarray(order, dtype=np.int64)


def external_shuffle(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shuffle and shard all rows; returns the written table.

    Every column of ``df`` is kept; ``_size`` (UTF-8 bytes of the text, null as
    none, plus 1), ``_crc`` (CRC-32 of the text), ``_bucket``, ``_local`` (place
    in the bucket), ``shard`` and ``slot`` (gapless from 0 in each shard) are
    added. The result depends on the rows and ``seed`` only: repeated rows are
    interchangeable, null ids are scattered by their text, an empty table gives
    an empty one. Only where repeats of one id and text are more than a
    bucket holds does it depend on the input's partitions too, since such rows are
    dealt by their place. Columns of the input with these names are replaced.
    """
    spark = df.sparkSession
    df = df.drop("_size", "_crc", "_bucket", "_local", "shard", "slot", "_id", "_c", "_s", "_deals")
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = df.withColumn("_size", F.octet_length(text).cast("long") + 1).withColumn("_crc", F.crc32(text))
    total = sized.agg(F.sum("_size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # Rows that repeat one id and text fall into one bucket; where they are more than it holds, each is dealt by its place in the input.
    fill = max(1, bucket_bytes // 8)
    repeats = sized.groupBy(F.col(id_column).alias("_id"), "_crc", "_size").agg(F.count("*").alias("_n")).where((F.col("_n") > 1) & (F.col("_n") * F.col("_size") > bucket_bytes))
    hot = materialize(repeats.select("_id", F.col("_crc").alias("_c"), F.col("_size").alias("_s"), F.ceil(F.col("_n") * F.col("_size") / fill).cast("int").alias("_deals")), "hot-repeats")
    salt = F.lit(0).cast("long")
    if hot.limit(1).count():
        same = F.col(id_column).eqNullSafe(F.col("_id")) & (F.col("_crc") == F.col("_c")) & (F.col("_size") == F.col("_s"))
        sized = sized.join(hot, same, "left").drop("_id", "_c", "_s")
        salt = F.coalesce(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_deals")), salt)
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(id_column), F.col("_crc"), F.col("_size"), salt), F.lit(buckets)).cast("int")
    scattered = sized.withColumn("_bucket", bucket).drop("_deals").repartitionById(buckets, "_bucket")
    out = T.StructType([*scattered.schema.fields, T.StructField("_local", T.LongType())])
    keys = [(c, "ascending") for c in (id_column, "_crc", "_size")]

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        for bucket in pc.unique(whole["_bucket"]).to_pylist():
            part = whole.filter(pc.equal(whole["_bucket"], bucket))
            part = part.take(pc.sort_indices(part, sort_keys=keys)).take(pa.array(fisher_yates(part.num_rows, seed, bucket)))
            part = part.append_column("_local", pa.array(np.arange(part.num_rows)))
            yield from part.to_batches(max_chunksize=2048)

    written = materialize(map_batches(scattered, permute, out), "shuffled")
    place = F.col("_start") + F.col("_local")
    starts = bucket_starts(written.groupBy("_bucket").agg(F.count("*").alias("n")))
    return written.join(starts, "_bucket").withColumn("shard", (place % shards).cast("int")).withColumn("slot", F.floor(place / shards)).drop("_start")


def bucket_starts(counts: DataFrame) -> DataFrame:
    """``(_bucket, _start)``: the rows in all buckets before; running sums within thousands of buckets, then over the thousands."""
    counts = materialize(counts.withColumn("_block", F.floor(F.col("_bucket") / 4096)), "bucket-counts")
    blocks = counts.groupBy("_block").agg(F.sum("n").alias("_all"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_block").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(blocks, "_block").select("_bucket", (F.col("_before") + F.col("_within")).alias("_start"))


def op10_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of documents in 16 shards under the law ``rows``."""
    return external_shuffle(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op10_shuffle_shards": op10_shuffle_shards}
ORACLE_SQL: dict[str, str] = {}
