"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random directions, in groups. The signs of a
group's first directions part the vectors into lines; on each line the vectors
are sorted by the group's last projection, and a window centred on each vector
collects its collisions. Collisions are counted per pair over all groups; pairs
that reach a count are verified by their cosine in double precision.

For a pair at cosine c, projections on a Gaussian direction are bivariate normal
with correlation c whatever the data. So the chance of a collision, and with it
the number of groups that gives the wanted recall at the threshold, follows from
the number of signs. That number grows with the logarithm of the number of
vectors, so that a line holds about the same number of unrelated vectors at
every size; the number of groups then grows as the vectors to the power of 0.22
(at cosine 0.9), and all work as the power of 1.22.

A cell of a line that very many vectors share is dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..plans.lineage import materialize
from .common import map_batches, table

COSINE = 0.9
RECALL = 0.9999
COLLISIONS = 2
LINE_VECTORS = 4
HOT_CELL = 8192
SEED = 7
PROJECTIONS_AT_ONCE = 1024


@dataclass(frozen=True)
class Plan:
    signs: int  # directions whose signs name a line
    width: float  # half-width of a window
    groups: int
    collisions: int  # pairs with as many are verified
    recall: float  # for a pair at the threshold


def collision_chance(signs: int, width: float, cosine: float) -> float:
    """P(all signs agree and the last projections are within the window), for a pair at this cosine."""
    return (1 - math.acos(cosine) / math.pi) ** signs * math.erf(width / math.sqrt(2 * (2 - 2 * cosine)))


def calibrate(vectors: int, cosine: float = COSINE, recall: float = RECALL, collisions: int = COLLISIONS, line_vectors: int = LINE_VECTORS) -> Plan:
    """The fewest groups that find a pair at the threshold with the wanted chance."""
    signs = min(40, max(1, math.ceil(math.log2(max(vectors, 1) / line_vectors)))) if vectors > line_vectors else 1
    width = 2.5 * math.sqrt(2 - 2 * cosine)
    chance = collision_chance(signs, width, cosine)

    def reached(groups: int) -> float:
        missed = sum(math.exp(math.lgamma(groups + 1) - math.lgamma(k + 1) - math.lgamma(groups - k + 1) + k * math.log(chance) + (groups - k) * math.log1p(-chance)) for k in range(collisions))
        return 1 - missed

    low, high = collisions, max(collisions + 1, int(40 / chance))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if reached(mid) >= recall else (mid + 1, high)
    return Plan(signs, width, low, collisions, reached(low))


def _directions(dimension: int, first: int, count: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, first])).standard_normal((dimension, count), dtype=np.float32)


def _lines(batches: Iterator[pa.RecordBatch], plan: Plan, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (line, node, at): each vector's place on its line of each group."""
    each = plan.signs + 1
    at_once = max(1, PROJECTIONS_AT_ONCE // each)
    powers = np.int64(1) << np.arange(plan.signs, dtype=np.int64)
    for batch in batches:
        lists = batch["unit"].to_pylist()
        nodes = batch["node"].to_numpy()
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(lists):
            by_size.setdefault(len(v), []).append(i)
        for size, rows in by_size.items():
            units = np.array([lists[i] for i in rows], dtype=np.float32)
            names = nodes[rows]
            for first in range(0, plan.groups, at_once):
                count = min(at_once, plan.groups - first)
                matrix = _directions(size, first, count * each, seed)
                for a in range(0, len(units), 1024):
                    at = (units[a : a + 1024] @ matrix).reshape(-1, count, each)
                    signs = (at[:, :, :-1] >= 0) @ powers
                    line = (first + np.arange(count, dtype=np.int64) << np.int64(plan.signs)) + signs
                    node = np.repeat(names[a : a + 1024], count)
                    yield pa.RecordBatch.from_arrays([pa.array(line.reshape(-1)), pa.array(node), pa.array(np.ascontiguousarray(at[:, :, -1]).reshape(-1))], ["line", "node", "at"])


def _collisions(batches: Iterator[pa.RecordBatch], width: float) -> Iterator[pa.RecordBatch]:
    """Pairs within a window of each other on each line, with how often this task saw them."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    line, cell, low, high, block, node, at, own = (whole[c].to_numpy() for c in ("line", "cell", "low", "high", "block", "node", "at", "own"))
    order = np.lexsort((at, high, low, cell, line))
    line, cell, low, high, block, node, at, own = (x[order] for x in (line, cell, low, high, block, node, at, own))
    # Rows of one cell and pair of blocks have one number; in a pair of two blocks only rows of different blocks meet.
    place = np.cumsum(np.r_[False, (line[1:] != line[:-1]) | (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    across = low != high
    keys: list[np.ndarray] = []
    size = 0
    i, ahead = np.arange(len(line)), 1

    def counted() -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(keys), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n)], ["a", "b", "n"])

    while len(i):
        i = i[i + ahead < len(line)]
        j = i + ahead
        near = (place[i] == place[j]) & (at[j] - at[i] <= width)
        i, j = i[near], j[near]
        met = (own[i] | own[j]) & ~(across[i] & (block[i] == block[j]))  # two guests meet in their own cell
        a, b = node[i[met]], node[j[met]]
        keys.append(np.column_stack((np.minimum(a, b), np.maximum(a, b))))
        size += len(a)
        if size > 1 << 20:
            yield counted()
            keys, size = [], 0
        ahead += 1
    if size:
        yield counted()


def find_links(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED, hot_cell: int = HOT_CELL) -> DataFrame:
    """``(a, b)`` with a < b for pairs of rows of (node, unit, length, values) whose cosine reaches the threshold."""
    spark = vectors.sparkSession
    plan = calibrate(vectors.count(), cosine, recall)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = map_batches(vectors.select("node", "unit"), lambda it: _lines(it, plan, seed), "line long, node long, at float")
    # A window reaches into its own cell and the next; guests from the cell below meet only the cell's own vectors.
    cell = F.floor(F.col("at") / F.lit(plan.width)).cast("int")
    ends = F.explode(F.array(F.struct(cell.alias("cell"), F.lit(True).alias("own")), F.struct((cell + 1).alias("cell"), F.lit(False).alias("own"))))
    rows = materialize(lines.select("line", "node", "at", ends.alias("c")).select("line", "node", "at", "c.cell", "c.own"), "vector-lines")
    hot = materialize(rows.groupBy("line", "cell").agg(F.count("*").alias("n")).where(F.col("n") > hot_cell), "hot-cells")
    if hot.limit(1).count():
        blocks = F.coalesce(F.ceil(F.col("n") / F.lit(hot_cell)).cast("int"), F.lit(1))
        dealt = rows.join(hot, ["line", "cell"], "left").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("line", "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "at", "own")
    else:
        zero = F.lit(0).cast("int")
        dealt = rows.select("line", "cell", zero.alias("low"), zero.alias("high"), zero.alias("block"), "node", "at", "own")
    met = map_batches(dealt.repartition(parts, "line", "cell", "low", "high"), lambda it: _collisions(it, plan.width), "a long, b long, n long")
    candidates = materialize(met.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= plan.collisions).select("a", "b"), "candidates")
    left = vectors.select(F.col("node").alias("a"), F.col("values").alias("va"), F.col("length").alias("la"))
    right = vectors.select(F.col("node").alias("b"), F.col("values").alias("vb"), F.col("length").alias("lb"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return candidates.join(left, "a").join(right, "b").where(dot / (F.col("la") * F.col("lb")) >= cosine).select("a", "b")


def link_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row, plus ``equals``, the rows with the very same vector.

    Equal vectors are one vertex with a weight: they link with one another and
    with each other's links without being expanded into pairs. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing
    and are their own component, as are, for themselves, rows without an id.
    Vectors of different lengths never link.
    """
    values = F.transform(vector_column, lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.sqrt(F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x))
    rows = df.select(F.col(id_column).alias("id"), F.when(sound, values).alias("values")).withColumn("length", length).withColumn("values", F.when((F.col("length") > 0) & (F.col("length") < F.lit(float("inf"))), F.col("values")))
    # -0.0 and 0.0 are the same component.
    rows = materialize(rows.withColumn("values", F.transform("values", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))), "vectors")
    groups = rows.where("values IS NOT NULL").groupBy("values").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.min("length").alias("length"))
    groups = groups.withColumn("node", F.monotonically_increasing_id()).withColumn("unit", F.transform("values", lambda x: (x / F.col("length")).cast("float")))
    groups = materialize(groups, "vector-groups")
    links = materialize(find_links(groups, cosine, recall), "vector-links")
    both = links.union(links.select("b", "a"))
    near = materialize(both.join(groups.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("near")), "vector-near")
    components = connected_components(links, "a", "b").withColumnRenamed("id", "node")
    placed = materialize(groups.join(components, "node", "left").join(near, "node", "left").select("values", "weight", "least", F.coalesce("component", "node").alias("component"), F.coalesce("near", F.lit(0)).alias("near")), "vector-placed")
    least = materialize(placed.groupBy("component").agg(F.min("least").alias("component_id")), "vector-least")
    named = materialize(placed.join(least, "component").select("values", "weight", "near", "component_id"), "vector-named")
    linked = rows.where("values IS NOT NULL").select("id", "values").join(named, "values")
    alone = rows.where("values IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(1).cast("long").alias("equals"))
    found = linked.select("id", (F.col("near") + F.col("weight") - 1).alias("n_links"), "component_id", F.col("weight").alias("equals")).unionByName(alone)
    return found.withColumn("kept", F.col("id") == F.col("component_id"))


def op4_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of embeddings linked at cosine 0.9 or more."""
    return link_vectors(table(spark, sf_dir, "embeddings")).select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


_ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

QUERIES = {"op4_embedding_links": op4_embedding_links}
ORACLE_SQL = {"op4_embedding_links": _ORACLE}
