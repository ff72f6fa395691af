"""Connected components by contraction: vertices join a neighbour, edges are renamed, and a small rest is solved in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.lineage import Scratch, materialize

#: Edges that one task takes at the end; more are contracted first.
REST = 1 << 19


def _solve(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """``(id, root)`` of the vertices of edges (a, b), by union and find."""
    above: dict = {}

    def root(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            ra, rb = root(above.setdefault(a, a) and a), root(above.setdefault(b, b) and b)
            if ra != rb:
                above[ra] = rb
    ids = list(above)
    for at in range(0, len(ids), 50_000):
        some = ids[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, kind), pa.array([root(x) for x in some], kind)], ["id", "root"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rest: int = REST) -> DataFrame:
    """Return ``(id, component)`` for every id that occurs in an edge.

    ``component`` is the smallest id reachable. Edges are undirected; self-edges,
    repeats and rows with a null end are ignored (a null end names no vertex).

    Each round sends every vertex to whichever of itself and its neighbours has
    the smallest hash, with new hashes each round, and renames the ends of all
    edges so. At least half of a path's vertices are gone after a round, whatever
    the order of its ids, so the rounds grow with the logarithm of a component's
    diameter and each is smaller than the last. Once ``rest`` edges are left, one
    task solves them; then the rounds' maps are followed backwards. Tables are
    read from files, so both sides of each join come straight from an exchange
    and AQE can split the rows of a hub; the minima combine map-side.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)

    def plain(a, b, rows: DataFrame) -> DataFrame:
        ends = rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.isnull(a).alias("x"), F.isnull(b).alias("y"))
        return ends.where("NOT x AND NOT y AND a <> b").select("a", "b").distinct()

    # Written before it is read twice: an input that is not the same each time it is computed would give halves that do not match.
    left = scratch.keep(plain(F.col(src), F.col(dst), edges), "edges")
    kind = left.schema["a"].dataType
    maps: list[DataFrame] = []
    while left.count() > rest:
        seed = F.lit(len(maps))
        ranked = lambda c: F.struct(F.xxhash64(c, seed).alias("h"), F.col(c).alias("v"))
        both = left.select(F.col("a").alias("id"), ranked("b").alias("near")).union(left.select(F.col("b").alias("id"), ranked("a").alias("near")))
        parents = both.groupBy("id").agg(F.min("near").alias("near")).select("id", F.least("near", ranked("id"))["v"].alias("parent"))
        parents = scratch.keep(parents, "parents")
        end = lambda c: parents.select(F.col("id").alias(c), F.col("parent").alias(f"p{c}"))
        left = scratch.keep(plain(F.col("pa"), F.col("pb"), left.join(end("a"), "a").join(end("b"), "b")), "edges")
        maps.append(parents)
    arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField("id", kind), T.StructField("root", kind)])
    found = scratch.keep(left.repartition(1).mapInArrow(lambda it: _solve(it, arrow), schema), "roots")
    for parents in reversed(maps):
        known = found.select(F.col("id").alias("parent"), "root")
        found = scratch.keep(parents.join(known, "parent", "left").select("id", F.coalesce("root", "parent").alias("root")), "roots")
    smallest = found.groupBy("root").agg(F.min("id").alias("component"))
    out = materialize(found.join(smallest, "root").select("id", "component"), "components")
    scratch.close()
    return out
