"""Reports for people who review the graph; all return DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import confidence_band
from .components import connected_components
from .query import element_detail

SHOWN_TYPES = ("hasMechanic", "trainsSkill", "hasTag", "sourcedFrom", "translationOf", "canonicalOf")


def cluster_review(edges: DataFrame) -> DataFrame:
    """Concepts (canonicals joined by translation): members, least, mean and most confidence; least certain first."""
    concepts = connected_components(edges.where("type = 'translationOf'")).withColumnRenamed("id", "dst")
    links = edges.where("type = 'canonicalOf'").join(concepts, "dst", "left").withColumn("concept", F.coalesce("component", "dst"))
    return links.groupBy("concept").agg(
        F.count("*").alias("members"), F.min("confidence").alias("least"), F.avg("confidence").alias("mean"), F.max("confidence").alias("most"), F.array_sort(F.collect_set("src")).alias("ids")
    ).orderBy("least", "concept")


def confidence_histogram(clusters: DataFrame, column: str = "least") -> DataFrame:
    return clusters.groupBy(confidence_band(F.col(column)).alias("band")).agg(F.count("*").alias("n"))


def hubs(nodes: DataFrame, edges: DataFrame, samples: int = 5) -> DataFrame:
    """Degree of nodes that are no elements or sources, and labels of the first few neighbours."""
    ends = edges.select(F.col("dst").alias("id"), F.col("src").alias("other"), "ord").union(edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), "ord"))
    wanted = nodes.where(~F.col("type").isin("Element", "Source")).select("id", "type", "label")
    degree = ends.join(wanted.select("id"), "id", "left_semi").groupBy("id").agg(F.count("*").alias("degree"))
    seen = ends.join(wanted.select("id"), "id", "left_semi").join(nodes.select(F.col("id").alias("other"), F.col("label").alias("near")), "other").groupBy("id", "near").agg(F.min("ord").alias("ord"))
    from pyspark.sql import Window

    first = seen.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("ord", "near"))).where(F.col("k") <= samples)
    shown = first.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "near"))), lambda x: x["near"]).alias("samples"))
    return wanted.join(degree, "id").join(shown, "id", "left").orderBy(F.desc("degree"), "id")


def show_element(edges: DataFrame, nodes: DataFrame, element_id) -> DataFrame:
    """``(type, direction, n, others)``: one element's edges of the shown types, by type and direction, the ends' labels in order."""
    rows = element_detail(edges, nodes, element_id).where(F.col("type").isin(*SHOWN_TYPES))
    return rows.groupBy("type", "direction").agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda x: x["label"]).alias("others"))


def report(rows: DataFrame, most: int = 30) -> DataFrame:
    """The first rows of a sorted report; the limit is the report's feature."""
    return rows.limit(most)


def status(sources: DataFrame, files: DataFrame, meta: DataFrame) -> DataFrame:
    """``(source, present, nodes, edges)``: which sources have a file, beside the graph's counters."""
    have = files.select("source").distinct().withColumn("present", F.lit(True))
    counters = meta.select(F.col("nodeCount").alias("nodes"), F.col("edgeCount").alias("edges"))
    return sources.select("source").distinct().join(have, "source", "left").withColumn("present", F.coalesce("present", F.lit(False))).join(F.broadcast(counters))


def random_canonicals(elements: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """A sampling operator: n canonical elements, the same for the same seed."""
    return elements.where("canonical").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "id")), "id").limit(n)


def add_override(overrides: DataFrame, new: DataFrame) -> DataFrame:
    """Append records unless an identical one is there; maps are compared by their JSON."""
    plain = [c for c in overrides.columns if c != "ord"]
    key = F.to_json(F.struct(*plain))
    start = overrides.agg(F.coalesce(F.max("ord") + 1, F.lit(0)).alias("start"))
    fresh = new.withColumn("_key", key).join(overrides.select(key.alias("_key")), "_key", "left_anti").drop("_key")
    return overrides.unionByName(fresh.join(F.broadcast(start)).withColumn("ord", F.col("start") + F.col("ord")).drop("start").select(overrides.columns))


def golden_recall(results: DataFrame, fields: list[str]) -> DataFrame:
    """Share of expected names found, for each field of (expected_<field>, found_<field>) arrays, and their mean."""
    lower = lambda c: F.array_distinct(F.transform(c, F.lower))
    recall = {f: F.when(F.size(f"expected_{f}") == 0, 1.0).otherwise(F.size(F.array_intersect(lower(f"expected_{f}"), lower(f"found_{f}"))) / F.greatest(F.size(lower(f"expected_{f}")), F.lit(1))) for f in fields}
    scored = results.select("id", *(c.alias(f) for f, c in recall.items()))
    return scored.withColumn("overall", sum((F.col(f) for f in fields), F.lit(0.0)) / len(fields))
