"""From match links to clusters, one member for each source and language, and canonical elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TYPE_SUFFIX, canonical_id, cluster_id, round_half_up
from ..plans.lineage import materialize
from .components import connected_components


def cluster_links(elements: DataFrame, related: DataFrame) -> DataFrame:
    """``(src, dst, confidence)``: related identifiers (a, b, confidence; b may be unknown and still bridges) and translation links inside the set."""
    known = elements.select(F.col("id").alias("dst"))
    links = elements.select(F.col("id").alias("src"), F.explode(F.array("link_en", "link_de")).alias("dst")).where("dst IS NOT NULL").join(known, "dst", "left_semi")
    return related.select(F.col("a").alias("src"), F.col("b").alias("dst"), "confidence").unionByName(links.select("src", "dst", F.lit(1.0).alias("confidence")))


def members(elements: DataFrame, links: DataFrame) -> DataFrame:
    """``(component, id)`` of elements in components of two or more."""
    found = connected_components(links).join(elements.select("id"), "id", "left_semi")
    size = F.count("*").over(Window.partitionBy("component"))
    return found.withColumn("n", size).where("n >= 2").select("component", "id")


def one_per_source(elements: DataFrame, member: DataFrame, links: DataFrame) -> DataFrame:
    """Of each cluster's members of one source and language, that with the highest mean confidence to other groups; the first of equals.

    ``member`` may be the components themselves: ids that are no elements and
    clusters that keep fewer than two members are left out here.
    """
    placed = materialize(member.join(elements.select("id", "source", "lang", "ord"), "id"), "placed")  # read three times
    other = placed.select(F.col("id").alias("dst"), F.col("component").alias("c2"), F.col("source").alias("s2"), F.col("lang").alias("l2"))
    across = placed.join(links, placed["id"] == links["src"]).join(other, "dst").where((F.col("component") == F.col("c2")) & ((F.col("source") != F.col("s2")) | (F.col("lang") != F.col("l2"))))
    score = across.groupBy("id").agg(F.avg("confidence").alias("score"))
    best = Window.partitionBy("component", "source", "lang").orderBy(F.desc("score"), "ord")
    kept = placed.join(score, "id", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn("rank", F.row_number().over(best)).where("rank = 1")
    size = F.count("*").over(Window.partitionBy("component"))
    return kept.withColumn("n", size).where("n >= 2").select("component", "id")


def name_score(name: Column) -> Column:
    """100 without a type suffix, 50 more without a hyphen."""
    return F.when(name.rlike(TYPE_SUFFIX), 0).otherwise(100) + F.when(name.contains("-"), 0).otherwise(50)


def _longest(value: Column) -> Column:
    return F.max_by(value, F.struct(F.length(value), -F.col("ord")))


def modes_first_seen(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The most frequent non-empty value of each group in each of some columns of strings, the first seen of equals; ``rows`` is read once."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.nullif(c, F.lit("")).alias("value")) for c in columns)))
    values = rows.select(*keys, "ord", each.alias("x")).select(*keys, "ord", "x.column", "x.value").where("value IS NOT NULL")
    counted = values.groupBy(*keys, "column", "value").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return counted.groupBy(*keys).agg(*(F.max_by("value", F.when(F.col("column") == c, F.struct("n", -F.col("first")))).alias(c) for c in columns))


def merge_canonicals(elements: DataFrame, member: DataFrame) -> DataFrame:
    """One canonical element for each cluster and language.

    ``elements``: id, label, lang, source, url, description, summary, steps,
    mechanics, skills, tags, difficulty, minutes, energy, gmin, gmax, pmin, pmax,
    ord. Bounds and minutes of 0 count as missing.
    """
    keys = ["component", "lang"]
    ids = member.groupBy("component").agg(cluster_id(F.collect_list("id")).alias("cluster"))
    rows = member.join(elements, "id")
    positive = lambda c: F.nullif(F.col(c), F.lit(0))
    ordered = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda x: x[c])))
    merged = rows.groupBy(*keys).agg(
        F.max_by("label", F.struct(name_score(F.col("label")), F.length("label"), -F.col("ord"))).alias("label"),
        _longest(F.col("description")).alias("description"),
        _longest(F.col("summary")).alias("summary"),
        F.max_by("steps", F.when(F.size("steps") > 0, F.struct(F.size("steps"), -F.col("ord")))).alias("steps"),
        *(ordered(c).alias(c) for c in ("mechanics", "skills", "tags")),
        round_half_up(F.avg(positive("minutes"))).cast("int").alias("minutes"),
        *(F.min(positive(c)).alias(c) for c in ("gmin", "pmin")),
        *(F.max(positive(c)).alias(c) for c in ("gmax", "pmax")),
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "source", "url", "id"))), lambda x: F.struct(x["source"].alias("sourceName"), x["url"].alias("url"), x["id"].alias("identifier"))).alias("sources"),
        F.min("ord").alias("ord"),
    )
    merged = merged.join(modes_first_seen(rows, keys, ["difficulty", "energy"]), keys, "left")
    return merged.join(ids, "component").withColumn("id", canonical_id(F.col("lang"), F.col("cluster"))).withColumn("canonical", F.lit(True))


def canonical_ids(elements: DataFrame, member: DataFrame) -> DataFrame:
    """``(component, lang, id, ord)`` of the elements that ``merge_canonicals`` makes, for those who need no merged fields."""
    ids = member.groupBy("component").agg(cluster_id(F.collect_list("id")).alias("cluster"))
    rows = member.join(elements.select("id", "lang", "ord"), "id").groupBy("component", "lang").agg(F.min("ord").alias("ord"))
    return rows.join(ids, "component").select("component", "lang", canonical_id(F.col("lang"), F.col("cluster")).alias("id"), "ord")


def canonical_edges(elements: DataFrame, member: DataFrame, links: DataFrame, canonicals: DataFrame) -> DataFrame:
    """canonicalOf edges: to the canonical of the member's language, else to the only one there is; with mean confidence inside the cluster."""
    inside = member.join(links, member["id"] == links["src"]).join(member.select(F.col("id").alias("dst"), F.col("component").alias("c2")), "dst").where("component = c2")
    confidence = inside.groupBy("id").agg(round_half_up(F.avg("confidence"), 2).alias("confidence"))
    have = canonicals.groupBy("component").agg(*(F.max(F.when(F.col("lang") == x, F.col("id"))).alias(x) for x in ("en", "de")))
    rows = member.join(elements.select("id", "lang", "ord"), "id").join(have, "component").join(confidence, "id", "left")
    target = F.when(F.col("lang") == "de", F.coalesce("de", "en")).otherwise(F.coalesce("en", "de"))
    return rows.select(F.lit("canonicalOf").alias("type"), F.col("id").alias("src"), target.alias("dst"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "ord")


def canonical_translations(canonicals: DataFrame) -> DataFrame:
    pairs = canonicals.groupBy("component").agg(*(F.max(F.when(F.col("lang") == x, F.col("id"))).alias(x) for x in ("en", "de")), F.min("ord").alias("ord")).where("en IS NOT NULL AND de IS NOT NULL")
    return pairs.select(F.lit("translationOf").alias("type"), F.col("en").alias("src"), F.col("de").alias("dst"), F.lit(1.0).alias("confidence"), "ord")
