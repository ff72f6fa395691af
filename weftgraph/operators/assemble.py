"""Raw records to corpus: keyed merge, tags, content filter, counts, change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_markdown

MARKDOWN_LENGTH = 10_000


def keyed_merge(rows: DataFrame, key: str = "identifier", order: str = "ord") -> DataFrame:
    """One row for each key: scalars are the last non-null, arrays the ordered union; rows stand where the first stood."""
    parts = []
    for f in rows.schema.fields:
        if f.name in (key, order):
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            lists = F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(c, F.array().cast(f.dataType)).alias("v")))), lambda x: x["v"])
            parts.append(F.array_distinct(F.flatten(lists)).alias(f.name))
        else:
            parts.append(F.max_by(c, F.when(c.isNotNull(), F.col(order))).alias(f.name))
    return rows.groupBy(key).agg(*parts, F.min(order).alias(order))


def merge_conflicts(rows: DataFrame, key: str = "identifier") -> DataFrame:
    """``(key, field)`` where rows of one key have different scalars."""
    scalars = [f.name for f in rows.schema.fields if f.name not in (key, "ord") and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    counts = rows.groupBy(key).agg(*((F.min(c) != F.max(c)).alias(c) for c in scalars))
    named = F.array_compact(F.array(*(F.when(F.col(c), F.lit(c)) for c in scalars)))
    return counts.select(key, F.explode(named).alias("field"))


def rewrite_tags(tags: Column, transformations: dict[str, list[str]]) -> Column:
    """Each tag becomes those the dictionary has for it, or stays."""
    if not transformations:
        return tags
    mapping = F.create_map(*(x for k, v in transformations.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.flatten(F.transform(tags, lambda t: F.coalesce(F.try_element_at(mapping, t), F.array(t))))


def tag_ids(rows: DataFrame, translations: DataFrame, tags: str = "tags", key: str = "identifier") -> DataFrame:
    """Add ``tagIds``: ids of tags by exact id, else by either label regardless of case; ``no_translation_id_<tag>`` without one.

    ``translations``: tag_id, de, en, dict_ord; the first in dictionary order wins.
    """
    exact = translations.select(F.col("tag_id").alias("tag"), F.col("tag_id").alias("exact"))
    labels = translations.select("tag_id", "dict_ord", F.explode(F.array(F.lower("en"), F.lower("de"))).alias("label")).groupBy("label").agg(F.min_by("tag_id", "dict_ord").alias("by_label"))
    each = rows.select(key, F.posexplode(tags).alias("i", "tag"))
    found = each.join(exact, "tag", "left").join(labels, F.lower("tag") == F.col("label"), "left").withColumn("tag_id", F.coalesce("exact", "by_label", F.concat(F.lit("no_translation_id_"), "tag")))
    lists = found.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("i", "tag_id"))), lambda x: x["tag_id"])).alias("tagIds"))
    return rows.join(lists, key, "left").withColumn("tagIds", F.coalesce("tagIds", F.array().cast("array<string>")))


def translated_tags(rows: DataFrame, translations: DataFrame, key: str = "identifier") -> DataFrame:
    """Add ``translatedTags``: labels of tagIds in the row's language; an id without one stays."""
    each = rows.select(key, "languageCode", F.posexplode("tagIds").alias("i", "tag_id"))
    label = F.when(F.col("languageCode") == "de", F.col("de")).otherwise(F.col("en"))
    named = each.join(translations.select("tag_id", "de", "en"), "tag_id", "left").withColumn("label", F.coalesce(label, "tag_id"))
    lists = named.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x["label"])).alias("translatedTags"))
    return rows.join(lists, key, "left").withColumn("translatedTags", F.coalesce("translatedTags", F.array().cast("array<string>")))


def untranslated_tags(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("tagIds").alias("tag")).where(F.col("tag").startswith("no_translation_id_")).select(F.expr("substring(tag, 19)").alias("tag")).distinct()


def enough_content(markdown: Column, tags: Column) -> Column:
    return (F.coalesce(F.length(markdown), F.lit(0)) >= 10) & (F.coalesce(F.size(tags), F.lit(0)) > 0)


def assemble(sources: list[DataFrame], transformations: dict[str, list[str]], translations: DataFrame) -> DataFrame:
    """Raw sources to corpus rows: concatenate, merge, clean, translate tags, filter, truncate."""
    rows = sources[0].withColumn("ord", F.col("ord").cast("long"))
    for rank, more in enumerate(sources[1:], 1):
        rows = rows.unionByName(more.withColumn("ord", F.lit(rank << 40) + F.col("ord")), allowMissingColumns=True)
    rows = keyed_merge(rows)
    rows = rows.withColumn("markdown", clean_markdown(F.col("markdown"))).withColumn("tags", rewrite_tags(F.col("tags"), transformations))
    rows = translated_tags(tag_ids(rows, translations), translations)
    return rows.where(enough_content(F.col("markdown"), F.col("tagIds"))).withColumn("markdown", F.substring("markdown", 1, MARKDOWN_LENGTH)).orderBy("ord")


def inventory(rows: DataFrame) -> DataFrame:
    """Elements by source and language, and how many have tags."""
    return rows.groupBy("sourceName", "languageCode").agg(F.count("*").alias("n"), F.count_if(F.size("tags") > 0).alias("tagged"))


def card_histogram(rows: DataFrame) -> DataFrame:
    """Values of each open key by frequency."""
    return rows.select(F.explode("card").alias("key", "value")).groupBy("key", "value").agg(F.count("*").alias("n")).orderBy("key", F.desc("n"), "value")


def needs_fetch(listed: DataFrame, existing: DataFrame, lastmods: DataFrame) -> DataFrame:
    """``(url, fetch)``: unknown urls; known ones only if the site map's date is later, as text, than the last fetch."""
    rows = listed.select("url").join(existing.select("url", "fetchedAt", F.lit(True).alias("known")), "url", "left").join(lastmods.select(F.col("loc").alias("url"), "lastmod"), "url", "left")
    return rows.select("url", (F.col("known").isNull() | F.coalesce(F.col("lastmod") > F.col("fetchedAt"), F.lit(False))).alias("fetch"))


def not_yet_present(listed: DataFrame, existing: DataFrame) -> DataFrame:
    return listed.join(existing.select("url"), "url", "left_anti")


def cap_per_listing(listed: DataFrame, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("listing").orderBy("ord"))
    return listed.withColumn("_k", place).where(F.col("_k") <= most).drop("_k")


def resolve_translations(rows: DataFrame) -> DataFrame:
    """Add the identifiers of linked translations."""
    ids = rows.groupBy("url").agg(F.max_by("identifier", "ord").alias("linked"))
    out = rows
    for lang in ("En", "De"):
        out = out.join(ids.select(F.col("url").alias(f"translationLink{lang}"), F.col("linked").alias(f"translationLink{lang}Identifier")), f"translationLink{lang}", "left")
    return out


def follow_translations(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Append the pages that translation links name until none is new. ``pages``: a table like ``rows`` of all loadable pages.

    Each round adds at least one of the loadable pages, so there are at most as
    many rounds as pages on the longest chain of links; a round reads only the
    pages that the round before has added.
    """
    from ..plans.lineage import materialize

    held, last = rows, rows
    while True:
        wanted = last.select(F.explode(F.array("translationLinkEn", "translationLinkDe")).alias("url")).where("url IS NOT NULL").distinct().join(held.select("url"), "url", "left_anti")
        last = materialize(pages.join(wanted, "url", "left_semi"), "followed")
        if last.limit(1).count() == 0:
            return resolve_translations(held)
        held = materialize(held.unionByName(last, allowMissingColumns=True), "held")


def merge_translation_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Fill missing fields from the linked translation, the German link first."""
    linked = rows.select(F.col("identifier").alias("_link"), *(F.col(f).alias(f"_{f}") for f in fields))
    out = rows.withColumn("_link", F.coalesce("translationLinkDeIdentifier", "translationLinkEnIdentifier")).join(linked, "_link", "left")
    return out.withColumns({f: F.coalesce(f, f"_{f}") for f in fields}).drop("_link", *(f"_{f}" for f in fields))
