"""Schemas of the catalogue and the checks on them (report only: no row is dropped)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TERM = "ARRAY<STRUCT<name STRING, originalName STRING, category STRING>>"
ELEMENT_DDL = f"""
identifier STRING, name STRING, url STRING, sourceName STRING, languageCode STRING, tags ARRAY<STRING>, htmlContent STRING, splitFrom STRING,
translationLinkEn STRING, translationLinkDe STRING, translationLinkEnIdentifier STRING, translationLinkDeIdentifier STRING,
playerCountMin INT, playerCountMax INT, categories ARRAY<STRING>, postTags ARRAY<STRING>, lastModified STRING,
normalized STRUCT<summary STRING, description STRING,
  howToPlay STRUCT<steps ARRAY<STRUCT<action STRING, role STRING, constraint STRING>>>,
  variations ARRAY<STRUCT<name STRING, description STRING, differsBy ARRAY<STRING>>>,
  tips ARRAY<STRUCT<text STRING, category STRING>>,
  referencedElements ARRAY<STRUCT<name STRING, identifier STRING, confidence DOUBLE>>,
  mechanics {_TERM}, skills {_TERM},
  practical STRUCT<difficulty STRING, typicalDurationMinutes INT, energyLevel STRING, groupSize STRUCT<min INT, max INT>, requiresPreparation BOOLEAN, suitableFor ARRAY<STRING>>,
  contentHash STRING, extractedAt STRING, normalizedBy STRING>,
derivedElements ARRAY<STRUCT<name STRING, description STRING, parentIdentifier STRING>>,
relatedIdentifiers ARRAY<STRUCT<identifier STRING, confidence DOUBLE>>,
ord BIGINT
"""
RAW_DDL = "url STRING, identifier STRING, name STRING, sourceName STRING, languageCode STRING, tags ARRAY<STRING>, translationLinkEn STRING, translationLinkDe STRING, markdown STRING, htmlContent STRING, fetchedAt STRING, lastUpdate STRING, lastModified STRING, licenseName STRING, licenseSpdxIdentifier STRING, licenseUrl STRING, categories ARRAY<STRING>, postTags ARRAY<STRING>, linksInHtmlContent ARRAY<STRING>, card MAP<STRING, STRING>"
OVERRIDE_DDL = "ord BIGINT, type STRING, elementA STRING, elementB STRING, edgeType STRING, elementId STRING, targetId STRING, requirementLabel STRING, fromElementId STRING, toElementId STRING, note STRING, contentHash STRING, contentHashes MAP<STRING, STRING>"
LICENSES = ("CC-BY-SA-3.0-DE", "CC-BY-SA-4.0", "GFDL-1.2")


def __getattr__(name: str) -> T.StructType:
    """ELEMENT, RAW and OVERRIDE; parsed on use, since parsing needs a session and workers import this module too."""
    if name in ("ELEMENT", "RAW", "OVERRIDE"):
        return T.StructType.fromDDL(globals()[f"{name}_DDL"])
    raise AttributeError(name)


def schema_version() -> Column:
    """Part of the extraction cache key; changes with the schema."""
    return F.xxhash64(F.lit(ELEMENT_DDL))


def _has_id(c: str) -> Column:
    return F.length(c) == 32


def _is_url(c: str) -> Column:
    return F.expr(f"try_parse_url({c}, 'PROTOCOL')").isNotNull()


def violations(elements: DataFrame) -> DataFrame:
    """``(identifier, broken)`` for normalised elements that break a constraint; ``broken`` names each."""
    n = "normalized"
    checks = {
        "identifier": _has_id("identifier"),
        "url": _is_url("url"),
        "languageCode": F.col("languageCode").isin("de", "en"),
        "splitFrom": F.col("splitFrom").isNull() | _has_id("splitFrom"),
        "summary": F.length(f"{n}.summary") >= 10,
        "description": F.length(f"{n}.description") >= 20,
        "difficulty": F.col(f"{n}.practical.difficulty").isNull() | F.col(f"{n}.practical.difficulty").isin("beginner", "intermediate", "advanced"),
        "energyLevel": F.col(f"{n}.practical.energyLevel").isNull() | F.col(f"{n}.practical.energyLevel").isin("low", "medium", "high"),
        "typicalDurationMinutes": F.col(f"{n}.practical.typicalDurationMinutes").isNull() | (F.col(f"{n}.practical.typicalDurationMinutes") > 0),
        "relatedIdentifiers": F.forall(F.coalesce("relatedIdentifiers", F.array()), lambda r: (F.length(r["identifier"]) == 32) & r["confidence"].between(0, 1)),
    }
    return _broken(elements, checks)


def corpus_violations(corpus: DataFrame) -> DataFrame:
    """The same for rows of the assembled corpus."""
    return _broken(
        corpus,
        {
            "identifier": _has_id("identifier"),
            "url": _is_url("url"),
            "languageCode": F.col("languageCode").isin("de", "en"),
            "markdown": F.length("markdown").between(10, 10_000),
            "tagIds": F.size("tagIds") > 0,
            "licenseSpdxIdentifier": F.col("licenseSpdxIdentifier").isin(*LICENSES),
        },
    )


def corpus_size_ok(corpus: DataFrame, low: int = 400, high: int = 1000) -> DataFrame:
    return corpus.agg(F.count("*").alias("n")).withColumn("ok", F.col("n").between(low, high))


def _broken(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    named = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())))
    return df.select("identifier", named.alias("broken")).where(F.size("broken") > 0)
