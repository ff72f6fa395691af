"""Extraction by a pluggable model: change detection, response parsing, coercion, record building."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions.text import split_child_id


def content_hash(name: Column, html: Column, tags: Column) -> Column:
    return F.md5(F.concat_ws("\u0001", name, html, F.array_join(tags, "\u0002")))


def split_by_cache(raw: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(unchanged, to do): unchanged where the earlier record has the same content hash and schema version."""
    old = previous.select(F.col("identifier"), F.col("contentHash").alias("_hash"), F.col("schemaHash").alias("_schema"))
    joined = raw.join(old, "identifier", "left").withColumn("_hit", F.col("_hash").eqNullSafe(F.col("contentHash")) & F.col("_schema").eqNullSafe(schema.schema_version()) & F.col("_hash").isNotNull())
    return joined.where("_hit").drop("_hash", "_schema", "_hit"), joined.where("NOT _hit").drop("_hash", "_schema", "_hit")


# ---- responses ------------------------------------------------------------


def json_spans(text: str) -> Iterator[str]:
    """What may be the JSON of a response, the likeliest first.

    One pass notes where the text's outermost brackets open and close, outside of
    strings. From that come: the inside of a code fence, the whole text, the
    stretch from the first curly bracket to the last, that of square ones, and at
    last the text closed where it breaks off.
    """
    opening, closing = {"{": "}", "[": "]"}, {"}": "{", "]": "["}
    bare = text.strip()
    fenced = bare.split("```")
    if len(fenced) >= 3:
        inside = fenced[1].strip()
        yield inside.removeprefix("json").strip()
    yield bare
    for first, last in opening.items():
        start, end = bare.find(first), bare.rfind(last)
        if 0 <= start < end:
            yield bare[start : end + 1]
    cut = bare.rstrip(".") if bare.endswith("...") else bare
    missing: list[str] = []
    in_string = skip = False
    for ch in cut:
        if skip:
            skip = False
        elif in_string:
            skip = ch == "\\"
            in_string = ch != '"'
        elif ch == '"':
            in_string = True
        elif ch in opening:
            missing.append(opening[ch])
        elif ch in closing and missing:
            missing.pop()
    yield cut + '"' * in_string + "".join(missing[::-1])


def first_json(text: str | None) -> str | None:
    """The first of ``json_spans`` that parses."""
    for span in json_spans(text or ""):
        try:
            json.loads(span)
            return span
        except ValueError:
            continue
    return None


@F.pandas_udf(T.StringType())
def _first_json(texts: pd.Series) -> pd.Series:
    return texts.map(first_json)


def extract_json(text: Column) -> Column:
    """The JSON of a response, as ``first_json`` finds it; null if none parses.

    A text that is JSON as it stands never leaves the JVM.
    """
    bare = F.trim(text)
    return F.when(F.try_parse_json(bare).isNotNull() & F.substring(bare, 1, 1).isin("{", "["), bare).otherwise(_first_json(text))


def parse_responses(rows: DataFrame, response: str = "response") -> DataFrame:
    """One row for each element of a response: an array gives several, with their place in ``part``."""
    text = extract_json(F.col(response))
    parts = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))
    return rows.select("*", F.posexplode(parts).alias("part", "json")).where("json IS NOT NULL")


def coerce(parsed: DataFrame, json_column: str = "json") -> DataFrame:
    """Add ``normalized``: fields with defaults; plain strings where objects are expected become their name or text."""
    j = F.try_parse_json(json_column)
    text = lambda path: F.try_variant_get(j, path, "string")
    items = lambda path: F.coalesce(F.from_json(F.to_json(F.try_variant_get(j, path, "variant")), "array<string>"), F.array().cast("array<string>"))
    field = lambda x, name: F.when(F.ltrim(x).startswith("{"), F.get_json_object(x, f"$.{name}")).otherwise(F.lit(None))
    plain = lambda x, name: F.when(F.ltrim(x).startswith("{"), F.coalesce(F.get_json_object(x, f"$.{name}"), F.lit(""))).otherwise(x)
    none = F.lit(None).cast("string")
    how = F.to_json(F.try_variant_get(j, "$.howToPlay", "variant"))
    steps = F.from_json(F.get_json_object(how, "$.steps"), "array<struct<action:string,role:string,constraint:string>>")
    said = text("$.howToPlay")
    one_step = F.array(F.struct(said.alias("action"), none.alias("role"), none.alias("constraint")))
    how_to_play = F.when(steps.isNotNull(), F.struct(steps.alias("steps"))).when(said.isNotNull() & ~F.trim(said).isin("", "null") & ~F.ltrim(how).startswith("{"), F.struct(one_step.alias("steps")))
    description = F.coalesce(text("$.description"), F.lit(""))
    terms = lambda path: F.transform(items(path), lambda x: F.struct(plain(x, "name").alias("name"), none.alias("originalName"), F.nullif(field(x, "category"), F.lit("")).alias("category")))
    practical = F.struct(
        F.nullif(text("$.practical.difficulty"), F.lit("")).alias("difficulty"),
        F.try_variant_get(j, "$.practical.typicalDurationMinutes", "int").alias("typicalDurationMinutes"),
        F.nullif(text("$.practical.energyLevel"), F.lit("")).alias("energyLevel"),
        F.struct(F.try_variant_get(j, "$.practical.groupSize.min", "int").alias("min"), F.try_variant_get(j, "$.practical.groupSize.max", "int").alias("max")).alias("groupSize"),
        F.try_variant_get(j, "$.practical.requiresPreparation", "boolean").alias("requiresPreparation"),
        F.from_json(F.to_json(F.try_variant_get(j, "$.practical.suitableFor", "variant")), "array<string>").alias("suitableFor"),
    )
    differs = lambda v: F.coalesce(F.from_json(F.get_json_object(v, "$.differsBy"), "array<string>"), F.array().cast("array<string>"))
    out = F.struct(
        F.coalesce(F.nullif(text("$.summary"), F.lit("")), description).alias("summary"),
        description.alias("description"),
        how_to_play.alias("howToPlay"),
        F.transform(items("$.variations"), lambda v: F.struct(F.coalesce(field(v, "name"), F.lit("")).alias("name"), F.coalesce(field(v, "description"), F.lit("")).alias("description"), differs(v).alias("differsBy"))).alias("variations"),
        F.transform(items("$.tips"), lambda t: F.struct(plain(t, "text").alias("text"), F.coalesce(F.nullif(field(t, "category"), F.lit("")), F.lit("general")).alias("category"))).alias("tips"),
        F.transform(items("$.referencedElements"), lambda r: F.struct(plain(r, "name").alias("name"), none.alias("identifier"), F.lit(None).cast("double").alias("confidence"))).alias("referencedElements"),
        terms("$.mechanics").alias("mechanics"),
        terms("$.skills").alias("skills"),
        practical.alias("practical"),
    )
    return parsed.withColumn("name", F.coalesce(text("$.name"), F.lit(""))).withColumn("normalized", out)


def build_elements(raw: DataFrame, extracted: DataFrame, model: str, now: str) -> DataFrame:
    """Headers from raw records, bodies from the model. Parts after the first are split children: they get their own name and id."""
    head = raw.select("identifier", F.col("name").alias("_name"), "url", "sourceName", "languageCode", "tags", "htmlContent", "contentHash", "ord")
    child = F.col("part") > 0
    stamped = F.col("normalized").withField("contentHash", F.col("contentHash")).withField("extractedAt", F.lit(now)).withField("normalizedBy", F.lit(model))
    rows = head.join(extracted.select("identifier", "part", "name", "normalized"), "identifier")
    return rows.select(
        F.when(child, split_child_id(F.col("identifier"), F.col("name"))).otherwise(F.col("identifier")).alias("identifier"),
        F.when(child, F.col("name")).otherwise(F.col("_name")).alias("name"),
        F.when(child, F.col("identifier")).alias("splitFrom"),
        "url", "sourceName", "languageCode", "tags", "htmlContent", stamped.alias("normalized"), (F.col("ord") * 64 + F.col("part")).alias("ord"),
    )


def parse_match_response(rows: DataFrame, response: str = "response") -> DataFrame:
    """Matches of a matcher's response: indexes into the row's ``ids`` array, confidence 0.5 if it gives none."""
    found = F.from_json(extract_json(F.col(response)), "array<struct<a:int,b:int,confidence:double>>")
    each = rows.select("ids", F.explode(found).alias("m"))
    return each.select(F.try_element_at("ids", F.col("m.a") + 1).alias("a"), F.try_element_at("ids", F.col("m.b") + 1).alias("b"), F.coalesce("m.confidence", F.lit(0.5)).alias("confidence")).where("a IS NOT NULL AND b IS NOT NULL")


# ---- calling a model ------------------------------------------------------


class OutOfCredit(Exception):
    """The current model can no longer be used; the next one is tried."""


def call_with_fallback(call: Callable[[str, str], str], prompt: str, models: list[str], tries: int = 5, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> tuple[str, str]:
    """(answer, model): retries with exponential waits of at most 30 s; a model out of credit is left for the next."""
    last: Exception | None = None
    for model in models:
        for n in range(tries):
            try:
                return call(model, prompt), model
            except OutOfCredit as e:
                last = e
                break
            except Exception as e:
                last = e
                sleep(min(2.0**n + jitter(), 30.0))
    raise RuntimeError("no model answered") from last


def parse_model_list(text: str | None, default: tuple[str, ...] = ("default",)) -> list[str]:
    return [m.strip() for m in (text or "").split(",") if m.strip()] or list(default)


def run_extractor(todo: DataFrame, extractor: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    """Apply a mapInPandas extractor from (identifier, name, htmlContent, languageCode, tags) to (identifier, response)."""
    return todo.select("identifier", "name", "htmlContent", "languageCode", "tags").mapInPandas(extractor, "identifier string, response string")


def stub_extractor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Deterministic stand-in for a model: the name as summary, the page's text as description."""
    import re

    for pdf in batches:
        text = pdf["htmlContent"].fillna("").map(lambda h: re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", h)).strip())
        yield pd.DataFrame({"identifier": pdf["identifier"], "response": [json.dumps({"name": n, "summary": n, "description": t}) for n, t in zip(pdf["name"], text)]})


def dropped_records(todo: DataFrame, extracted: DataFrame, reason: str = "no answer") -> DataFrame:
    """Records that no answer came back for, or none that parses, with the reason."""
    return todo.select("identifier", "name").join(extracted.select("identifier").distinct(), "identifier", "left_anti").withColumn("reason", F.lit(reason))


def run_stage(raw: DataFrame, previous: DataFrame, extractor: Callable, model: str, now: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The extraction stage: (kept from before, built anew, dropped). ``raw`` carries contentHash and ord."""
    kept, todo = split_by_cache(raw, previous)
    parsed = coerce(parse_responses(run_extractor(todo, extractor)))
    return kept, build_elements(todo, parsed, model, now), dropped_records(todo, parsed)
