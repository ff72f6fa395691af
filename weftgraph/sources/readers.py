"""Readers of catalogue files; each gives rows an ``ord`` from their place in the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException

from .. import schema


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _elements(spark: SparkSession, path: str, kind: T.StructType) -> DataFrame:
    """Explode the ``elements`` array of a ``{meta, elements}`` file, with its index as ``ord``."""
    fields = [f for f in kind.fields if f.name != "ord"]
    inner = T.ArrayType(T.StructType(fields))
    rows = spark.read.schema(T.StructType([T.StructField("elements", inner)])).option("multiLine", True).json(path)
    return rows.select(F.posexplode("elements").alias("ord", "e")).select("e.*", F.col("ord").cast("long").alias("ord"))


def read_raw(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """Raw elements; a missing file is empty, or an error if ``missing_ok`` is off. Open ``card_*`` keys go to ``card``.

    A file named ``*.json`` is one ``{meta, elements}`` text, as scrapers write it
    for a site; anything else is JSON lines, a record each, which are split over tasks.
    """
    if not path_exists(spark, path):
        if missing_ok:
            return spark.createDataFrame([], T.StructType([*schema.RAW.fields, T.StructField("ord", T.LongType())]))
        raise FileNotFoundError(path)
    if path.endswith(".json"):
        text = spark.read.text(path, wholetext=True)
        parsed = text.select(F.posexplode(F.from_json(F.get_json_object("value", "$.elements"), "array<string>")).alias("ord", "j"))
    else:
        parsed = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("j"))
    keys = F.map_filter(F.from_json("j", "map<string,string>"), lambda k, _: k.startswith("card_"))
    known = T.StructType([f for f in schema.RAW.fields if f.name != "card"])
    return parsed.select(F.from_json("j", known).alias("e"), keys.alias("card"), "ord").select("e.*", "card", F.col("ord").cast("long").alias("ord"))


def read_raw_by_url(spark: SparkSession, path: str) -> DataFrame:
    """Existing raw elements, the last for each url."""
    rows = read_raw(spark, path)
    return rows.groupBy("url").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "url")), "ord").alias("e")).select("url", "e.*")


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Normalised elements of a ``{meta, elements}`` file (``*.json``) or of a written Parquet folder."""
    return _elements(spark, path, schema.ELEMENT) if path.endswith(".json") else spark.read.schema(schema.ELEMENT).parquet(path)


def read_previous_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Earlier output by identifier, the first of each; missing or corrupt counts as empty.

    Corrupt is a file that Spark cannot read or a JSON text that does not parse;
    the check reads the input once, since a later failure would be too late.
    """
    empty = spark.createDataFrame([], schema.ELEMENT)
    if not path_exists(spark, path):
        return empty
    try:
        rows = read_normalized(spark, path).where("identifier IS NOT NULL")
        first = rows.groupBy("identifier").agg(F.min_by(F.struct(*(c for c in rows.columns if c != "identifier")), "ord").alias("e")).select("identifier", "e.*").select(rows.columns)
        first.agg(F.count("*")).collect()
        return first
    except (AnalysisException, SparkRuntimeException, Py4JJavaError):
        return empty


def read_all_normalized(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several sources one after another; ``ord`` runs on from source to source."""
    out = None
    for rank, path in enumerate(paths):
        rows = read_normalized(spark, path).withColumn("ord", F.lit(rank * (1 << 40)) + F.col("ord")).withColumn("source_rank", F.lit(rank))
        out = rows if out is None else out.unionByName(rows)
    return out


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a written graph; a missing one is an error."""
    return spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Overrides in file order; missing, or of another version than 1: none. A list that people keep by hand, so one JSON text."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema.OVERRIDE)
    fields = [f for f in schema.OVERRIDE.fields if f.name != "ord"]
    kind = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("overrides", T.ArrayType(T.StructType(fields)))])
    rows = spark.read.schema(kind).option("multiLine", True).json(path).where("version = 1")
    return rows.select(F.posexplode("overrides").alias("ord", "o")).select(F.col("ord").cast("long").alias("ord"), "o.*")


def read_thesaurus(spark: SparkSession, path: str) -> DataFrame:
    """``(term_lc, canonical)`` for canonical names and variants; the last entry of a term holds."""
    kind = "sameAs ARRAY<STRUCT<canonical STRING, variants ARRAY<STRING>>>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path).select(F.posexplode("sameAs").alias("ord", "e"))
    terms = rows.select("ord", "e.canonical", F.explode(F.array_union(F.array("e.canonical"), F.coalesce("e.variants", F.array()))).alias("term"))
    return terms.groupBy(F.lower("term").alias("term_lc")).agg(F.max_by("canonical", "ord").alias("canonical"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(kind, canonical, variants, parent, ord)`` of a ``{mechanics, skills}`` file (``*.json``) or of JSON lines, a cluster each."""
    if not path.endswith(".json"):
        return spark.read.schema("kind STRING, canonical STRING, variants ARRAY<STRING>, parent STRING, ord BIGINT").json(path)
    cluster = "ARRAY<STRUCT<canonical STRING, variants ARRAY<STRING>, parent STRING>>"
    rows = spark.read.schema(f"mechanics {cluster}, skills {cluster}").option("multiLine", True).json(path)
    parts = [rows.select(F.lit(k).alias("kind"), F.posexplode(k).alias("ord", "c")).select("kind", "c.*", F.col("ord").cast("long").alias("ord")) for k in ("mechanics", "skills")]
    return parts[0].unionByName(parts[1])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """``(stage, hash)`` of the last runs; none where nothing is written yet."""
    kind = "stage STRING, hash STRING"
    return spark.read.schema(kind).json(path) if path_exists(spark, path) else spark.createDataFrame([], kind)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The assembled corpus; raises if a row breaks a constraint."""
    corpus = spark.read.parquet(path)
    bad = schema.corpus_violations(corpus).limit(5).collect()
    if bad:
        raise ValueError(f"corpus breaks its schema: {bad}")
    return corpus


def parse_sitemaps(pages: DataFrame, xml: str = "xml", ord_column: str = "ord") -> DataFrame:
    """``(loc, lastmod)`` of sitemap texts: of ``urlset`` or ``sitemapindex``; blank locations drop.

    Within a text the last duplicate wins, between texts the first. The five
    named character references of XML are decoded.
    """

    item = r"(?s)<(?:url|sitemap)>(.*?)</(?:url|sitemap)>"

    def tag(name: str):
        raw = F.regexp_extract("item", rf"(?s)<{name}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{name}>", 1)
        for named, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            raw = F.replace(raw, F.lit(named), F.lit(plain))
        return F.trim(raw)

    items = pages.select(ord_column, F.posexplode(F.regexp_extract_all(xml, F.lit(item), F.lit(1))).alias("i", "item"))
    found = items.select(ord_column, "i", tag("loc").alias("loc"), F.nullif(tag("lastmod"), F.lit("")).alias("lastmod")).where("loc <> ''")
    inside = found.groupBy(ord_column, "loc").agg(F.max_by(F.struct("lastmod"), "i").alias("s"))
    return inside.groupBy("loc").agg(F.min_by("s", ord_column).alias("s")).select("loc", "s.lastmod")
