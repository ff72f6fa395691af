"""The driver's tables as a catalogue: parts are elements, suppliers of large orders their mechanics, of small ones their requirements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same views for a SQL engine; put after WITH.
SQL = """
elements AS (SELECT 'e' || p_partkey AS id, p_name AS label, p_brand AS source, CASE WHEN p_partkey % 4 = 0 THEN 'de' ELSE 'en' END AS lang,
  CASE WHEN p_size <= 15 THEN 'beginner' WHEN p_size <= 35 THEN 'intermediate' WHEN p_size <= 45 THEN 'advanced' END AS difficulty,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS minutes,
  CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'high' WHEN p_type IN ('LARGE', 'STANDARD') THEN 'low' ELSE 'medium' END AS energy,
  p_partkey % 2 = 0 AS canonical, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 7 + 1 END AS pmin, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 7 + 6 END AS pmax,
  'about ' || p_name || ' by ' || p_brand AS summary, p_type AS kind, CAST(p_partkey AS BIGINT) AS ord FROM part),
edges AS (SELECT 'hasMechanic' AS type, 'e' || p AS src, 'm' || k AS dst, p * 100 + k AS ord FROM (SELECT DISTINCT l_partkey AS p, l_suppkey % 20 AS k FROM lineitem WHERE l_quantity > 45)
  UNION ALL SELECT 'requires', 'e' || p, 'r' || k, p * 100 + 50 + k FROM (SELECT DISTINCT l_partkey AS p, l_suppkey % 5 AS k FROM lineitem WHERE l_quantity < 3)),
nodes AS (SELECT id, 'Element' AS type, label, ord FROM elements
  UNION ALL SELECT DISTINCT dst, CASE WHEN type = 'requires' THEN 'Requirement' ELSE 'Mechanic' END, CASE WHEN type = 'requires' THEN 'Need ' ELSE 'Skillful ' END || dst, -CAST(substring(dst, 2) AS BIGINT) FROM edges)
"""


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    size, kind = F.col("p_size"), F.col("p_type")
    return p.select(
        F.concat(F.lit("e"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("label"),
        F.col("p_brand").alias("source"),
        F.when(F.col("p_partkey") % 4 == 0, "de").otherwise("en").alias("lang"),
        F.when(size <= 15, "beginner").when(size <= 35, "intermediate").when(size <= 45, "advanced").alias("difficulty"),
        F.when(size % 5 != 0, size).alias("minutes"),
        F.when(kind.isin("PROMO", "ECONOMY"), "high").when(kind.isin("LARGE", "STANDARD"), "low").otherwise("medium").alias("energy"),
        (F.col("p_partkey") % 2 == 0).alias("canonical"),
        F.when(size % 7 != 0, size % 7 + 1).alias("pmin"),
        F.when(size % 3 != 0, size % 7 + 6).alias("pmax"),
        F.concat(F.lit("about "), "p_name", F.lit(" by "), "p_brand").alias("summary"),
        kind.alias("kind"),
        F.col("p_partkey").cast("long").alias("ord"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    def of(kind: str, prefix: str, modulus: int, offset: int, where: str) -> DataFrame:
        k = (F.col("l_suppkey") % modulus).alias("k")
        rows = lines.where(where).select(F.col("l_partkey").alias("p"), k).distinct()
        return rows.select(F.lit(kind).alias("type"), F.concat(F.lit("e"), F.col("p").cast("string")).alias("src"), F.concat(F.lit(prefix), F.col("k").cast("string")).alias("dst"), F.lit(None).cast("double").alias("confidence"), (F.col("p") * 100 + offset + F.col("k")).alias("ord"))

    return of("hasMechanic", "m", 20, 0, "l_quantity > 45").unionByName(of("requires", "r", 5, 50, "l_quantity < 3"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = F.col("type") == "requires"
    ends = edges(spark, sf_dir).select(
        F.col("dst").alias("id"),
        F.when(required, "Requirement").otherwise("Mechanic").alias("type"),
        F.concat(F.when(required, "Need ").otherwise("Skillful "), "dst").alias("label"),
        (-F.substring("dst", 2, 20).cast("long")).alias("ord"),
    )
    return elements(spark, sf_dir).select("id", F.lit("Element").alias("type"), "label", "ord").unionByName(ends.distinct())


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with their mechanics' ids, and no skills or tags."""
    lists = edges(spark, sf_dir).where("type = 'hasMechanic'").groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_list("dst")).alias("mechanics"))
    none = F.array().cast("array<string>")
    return elements(spark, sf_dir).join(lists, "id", "left").withColumns({"mechanics": F.coalesce("mechanics", none), "skills": none, "tags": F.array("kind")})


def chain_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, confidence)``: neighbours in ``ord`` order among elements of one label and length, of different sources."""
    from pyspark.sql import Window

    w = Window.partitionBy("label", "minutes").orderBy("ord")
    rows = elements(spark, sf_dir).where("minutes IS NOT NULL").select("id", "source", "ord", F.lead("id").over(w).alias("dst"), F.lead("source").over(w).alias("other"))
    return rows.where("dst IS NOT NULL AND source <> other").select(F.col("id").alias("src"), "dst", (F.lit(0.5) + (F.col("ord") % 50) / 100).alias("confidence"))


CHAIN_SQL = """
chained AS (SELECT id, source, ord, lead(id) OVER w AS dst, lead(source) OVER w AS other FROM elements WHERE minutes IS NOT NULL WINDOW w AS (PARTITION BY label, minutes ORDER BY ord)),
links AS (SELECT id AS src, dst, 0.5::DOUBLE + (ord % 50) / 100::DOUBLE AS confidence FROM chained WHERE dst IS NOT NULL AND source <> other),
reach AS (SELECT src AS id, src AS other FROM links UNION SELECT dst, dst FROM links UNION SELECT reach.id, CASE WHEN l.src = reach.other THEN l.dst ELSE l.src END FROM reach JOIN links l ON l.src = reach.other OR l.dst = reach.other),
comps AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
"""


def equal_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``: links among all elements of one label and length and of different sources, enough to connect whom all of them connect.

    Of a class of one label and length each element is linked to the class's least
    (source, id), and those of that source to its greatest; with two sources or more
    that reaches the whole class, as do all its pairs, whose number is its square.
    """
    rows = elements(spark, sf_dir).where("label IS NOT NULL AND minutes IS NOT NULL AND source IS NOT NULL").select("id", "label", "minutes", F.struct("source", "id").alias("x"))
    ends = rows.groupBy("label", "minutes").agg(F.min("x").alias("first"), F.max("x").alias("last")).where("first.source <> last.source")
    return rows.join(ends, ["label", "minutes"]).select(F.col("id").alias("src"), F.when(F.col("x.source") == F.col("first.source"), F.col("last.id")).otherwise(F.col("first.id")).alias("dst"))


#: The components of all pairs of one label and length and of different sources, in both directions.
EQUAL_SQL = """
links AS (SELECT x.id AS src, y.id AS dst FROM elements x JOIN elements y ON x.label = y.label AND x.minutes = y.minutes AND x.source <> y.source),
reach AS (SELECT src AS id, src AS other FROM links UNION SELECT reach.id, l.dst FROM reach JOIN links l ON l.src = reach.other),
comps AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
"""


#: The rule terms that two mechanics stand for, so that requirements follow from them.
NAMED_MECHANICS = {"m1": "Audience Voting", "m2": "human props"}


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements as the flat rows of the graph's derivation, matched along ``chain_links``."""
    related = chain_links(spark, sf_dir).groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col("dst").alias("identifier"), "confidence"))).alias("related"))
    none, nothing = F.lit(None).cast("int"), F.array().cast("array<string>")
    return labelled(spark, sf_dir).join(related, "id", "left").select(
        "id", "label", "source", F.concat(F.lit("http://x/"), "id").alias("url"), "lang", F.concat("summary", F.lit(", described")).alias("description"), "summary",
        F.array().cast("array<struct<action:string,role:string,constraint:string>>").alias("steps"), "mechanics", nothing.alias("skills"), "tags", "difficulty", "minutes", "energy",
        none.alias("gmin"), none.alias("gmax"), "pmin", "pmax", F.lit(None).cast("string").alias("link_en"), F.lit(None).cast("string").alias("link_de"), F.md5("label").alias("content_hash"),
        F.array().cast("array<struct<name:string,description:string,parentIdentifier:string>>").alias("derivedElements"), "related", "ord",
    )


def vocabulary(spark: SparkSession) -> DataFrame:
    rows = [("mechanics", canonical, [term], None, k) for k, (term, canonical) in enumerate(NAMED_MECHANICS.items())]
    return spark.createDataFrame(rows, "kind string, canonical string, variants array<string>, parent string, ord long")


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements in the nested form that extraction writes."""
    from .. import schema

    e = flat(spark, sf_dir)
    terms = lambda c: F.transform(c, lambda t: F.struct(t.alias("name"), F.lit(None).cast("string").alias("originalName"), F.lit(None).cast("string").alias("category")))
    practical = F.struct(F.col("difficulty"), F.col("minutes").alias("typicalDurationMinutes"), F.col("energy").alias("energyLevel"))
    body = F.to_json(F.struct("summary", "description", terms("mechanics").alias("mechanics"), terms("skills").alias("skills"), practical.alias("practical"), F.col("content_hash").alias("contentHash")))
    kind = schema.ELEMENT["normalized"].dataType
    by_name = {
        "identifier": F.md5("id"), "name": F.col("label"), "url": F.col("url"), "sourceName": F.col("source"), "languageCode": F.col("lang"), "tags": F.col("tags"), "playerCountMin": F.col("pmin"), "playerCountMax": F.col("pmax"),
        "normalized": F.from_json(body, kind), "ord": F.col("ord"), "derivedElements": F.col("derivedElements"),
    }
    return e.select(*(by_name.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.ELEMENT.fields))
