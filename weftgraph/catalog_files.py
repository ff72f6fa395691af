"""Registered queries of sources, sinks, corpus assembly and extraction: what is written and read back, checked and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import schema
from .catalog import clean_sql
from .operators import assemble, extract, graph, match, review
from .plans import domain as D
from .plans.lineage import new_path
from .registry import plain, read, registered
from .sources import readers, writers
from .streaming.incremental import upsert_stream

# ---- round trips ----------------------------------------------------------


def _corpus(spark, sf):
    d = read(spark, sf, "documents")
    return d.select(F.md5(F.col("doc_id").cast("string")).alias("identifier"), F.concat(F.lit("https://x/"), "doc_id").alias("url"), F.when(F.col("lang") == "de", "de").otherwise("en").alias("languageCode"), F.substring("text", 1, 10_000).alias("markdown"), F.array("source").alias("tagIds"), F.lit("CC-BY-SA-4.0").alias("licenseSpdxIdentifier"))


@plain("SELECT md5(CAST(doc_id AS VARCHAR)) AS identifier, 'https://x/' || doc_id AS url, CAST(length(substring(text, 1, 10000)) AS BIGINT) AS n FROM documents WHERE length(text) >= 10")
def corpus_round_trip(spark, sf):
    """Corpus rows that keep the constraints, written and read by the validating reader."""
    path = new_path(spark, "corpus")
    writers.write_corpus(_corpus(spark, sf).where("length(markdown) >= 10"), path)
    return readers.read_corpus(spark, path).select("identifier", "url", F.length("markdown").cast("long").alias("n"))


@plain("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'identifier|' ELSE '' END || CASE WHEN lang NOT IN ('de', 'en') THEN 'languageCode|' ELSE '' END || CASE WHEN coalesce(length(text), 0) NOT BETWEEN 10 AND 10000 THEN 'markdown|' ELSE '' END AS broken FROM documents WHERE doc_id % 3 = 0 OR lang NOT IN ('de', 'en') OR coalesce(length(text), 0) NOT BETWEEN 10 AND 10000")
def corpus_checks(spark, sf):
    """Which constraints each document would break as a corpus row."""
    d = read(spark, sf, "documents").select(F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).otherwise(F.lpad(F.col("doc_id").cast("string"), 32, "0")).alias("identifier"), F.lit("https://x/y").alias("url"), F.col("lang").alias("languageCode"), F.col("text").alias("markdown"), F.array("source").alias("tagIds"), F.lit("GFDL-1.2").alias("licenseSpdxIdentifier"))
    return schema.corpus_violations(d).select(F.col("identifier").cast("long").alias("doc_id"), F.concat(F.array_join("broken", "|"), F.lit("|")).alias("broken"))


@registered("SELECT md5(id) AS identifier, CASE WHEN length('about ' || label || ' by ' || source) < 10 THEN 'summary|' ELSE '' END || 'typicalDurationMinutes' AS broken FROM elements WHERE minutes = 1")
def element_checks(spark, sf):
    """Elements that break a constraint: here a duration of zero, put in place of a minute."""
    p = "normalized.practical"
    rows = D.normalized(spark, sf)
    least = F.when(F.col(f"{p}.typicalDurationMinutes") == 1, 0).otherwise(F.col(f"{p}.typicalDurationMinutes"))
    changed = F.col("normalized").withField("practical.typicalDurationMinutes", least)
    return schema.violations(rows.withColumn("normalized", changed)).select("identifier", F.array_join("broken", "|").alias("broken"))


def _raw_lines(spark, sf) -> str:
    d = read(spark, sf, "documents")
    fields = F.struct(F.concat(F.lit("u"), F.col("doc_id") % 100).alias("url"), F.col("doc_id").cast("string").alias("identifier"), F.col("lang").alias("languageCode"), F.array("source").alias("tags"), F.substring("text", 1, 50).alias("markdown"), F.col("n_chars").cast("string").alias("card_Length"))
    path = new_path(spark, "raw")
    d.select(F.to_json(fields).alias("value")).repartitionByRange(4, "value").write.text(path)
    return path


@plain("SELECT CAST(doc_id AS VARCHAR) AS identifier, 'u' || doc_id % 100 AS url, source AS tags, substring(text, 1, 50) AS markdown, CAST(n_chars AS VARCHAR) AS length FROM documents")
def raw_scan(spark, sf):
    """Raw records as JSON lines, with an open key."""
    rows = readers.read_raw(spark, _raw_lines(spark, sf))
    return rows.select("identifier", "url", F.array_join("tags", "|").alias("tags"), "markdown", F.col("card")["card_Length"].alias("length"))


@plain("SELECT DISTINCT 'u' || doc_id % 100 AS url, true AS one FROM documents")
def raw_by_url(spark, sf):
    rows = readers.read_raw_by_url(spark, _raw_lines(spark, sf))
    return rows.groupBy("url").agg((F.count("*") == 1).alias("one"))


@plain("SELECT CAST(doc_id AS VARCHAR) AS identifier, source AS \"sourceName\" FROM documents")
def raw_write(spark, sf):
    """Raw records written in order of their identifiers, their HTML by source."""
    d = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("identifier"), F.col("source").alias("sourceName"), F.col("text").alias("htmlContent"))
    path, html = new_path(spark, "raw"), new_path(spark, "html")
    writers.write_raw(d, path, html)
    return spark.read.parquet(path).join(spark.read.parquet(html).select("identifier"), "identifier").select("identifier", "sourceName")


@registered("SELECT md5(id) AS identifier, label AS name, lang AS \"languageCode\", minutes, coalesce((SELECT string_agg(dst, '|' ORDER BY dst) FROM edges WHERE src = elements.id AND type = 'hasMechanic'), '') AS mechanics FROM elements")
def normalized_round_trip(spark, sf):
    """Two sources written and scanned one after the other."""
    rows = D.normalized(spark, sf)
    paths = []
    for k in (0, 1):
        paths.append(new_path(spark, "normalized"))
        writers.write_normalized(rows.where(F.col("ord") % 2 == k), paths[-1])
    found = readers.read_all_normalized(spark, paths)
    names = F.array_join(F.transform("normalized.mechanics", lambda m: m["name"]), "|")
    return found.select("identifier", "name", "languageCode", F.col("normalized.practical.typicalDurationMinutes").alias("minutes"), names.alias("mechanics"))


@registered("SELECT md5(id) AS identifier FROM elements WHERE ord % 5 <> 0")
def previous_normalized(spark, sf):
    """Earlier output by identifier; a missing file adds nothing."""
    rows = D.normalized(spark, sf).where(F.col("ord") % 5 != 0)
    path = new_path(spark, "normalized")
    writers.write_normalized(rows.unionByName(rows.withColumn("ord", F.col("ord") + 1_000_000)), path)
    return readers.read_previous_normalized(spark, path).unionByName(readers.read_previous_normalized(spark, path + "-none")).select("identifier")


@registered("SELECT type, count(*) AS n, 'nodes' AS kind FROM nodes GROUP BY type UNION ALL SELECT type, count(*), 'edges' FROM edges GROUP BY type")
def graph_round_trip(spark, sf):
    """A written graph's summary."""
    nodes, edges = D.nodes(spark, sf), D.edges(spark, sf)
    return writers.write_graph(nodes, edges, graph.graph_meta(nodes, edges), new_path(spark, "graph")).select("type", "n", "kind")


@registered("SELECT e.src, n.label FROM edges e JOIN nodes n ON n.id = e.dst WHERE e.type = 'requires'")
def graph_scan(spark, sf):
    folder = new_path(spark, "graph")
    nodes, edges = D.nodes(spark, sf), D.edges(spark, sf)
    writers.write_graph(nodes, edges, graph.graph_meta(nodes, edges), folder)
    nodes, edges = readers.read_graph(spark, folder)
    return edges.where("type = 'requires'").join(nodes.select(F.col("id").alias("dst"), "label"), "dst").select("src", "label")


def _override_rows(spark, sf):
    rows = D.chain_links(spark, sf).select(F.lit("reject_match").alias("type"), F.col("src").alias("elementA"), F.col("dst").alias("elementB"), F.substring("src", 2, 20).cast("long").alias("ord"))
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.OVERRIDE.fields))


@registered("," + D.CHAIN_SQL + 'SELECT CAST(row_number() OVER (ORDER BY CAST(substring(src, 2) AS BIGINT)) - 1 AS BIGINT) AS ord, src AS "elementA", dst AS "elementB" FROM links')
def override_round_trip(spark, sf):
    path = new_path(spark, "overrides") + ".json"
    writers.write_overrides(_override_rows(spark, sf), path)
    return readers.read_overrides(spark, path).select("ord", "elementA", "elementB")


@registered("," + D.CHAIN_SQL + ', p AS (SELECT src, dst FROM links) SELECT src AS "elementA", dst AS "elementB", \'reject_match\' AS type FROM p UNION ALL SELECT \'zz\', \'yy\', \'add_match\'')
def override_append(spark, sf):
    """Overrides with new ones appended: those that stand there already are not repeated."""
    rows = _override_rows(spark, sf)
    more = spark.createDataFrame([(0, "zz", "yy")], "ord long, elementA string, elementB string").withColumn("type", F.lit("add_match"))
    new = more.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in more.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.OVERRIDE.fields))
    return review.add_override(rows, rows.unionByName(new)).select("elementA", "elementB", "type")


@registered("SELECT kind, count(*) AS n, min(ord) AS ord FROM elements GROUP BY kind")
def vocabulary_round_trip(spark, sf):
    """Clusters of labels by kind, written and read."""
    rows = D.elements(spark, sf).groupBy("kind").agg(F.array_sort(F.collect_list("id")).alias("variants"), F.min("ord").alias("ord")).select(F.lit("mechanics").alias("kind"), F.col("kind").alias("canonical"), "variants", F.lit(None).cast("string").alias("parent"), "ord")
    path = new_path(spark, "vocabulary")
    writers.write_vocabulary(rows, path)
    return readers.read_vocabulary(spark, path).select(F.col("canonical").alias("kind"), F.size("variants").cast("long").alias("n"), "ord")


@registered("SELECT lower(canonical) AS term_lc, canonical FROM (VALUES ('Fastener'), ('Cool')) v(canonical) UNION ALL SELECT * FROM (VALUES ('bolt', 'Fastener'), ('nail', 'Fastener'), ('cold', 'Cool')) w")
def thesaurus_scan(spark, sf):
    path = new_path(spark, "thesaurus") + ".json"
    spark.range(1).select(F.lit('{"sameAs":[{"canonical":"Fastener","variants":["Bolt","nail"]},{"canonical":"Old","variants":["cold"]},{"canonical":"Cool","variants":["COLD"]}]}').alias("value")).coalesce(1).write.text(path)
    return readers.read_thesaurus(spark, path).where("canonical <> 'Old'")


@registered("SELECT source AS stage, CASE WHEN count(*) % 2 = 0 THEN 'new' ELSE 'old' END AS hash FROM elements GROUP BY source")
def state_merge(spark, sf):
    """Run state written, merged with that of a later run, and written again."""
    stages = D.elements(spark, sf).groupBy(F.col("source").alias("stage")).agg(F.count("*").alias("n"))
    path = new_path(spark, "state")
    writers.write_state(stages.select("stage", F.lit("old").alias("hash")), path)
    merged = writers.merge_state(readers.read_state(spark, path), stages.where("n % 2 = 0").select("stage", F.lit("new").alias("hash")))
    again = new_path(spark, "state")
    writers.write_state(merged, again)
    return readers.read_state(spark, again).unionByName(readers.read_state(spark, again + "-none"))


@registered("SELECT to_json({id: id, label: label, canonical: canonical, ord: ord})::VARCHAR AS json FROM elements")
def json_dump(spark, sf):
    return writers.as_json_rows(D.elements(spark, sf).select("id", "label", "canonical", "ord"))


@plain("WITH p AS (SELECT url, page_id, '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS lastmod FROM pages) SELECT url AS loc, arg_min(lastmod, page_id) AS lastmod FROM p GROUP BY url UNION ALL SELECT 'https://x/a?b=1&c=<2>', NULL")
def sitemap_urls(spark, sf):
    """Locations of one site map for each page: the last of a text, the first between texts."""
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    xml = F.concat(F.lit("<urlset><url><loc> "), escaped, F.lit(" </loc><lastmod>1999</lastmod></url><url><loc></loc></url><url>\n<loc>"), escaped, F.lit("</loc><lastmod>2024-01-"), day, F.lit("</lastmod></url></urlset>"))
    odd = spark.createDataFrame([(10_000_000, "<sitemapindex><sitemap><loc><![CDATA[https://x/a?b=1&c=<2>]]></loc></sitemap></sitemapindex>")], "ord long, xml string")
    return readers.parse_sitemaps(read(spark, sf, "pages").select(F.col("page_id").alias("ord"), xml.alias("xml")).unionByName(odd))


# ---- assembly -------------------------------------------------------------


@plain("SELECT DISTINCT lang AS tag FROM documents WHERE lang NOT IN ('de', 'fr') AND lang IS NOT NULL")
def untranslated_tags(spark, sf):
    names = spark.createDataFrame([("german", "Deutsch", "DE", 0), ("french", "Fr", "French", 1)], "tag_id string, de string, en string, dict_ord int")
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("identifier"), F.array("lang").alias("tags"))
    return assemble.untranslated_tags(assemble.tag_ids(d, names))


@plain(f"""WITH r AS (SELECT doc_id, {clean_sql('text')} AS md, lang FROM documents) SELECT doc_id, CAST(length(substring(md, 1, 10000)) AS BIGINT) AS n, CASE lang WHEN 'fr' THEN 'french' ELSE 'no_translation_id_' || lang END || '|extra' AS ids FROM r WHERE length(md) >= 10 AND lang IS NOT NULL""")
def assemble_corpus(spark, sf):
    """Two raw sources to corpus rows: merged by identifier, cleaned, tags translated, filtered, cut."""
    names = spark.createDataFrame([("french", "Fr", "French", 0), ("extra", "Extra", "Extra", 1)], "tag_id string, de string, en string, dict_ord int")
    d = read(spark, sf, "documents").where("lang IS NOT NULL").select(F.col("doc_id").cast("string").alias("identifier"), F.lit("en").alias("languageCode"), F.array("lang").alias("tags"), F.col("text").alias("markdown"), F.col("doc_id").alias("ord"))
    more = d.withColumns({"tags": F.array(F.lit("Extra")), "markdown": F.lit(None).cast("string")})
    found = assemble.assemble([d, more], {"fr": ["French"]}, names)
    return found.select(F.col("identifier").cast("long").alias("doc_id"), F.length("markdown").cast("long").alias("n"), F.array_join("tagIds", "|").alias("ids"))


@plain("SELECT 'card_k' AS key, props->>'$.k' AS value, count(*) AS n FROM events WHERE props->>'$.k' IS NOT NULL GROUP BY 2 UNION ALL SELECT 'card_type', event_type, count(*) FROM events GROUP BY event_type")
def card_histogram(spark, sf):
    card = F.map_filter(F.create_map(F.lit("card_k"), F.get_json_object("props", "$.k"), F.lit("card_type"), F.col("event_type")), lambda _, v: v.isNotNull())
    return assemble.card_histogram(read(spark, sf, "events").select(card.alias("card")))


@plain("SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def not_yet_present(spark, sf):
    p = read(spark, sf, "pages").select("url", "page_id")
    return assemble.not_yet_present(p.select("url").distinct(), p.where("page_id % 3 = 0"))


@plain("SELECT source AS listing, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 3")
def cap_per_listing(spark, sf):
    d = read(spark, sf, "documents").select(F.col("source").alias("listing"), F.col("doc_id").alias("ord"))
    return assemble.cap_per_listing(d, 3).select("listing", F.col("ord").alias("doc_id"))


@plain("SELECT source, 'lang' AS field FROM documents GROUP BY source HAVING min(lang) <> max(lang) UNION ALL SELECT source, 'n_chars' FROM documents GROUP BY source HAVING min(n_chars) <> max(n_chars)")
def merge_conflicts(spark, sf):
    return assemble.merge_conflicts(read(spark, sf, "documents").select("source", "lang", "n_chars"), "source")


@registered(
    """, RECURSIVE_PAGES AS (SELECT ord, ord * 3 + 1 AS to_en, ord + (SELECT count(*) FROM elements) // 2 AS to_de FROM elements),
    reached AS (SELECT ord FROM elements WHERE ord < 3 UNION SELECT t.ord FROM reached r JOIN RECURSIVE_PAGES p ON p.ord = r.ord JOIN elements t ON t.ord = p.to_en OR t.ord = p.to_de)
    SELECT 'e' || r.ord AS identifier, CASE WHEN p.to_en IN (SELECT ord FROM reached) THEN 'e' || p.to_en END AS en, CASE WHEN p.to_de IN (SELECT ord FROM reached) THEN 'e' || p.to_de END AS de FROM reached r JOIN RECURSIVE_PAGES p USING (ord)"""
)
def followed_translations(spark, sf):
    """Three pages and whatever their translation links lead to."""
    e = D.elements(spark, sf)
    n = e.count()
    pages = e.select(F.concat(F.lit("u"), "ord").alias("url"), F.col("id").alias("identifier"), F.concat(F.lit("u"), F.col("ord") * 3 + 1).alias("translationLinkEn"), F.concat(F.lit("u"), F.col("ord") + n // 2).alias("translationLinkDe"), "ord")
    found = assemble.follow_translations(pages.where("ord < 3"), pages)
    return found.select("identifier", F.col("translationLinkEnIdentifier").alias("en"), F.col("translationLinkDeIdentifier").alias("de"))


@registered("SELECT e.id, coalesce(e.minutes, l.minutes) AS minutes, coalesce(e.difficulty, l.difficulty) AS difficulty FROM elements e LEFT JOIN elements l ON l.ord = e.ord + 1")
def merged_translation_fields(spark, sf):
    link = F.concat(F.lit("e"), F.col("ord") + 1)
    rows = D.elements(spark, sf).select(F.col("id").alias("identifier"), "minutes", "difficulty", F.lit(None).cast("string").alias("translationLinkDeIdentifier"), link.alias("translationLinkEnIdentifier"))
    return assemble.merge_translation_fields(rows, ["minutes", "difficulty"]).select(F.col("identifier").alias("id"), "minutes", "difficulty")


# ---- extraction -----------------------------------------------------------


def _to_extract(spark, sf):
    rows = D.elements(spark, sf).select(F.col("id").alias("identifier"), F.col("label").alias("name"), F.concat(F.lit("http://x/"), "id").alias("url"), F.col("source").alias("sourceName"), F.col("lang").alias("languageCode"), F.array("kind").alias("tags"), F.concat(F.lit("<p>"), "summary", F.lit("\n<b>now</b></p>")).alias("htmlContent"), "ord")
    return rows.withColumn("contentHash", extract.content_hash(F.col("name"), F.col("htmlContent"), F.col("tags")))


def _previous(rows):
    old = rows.where("ord % 4 <> 0").withColumn("schemaHash", schema.schema_version())
    return old.withColumn("contentHash", F.when(F.col("ord") % 4 == 1, "stale").otherwise(F.col("contentHash")))


@registered("SELECT id AS identifier, CASE WHEN ord % 4 > 1 THEN 'kept' ELSE 'to do' END AS state FROM elements")
def extraction_cache(spark, sf):
    rows = _to_extract(spark, sf)
    kept, todo = extract.split_by_cache(rows, _previous(rows))
    return kept.select("identifier", F.lit("kept").alias("state")).unionByName(todo.select("identifier", F.lit("to do").alias("state")))


@registered("SELECT id AS identifier, label AS name, label AS summary, summary || ' now' AS description, 'stub' AS model, kind AS tags FROM elements WHERE ord % 4 <= 1")
def extraction_stage(spark, sf):
    """What is new or changed goes through the stand-in model and is merged with its raw record."""
    rows = _to_extract(spark, sf)
    _, built, _ = extract.run_stage(rows, _previous(rows), extract.stub_extractor, "stub", "2024-01-01T00:00:00Z")
    return built.select("identifier", "name", "normalized.summary", "normalized.description", F.col("normalized.normalizedBy").alias("model"), F.array_join("tags", "|").alias("tags"))


@registered("SELECT id AS identifier, label AS name, 'no answer' AS reason FROM elements WHERE ord % 3 = 0")
def dropped_records(spark, sf):
    rows = _to_extract(spark, sf)
    answers = rows.select("identifier", F.when(F.col("ord") % 3 == 0, "sorry, nothing").otherwise('{"name":"x"}').alias("response"))
    path = new_path(spark, "errors")
    writers.write_errors(extract.dropped_records(rows, extract.parse_responses(answers)), path)
    return spark.read.schema("identifier string, name string, reason string").json(path)


@registered("SELECT id, 0 AS part, label AS name, summary, kind AS mechanic, minutes, 'general' AS tip FROM elements UNION ALL SELECT id, 1, 'child of ' || label, '', NULL, NULL, NULL FROM elements WHERE ord % 2 = 0")
def coerced_responses(spark, sf):
    """Answers with plain strings for objects; every second answer is an array of two."""
    answer = F.to_json(F.struct(F.col("label").alias("name"), F.col("summary").alias("description"), F.array("kind").alias("mechanics"), F.array(F.lit("a tip")).alias("tips"), F.struct(F.col("minutes").alias("typicalDurationMinutes")).alias("practical")))
    child = F.to_json(F.struct(F.concat(F.lit("child of "), "label").alias("name")))
    said = F.when(F.col("ord") % 2 == 0, F.concat(F.lit("["), answer, F.lit(","), child, F.lit("]"))).otherwise(answer)
    found = extract.coerce(extract.parse_responses(D.elements(spark, sf).select("id", said.alias("response"))))
    n = "normalized"
    return found.select("id", F.col("part").cast("int").alias("part"), "name", f"{n}.summary", F.get(F.col(f"{n}.mechanics"), F.lit(0))["name"].alias("mechanic"), F.col(f"{n}.practical.typicalDurationMinutes").alias("minutes"), F.get(F.col(f"{n}.tips"), F.lit(0))["category"].alias("tip"))


@registered("SELECT id AS a, 'x' || id AS b, CASE WHEN ord % 2 = 0 THEN 0.9 ELSE 0.5 END AS confidence FROM elements")
def match_responses(spark, sf):
    """Index pairs of a matcher's answers; an index out of range is passed over."""
    told = F.when(F.col("ord") % 2 == 0, '{"a":0,"b":1,"confidence":0.9}').otherwise('{"a":0,"b":1}')
    said = F.concat(F.lit("```json\n["), told, F.lit(',{"a":0,"b":7}]\n```'))
    rows = D.elements(spark, sf).select(F.array("id", F.concat(F.lit("x"), "id")).alias("ids"), said.alias("response"))
    return extract.parse_match_response(rows)


@plain("SELECT doc_id, md5(coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE '' END) AS hash, doc_id % 3 = 0 AS again FROM documents UNION ALL SELECT doc_id, md5(coalesce(text, '')), false FROM documents WHERE doc_id % 3 = 0")
def upsert_documents(spark, sf):
    """Two batches of a stream: the second changes every third document and repeats the rest."""
    d = read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    source, folder, state = new_path(spark, "stream"), new_path(spark, "upserts"), new_path(spark, "stream-state")
    for number in (0, 1):
        changed = F.when((F.lit(number) == 1) & (F.col("doc_id") % 3 == 0), F.concat("text", F.lit("x"))).otherwise(F.col("text"))
        batch = d.select("doc_id", F.md5(changed).alias("hash"), F.lit(number).alias("ord"))
        batch.unionByName(batch.withColumns({"hash": F.lit("early"), "ord": F.col("ord") - 1})).write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        upsert_stream(stream, folder, "doc_id", "hash", lambda rows: rows, state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("doc_id", "hash", (F.col("batch") == 1).alias("again"))


@registered(", b AS (SELECT source, count(*) AS n, string_agg(id, ',' ORDER BY ord) AS ids FROM elements GROUP BY source) SELECT source, n, ids FROM b")
def matcher_blocks(spark, sf):
    """What a block matcher is shown, with blocks large enough for a source each."""
    found = match.blocks_of(D.elements(spark, sf), 1_000_000)
    return found.select("source", F.size("names").cast("long").alias("n"), F.array_join(F.transform("names", lambda x: x["id"]), ",").alias("ids"))
