"""Registered queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text as X
from .plans import domain as D
from .registry import plain, read, registered
from .sources import html_pages

_COLLAPSED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'), ' ')"


@registered(", n AS (SELECT id, 'The ' || label || ' (' || kind || ')  X' AS name FROM elements) SELECT id, " + _COLLAPSED.format(r"regexp_replace(regexp_replace(lower(name), '\s*\([^)]*\)\s*', ' ', 'g'), '^the\s+', '')") + " AS name, array_to_string(list_filter(regexp_split_to_array(lower(name), '[\\s\\-—–,.;:!?()]+'), lambda w: length(w) > 0), '|') AS tokens FROM n")
def normalize_names(spark, sf):
    name = F.concat(F.lit("The "), "label", F.lit(" ("), "kind", F.lit(")  X"))
    return D.elements(spark, sf).select("id", X.normalize_name(name).alias("name"), F.array_join(X.name_tokens(name), "|").alias("tokens"))


_TERM_NORM = _COLLAPSED.format("regexp_replace(regexp_replace(lower(term), '[-/]', ' ', 'g'), '[^a-z0-9 äöüß]', '', 'g')")


@registered(
    f", t AS (SELECT id, label || '/' || kind || '-Übung! constraint' AS term FROM elements), n AS (SELECT id, term, {_TERM_NORM} AS norm FROM t)"
    " SELECT id, norm, array_to_string(list_sort(list_distinct(list_filter(string_split(norm, ' '), lambda w: w <> 'constraint' AND w <> ''))), '|') AS mechanics, array_to_string(list_sort(list_distinct(string_split(norm, ' '))), '|') AS skills, NOT regexp_matches(lower(term), '[äöüß]') AS english FROM n"
)
def normalize_terms(spark, sf):
    term = F.concat("label", F.lit("/"), "kind", F.lit("-Übung! constraint"))
    words = lambda mechanics: F.array_join(F.array_sort(X.term_tokens(term, mechanics)), "|")
    return D.elements(spark, sf).select("id", X.normalize_term(term).alias("norm"), words(True).alias("mechanics"), words(False).alias("skills"), X.is_english(term).alias("english"))


@plain("SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS html FROM documents")
def escape_html(spark, sf):
    return read(spark, sf, "documents").select("doc_id", X.escape_html(F.col("text")).alias("html"))


@registered("SELECT id, label || ' ' || kind AS title, kind || '|' || label AS tags FROM elements")
def titles_and_tags(spark, sf):
    title = F.concat(F.lit("# "), "label", F.lit(" "), "kind", F.lit(" #"))
    tags = F.concat(F.lit(" "), "kind", F.lit(" ,, "), "label", F.lit(", "))
    return D.elements(spark, sf).select("id", X.clean_title(title).alias("title"), F.array_join(X.split_tags(tags), "|").alias("tags"))


@registered("SELECT id, CASE WHEN pmin IS NOT NULL AND pmax IS NOT NULL THEN pmin END AS low, CASE WHEN pmin IS NOT NULL AND pmax IS NOT NULL THEN pmax END AS high FROM elements")
def player_ranges(spark, sf):
    said = F.coalesce(F.concat(F.lit("for "), "pmin", F.when(F.col("ord") % 2 == 0, " to ").otherwise(" bis "), "pmax", F.lit(" players")), F.lit("many players"))
    return D.elements(spark, sf).withColumn("r", X.player_range(said)).select("id", F.col("r.min").alias("low"), F.col("r.max").alias("high"))


@plain("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:00.000Z') AS modified, strftime(ts, '%d.%m.%Y') AS updated, event_id % 2 = 0 AS known FROM events")
def page_dates(spark, sf):
    said = F.concat(F.lit("This page was last modified on "), F.date_format("ts", "d MMMM yyyy"), F.lit(", at "), F.date_format("ts", "HH:mm"), F.lit("."))
    edited = F.concat(F.lit("Last edited "), F.date_format("ts", "dd.MM.yyyy"), F.lit(" by someone"))
    odd = F.col("event_id") % 2 == 0
    return read(spark, sf, "events").select("event_id", X.wiki_modified(said).alias("modified"), X.last_update(edited).alias("updated"), X.last_update(F.when(odd, edited).otherwise("never")).isNotNull().alias("known"))


@registered("SELECT id, CASE WHEN s >= 0.95 THEN '>=0.95' WHEN s >= 0.85 THEN '>=0.85' WHEN s >= 0.75 THEN '>=0.75' ELSE '<0.75' END AS band, floor(s * 10 + 0.5) / 10 AS rounded FROM (SELECT id, (ord % 100) / 100::DOUBLE AS s FROM elements)")
def confidence_bands(spark, sf):
    s = (F.col("ord") % 100) / 100
    return D.elements(spark, sf).select("id", X.confidence_band(s).alias("band"), X.round_half_up(s, 1).alias("rounded"))


@registered("SELECT id, CASE difficulty WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 ELSE 0 END AS level, CASE energy WHEN 'high' THEN 0 WHEN 'low' THEN 2 ELSE 1 END AS energy_rank FROM elements")
def enum_ranks(spark, sf):
    return D.elements(spark, sf).select("id", X.difficulty_rank(F.col("difficulty")).alias("level"), X.energy_rank(F.col("energy")).alias("energy_rank"))


@registered(", w AS (SELECT id, list_distinct(string_split(lower(label), ' ')) AS a, list_distinct(string_split(lower(kind || ' ' || label), ' ')) AS b FROM elements) SELECT id, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE > 0.7 AS shares FROM w")
def shared_words(spark, sf):
    return D.elements(spark, sf).select("id", X.shares_words(F.col("label"), F.concat("kind", F.lit(" "), "label"), 0.7).alias("shares"))


@registered("SELECT id, '## ' || label || chr(10) || chr(10) || 'a **' || kind || '** [here](/x) _' || source || '_' || chr(10) || chr(10) || '*   ' || lang || chr(10) || '*   `' || id || '`' AS md FROM elements")
def html_to_markdown(spark, sf):
    html = F.concat(F.lit("<h2> "), "label", F.lit("</h2>\n<p>a <strong>"), "kind", F.lit('</strong> <a href="/x">here</a>  <em>'), "source", F.lit("</em></p><ul><li>"), "lang", F.lit("</li><li><code>"), "id", F.lit("</code></li></ul><script>no</script>"))
    return html_pages.add_markdown(D.elements(spark, sf).select("id", html.alias("html")), "html", "md").select("id", "md")


@plain(
    """WITH l AS (SELECT url AS listing, regexp_extract(url, '^https?://[^/]+') AS site, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages)
    SELECT listing, CAST(i - 1 AS BIGINT) AS ord, site || hrefs[i] AS link FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM l)"""
)
def absolute_links(spark, sf):
    layout = html_pages.Layout("list", "h1", "article", "nav ul li a")
    return html_pages.listing_links(read(spark, sf, "pages"), layout)


_TITLE = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"
for _named, _plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _TITLE = f"replace({_TITLE}, '{_named}', '{_plain}')"


@plain(
    f"""WITH p AS (SELECT url, trim(regexp_replace({_TITLE}, '#', '', 'g')) AS name, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a href="[^"]*">([^<]*)</a>', 1) AS c FROM pages WHERE contains(html, '<h1>'))
    SELECT md5('element;' || name || ';' || url) AS identifier, url, name, len(c) AS n_categories, 'scraped' AS tags FROM p WHERE name <> ''"""
)
def html_extract(spark, sf):
    """The fields of every page that has a title."""
    layout = html_pages.Layout("pages", "h1", "article", "nav ul li a", categories="nav ul li a")
    found = html_pages.extract_pages(read(spark, sf, "pages"), layout, ("scraped",))
    return found.select("identifier", "url", "name", F.size("categories").cast("long").alias("n_categories"), F.array_join("tags", "|").alias("tags"))
