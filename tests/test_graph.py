"""The graph engine on small hand-made catalogues."""

import json

import pytest
from pyspark.sql import functions as F

from weftgraph import schema
from weftgraph.functions import text as X
from weftgraph.operators import assemble, clusters, extract, graph, match, planner, query, review, search, vocabulary
from weftgraph.operators.components import connected_components
from weftgraph.plans.lineage import new_path
from weftgraph.sources import html_pages, readers, writers

FLAT = "id string, label string, source string, url string, lang string, description string, summary string, steps array<struct<action:string,role:string,constraint:string>>, mechanics array<string>, skills array<string>, tags array<string>, difficulty string, minutes int, energy string, gmin int, gmax int, pmin int, pmax int, link_en string, link_de string, content_hash string, derivedElements array<struct<name:string,description:string,parentIdentifier:string>>, related array<struct<identifier:string,confidence:double>>, ord long"


def flat(id, label, source="a", lang="en", **more):
    row = {"url": f"http://x/{id}", "description": "A longer description.", "summary": "A summary.", "steps": [], "mechanics": [], "skills": [], "tags": ["game"], "derivedElements": [], "related": []} | more
    names = [x.strip().split(" ")[0] for x in FLAT.replace("array<struct<action:string,role:string,constraint:string>>", "x").replace("array<struct<name:string,description:string,parentIdentifier:string>>", "x").replace("array<struct<identifier:string,confidence:double>>", "x").split(",")]
    row |= {"id": id, "label": label, "source": source, "lang": lang, "ord": int(id[1:])}
    return tuple(row.get(n) for n in names)


def catalogue(spark, *rows):
    return spark.createDataFrame(list(rows), FLAT)


def vocab(spark, *rows):
    return spark.createDataFrame(list(rows), "kind string, canonical string, variants array<string>, parent string, ord long")


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


# ---- text


def test_text_functions(spark):
    df = spark.range(1)
    lit = F.lit
    assert one(df, X.normalize_name(lit("The Freeze (Tag)  Game"))) == "freeze game"
    assert one(df, X.normalize_term(lit("Yes-And/Übung!"))) == "yes and übung"
    assert one(df, X.name_tokens(lit("Yes, let's — go!"))) == ["yes", "let's", "go"]
    assert one(df, X.levenshtein_ratio(lit(""), lit(""))) == 1.0
    assert one(df, X.levenshtein_ratio(lit("abcd"), lit("abce"))) == 0.75
    assert one(df, X.player_range(lit("4 bis 12 Spieler"))).asDict() == {"min": 4, "max": 12}
    assert one(df, X.player_range(lit("many"))).asDict() == {"min": None, "max": None}
    assert one(df, X.wiki_modified(lit("This page was last modified on 5 March 2012, at 17:40."))) == "2012-03-05T17:40:00.000Z"
    assert one(df, X.whole_word(lit("Eyes Closed"), "yes")) is False
    assert one(df, X.whole_word(lit("Yes, let's"), "yes")) is True
    assert one(df, X.whole_word(lit("ÜBUNG"), "bung")) is True
    assert one(df, X.round_half_up(lit(1.005), 2)) == 1.0
    assert one(df, X.escape_html(lit("<a> & 'b'"))) == "&lt;a&gt; &amp; &#39;b&#39;"
    assert one(df, X.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0.0


def test_clean_markdown(spark):
    before = "Hello <!-- comment -->World\n[edit](some/link/edit)\n\nHello World\n## Filmbeispiel\nSome content\n## Another Section\nSome content\n_Siehe auch_ some link\nBefore Link (_siehe auch some link_)\n## Siehe auch\nSome content\n## Keep after Siehe Auch\n## Inhaltsverzeichnis\nInhaltsverzeichnis Content\n## Table of Contents\nToC Content\n## Another Section\n## Verwandt\nSome content\n## Another Section\n[Link Text](some/link)"
    after = "Hello World\nHello World\n## Another Section\nSome content\n\nBefore Link (_siehe auch some link_)\n## Keep after Siehe Auch\n\n\n## Another Section\n## Another Section\nLink Text"
    assert one(spark.range(1), X.clean_markdown(F.lit(before))) == after


@pytest.mark.parametrize("row, expected", [(("beginner", 5, "high"), "encore"), (("beginner", None, None), "warmup"), (("advanced", 15, "low"), "performance"), (("beginner", 11, "medium"), "exercise"), ((None, 20, None), "exercise"), (("beginner", 0, "low"), "exercise")])
def test_suitable_for(spark, row, expected):
    df = spark.createDataFrame([row], "d string, m int, e string")
    assert one(df, X.suitable_for(F.col("d"), F.col("m"), F.col("e"))) == expected


# ---- matching


def score(spark, a, b, ma=(), mb=(), sa=(), sb=(), same=(None, None)):
    df = spark.createDataFrame([(a, b, list(ma), list(mb), list(sa), list(sb), *same)], "a string, b string, ma array<string>, mb array<string>, sa array<string>, sb array<string>, ca string, cb string")
    return one(df, match.match_score(*map(F.col, ("a", "b", "ma", "mb", "sa", "sb", "ca", "cb"))))


def test_match_ladder(spark):
    s = lambda *a, **k: score(spark, *a, **k)
    assert s("Freeze", "Freeze Tag", same=("Freeze Tag", None)) == 1.0
    assert s("The Mirror", "mirror (exercise)") == 0.95
    assert s("story circle", "the big story circle", ["x"], ["X"]) == 0.85
    assert s("story circle", "big story circle", ["a", "b", "c", "d"], ["a", "e", "f", "g"]) == 0.80
    assert s("story circle", "big story circle") == 0.70
    assert s("abcdefgh", "abcdefgx", ["a", "b"], ["a", "b"]) == 0.90
    assert s("abcdefgh", "abcdefgx", ["a", "b", "c", "d"], ["a", "b", "e"]) == 0.90
    assert s("abcdefgh", "abcdefxy", ["a", "b", "c"], ["a", "b", "d", "e", "f"]) == 0.80
    assert s("abcdefgh", "abcdefxy", ["a"], ["a", "b"]) == 0.75
    assert s("abcdefgh", "abcdefgx", [], []) == 0.65
    assert s("x" * 30, "x" * 30 + "y" * 2, ["a"], ["a"], ["s"], ["s"]) == pytest.approx(0.85)
    assert s("alpha", "omega") == 0.0
    assert s("", "") == 0.65


def test_matches_and_seeds(spark):
    rows = catalogue(spark, flat("e1", "Story Circle", "a", mechanics=["m"]), flat("e2", "Story Circle", "b", mechanics=["m"]), flat("e3", "Story Circle", "a"), flat("e4", "Kreis", "a", "de", link_en="e1"), flat("e5", "Other", "c", link_en="zz"))
    found = {(r["a"], r["b"], r["confidence"]) for r in match.deterministic_matches(rows).collect()}
    assert found == {("e1", "e2", 0.95), ("e3", "e2", 0.95)}
    assert [(r["a"], r["b"]) for r in match.translation_seeds(rows).collect()] == [("e4", "e1")]
    assert match.bidirectional_report(rows).count() == 1
    related = {r["id"]: len(r["related"]) for r in match.related_identifiers(match.deterministic_matches(rows)).collect()}
    assert related == {"e1": 1, "e2": 2, "e3": 1}
    assert match.model_matches(rows, match.deterministic_matches(rows), None).count() == 0


# ---- components and the whole graph


def test_components_of_awkward_edges(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(7, 7), (None, 3), (500, 501), (501, 500), (500, 501)]
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 400)) and found[501] == 500
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_of_a_long_path_take_few_rounds(spark, monkeypatch):
    import random

    from weftgraph.plans.lineage import Scratch

    names = [f"v{k}" for k in range(600)]
    random.Random(7).shuffle(names)
    path = list(zip(names, names[1:])) + [("hub", f"leaf{k}") for k in range(100)] + [("x", None), ("x", "x")]
    kept, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, tag: kept.append(tag) or keep(self, df, tag))
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(path, "src string, dst string"), rest=20).collect()}
    assert found == {n: min(names) for n in names} | {n: "hub" for n in ["hub", *(f"leaf{k}" for k in range(100))]}
    assert 2 <= kept.count("parents") <= 10


@pytest.fixture(scope="module")
def derived(spark):
    pair = lambda i, c: {"related": [(i, c)]}
    rows = catalogue(
        spark,
        flat("e1", "Simple Circle", "a", mechanics=["circle"], difficulty="beginner", minutes=5, **pair("e2", 0.95)),
        flat("e2", "Circle Energy Pass", "b", mechanics=["Circle", "energy"], difficulty="beginner", minutes=8, summary="A longer summary.", steps=[("go", None, None)], **pair("e1", 0.95)),
        flat("e3", "Story Circle", "a", mechanics=["circle", "words"], difficulty="advanced", minutes=15),
        flat("e4", "Kreis", "c", "de", link_en="e1", tags=["Spiel"]),
        flat("e5", "Show", "b", mechanics=["audience suggestion"], derivedElements=[("Show 2", "d", "e5")], tags=["Objects"]),
    )
    overrides = spark.createDataFrame([(0, "add_edge", None, None, "hasTag", "e5", "gone", None, None, None, None, None, None)], schema.OVERRIDE)
    vocabulary_rows = vocab(spark, ("mechanics", "Ring", ["circle"], None, 0))
    return graph.derive_graph(rows, vocabulary_rows), graph.derive_graph(rows, vocabulary_rows, overrides)


def test_derived_graph(derived):
    g, with_override = derived
    edges = {(r["type"], r["src"], r["dst"]): r["confidence"] for r in g.edges.collect()}
    labels = {r["id"]: (r["type"], r["label"]) for r in g.nodes.collect()}
    canonicals = {r["id"]: r for r in g.elements.where("canonical").collect()}
    assert sorted(r["lang"] for r in canonicals.values()) == ["de", "en"]
    english = next(r for r in canonicals.values() if r["lang"] == "en")
    assert english["label"] == "Circle Energy Pass" and english["minutes"] == 7 and english["summary"] == "A longer summary." and english["mechanics"] == ["circle", "Circle", "energy"]
    assert edges["canonicalOf", "e1", english["id"]] == 0.95
    assert ("translationOf", english["id"], next(i for i in canonicals if i != english["id"])) in edges
    ring = next(i for i, (t, n) in labels.items() if (t, n) == ("Mechanic", "Ring"))
    assert ("hasMechanic", "e1", ring) in edges and ("hasMechanic", english["id"], ring) in edges
    assert ("buildsOn", "e3", "e1") in edges and not any(t == "buildsOn" and s == "e1" for t, s, _ in edges)
    assert {labels[d][1] for t, s, d in edges if t == "requires" and s == "e5"} == {"audience_input", "props_objects"}
    assert any(t == "variationOf" and d == "e5" for t, _, d in edges)
    meta = g.meta.first()
    assert meta["edgeCount"] == len(edges) and meta["n_Source"] == 3 and meta["e_canonicalOf"] == 3
    more = {(r["type"], r["src"], r["dst"]) for r in with_override.edges.collect()}
    assert more == set(edges) | {("hasTag", "e5", "gone")} and with_override.meta.first()["edgeCount"] == len(more)


def test_one_member_for_each_source(spark):
    rows = catalogue(spark, flat("e1", "A", "a"), flat("e2", "A", "a"), flat("e3", "A", "b"))
    links = spark.createDataFrame([("e1", "e3", 0.7), ("e2", "e3", 0.9), ("e3", "x", 1.0)], "src string, dst string, confidence double")
    kept = clusters.one_per_source(rows, clusters.members(rows, links), links)
    assert {r["id"] for r in kept.collect()} == {"e2", "e3"}


def test_empty_graph(spark):
    g = graph.derive_graph(spark.createDataFrame([], FLAT), vocab(spark))
    assert g.nodes.count() == 0 and g.edges.count() == 0


# ---- queries


@pytest.fixture(scope="module")
def small(spark):
    elements = spark.createDataFrame(
        [("e1", "Yes And", "About yes.", "en", True, "beginner", 5, "high", 2, 8, 1), ("e2", "Eyes Closed", "Dark.", "en", True, None, None, None, None, None, 2), ("e3", "Story Circle", "Tell.", "en", True, "advanced", 15, "low", 4, None, 3), ("e4", "Ja Und", "Ja.", "de", True, "beginner", 10, None, 2, 6, 4), ("e5", "Yes, let's", "Go.", "en", False, "beginner", 5, "high", 2, 8, 5)],
        "id string, label string, summary string, lang string, canonical boolean, difficulty string, minutes int, energy string, pmin int, pmax int, ord long",
    )
    nodes = spark.createDataFrame([("m1", "Mechanic", "acceptance", 1), ("m2", "Mechanic", "circle", 2), ("r1", "Requirement", "music", 3), ("r2", "Requirement", "props", 4)], "id string, type string, label string, ord long").unionByName(elements.selectExpr("id", "'Element' AS type", "label", "ord"))
    edges = spark.createDataFrame([("hasMechanic", "e1", "m1", None, 1), ("hasMechanic", "e3", "m2", None, 2), ("hasMechanic", "e1", "m2", None, 3), ("requires", "e1", "r1", None, 4), ("requires", "e1", "r2", None, 5), ("requires", "e3", "r1", None, 6)], "type string, src string, dst string, confidence double, ord long")
    return elements, edges, nodes


def ids(df):
    return [r["id"] for r in df.orderBy("ord").collect()]


def test_filters(small):
    f = lambda **k: ids(query.filter_elements(*small, **k))
    assert f() == ["e1", "e2", "e3"] and f(language="") == ["e1", "e2", "e3"] and f(language="de") == ["e4"]
    assert f(canonical=False) == ["e1", "e2", "e3", "e5"]
    assert f(difficulty="beginner") == ["e1"] and f(difficulty="") == ["e1", "e2", "e3"]
    assert f(min_players=9) == ["e2", "e3"] and f(min_players=3) == ["e1", "e2"] and f(max_players=3) == ["e1", "e2"]
    assert f(min_duration=6) == ["e2", "e3"] and f(max_duration=6) == ["e1", "e2"]
    assert f(mechanic="CIRCLE") == ["e1", "e3"] and f(mechanic="nothing") == []
    assert f(exclude_requirements=["music", "zzz"]) == ["e2"] and f(exclude_requirements=["zzz"]) == ["e1", "e2", "e3"]
    assert f(require_requirements=["Music", "props"]) == ["e1"] and f(require_requirements=["music", "zzz"]) == ["e1", "e3"] and f(require_requirements=["zzz"]) == ["e1", "e2", "e3"]


def test_pages(spark, small):
    found = query.query_elements(*small, page=1, limit=2).orderBy("ord").collect()
    assert [(r["id"], r["total"], r["mechanics"]) for r in found] == [("e1", 3, ["acceptance", "circle"]), ("e2", 3, [])]
    many = spark.range(500).selectExpr("id AS ord")
    assert query.paginate(many, 0, 5000)[0].count() == 100 and query.paginate(many, 0, 0)[0].count() == 20


def test_similar(small):
    elements, edges, _ = small
    found = query.similar_elements(query.feature_pairs(edges), "e3", elements).collect()
    assert [(r["id"], r["score"]) for r in found] == [("e1", 0.5)]
    assert [r["id"] for r in query.one_hop(edges, small[2], "m2").collect()] == ["e3", "e1"]
    assert query.find_element(elements, "circle").first()["id"] == "e3"


def test_search(small):
    rows = query.label_arrays(small[0], small[1], small[2])
    found = lambda q, **k: [(r["id"], r["score"]) for r in search.search_elements(rows, q, **k).collect()]
    assert found("yes") == [("e1", 15)]
    assert found("the") == []
    assert found("yes yes") == [("e1", 30)]
    assert found("xyzznomatch acceptance") == [("e1", 4)]
    assert found("let's", canonical_only=False) == [("e5", 10)]
    assert found("circle") == [("e3", 14), ("e1", 4)]
    assert search.suggestions(["Status"])[:2] == ["storytelling", "characters"]
    assert [r["label"] for r in search.matched_concepts(small[2], ["circle"]).collect()] == ["circle"]


def test_review(derived):
    g, _ = derived
    assert [r["members"] for r in review.cluster_review(g.edges).collect()] == [3]
    assert review.confidence_histogram(review.cluster_review(g.edges)).count() == 1
    top = review.hubs(g.nodes, g.edges).first()
    assert top["degree"] >= 3 and len(top["samples"]) <= 5
    assert review.random_canonicals(g.elements, 1).count() == 1


# ---- plans


def test_plan(spark):
    rows = [(f"e{i}", f"E{i}", "beginner" if i < 4 else "advanced" if i < 8 else None, [5, 8, 20, 10][i % 4], "high" if i == 0 else "medium", None, None, i) for i in range(12)]
    catalog = spark.createDataFrame(rows, "id string, label string, difficulty string, minutes int, energy string, pmin int, pmax int, ord long")
    edges = spark.createDataFrame([("buildsOn", "e8", "e9", 0)], "type string, src string, dst string, ord long")
    pool, warnings = planner.plan_pool(catalog, None, 6, "expert")
    assert warnings == ["No element of difficulty expert"]
    plan = [(r["section"], r["id"]) for r in planner.plan_workshop(pool, catalog, edges, 60).collect()]
    main = [i for s, i in plan if s == "main"]
    assert [s for s, _ in plan].count("warmup") >= 2 and len(main) >= 3 and len(set(i for _, i in plan)) == len(plan)
    assert "e8" not in main or main.index("e9") < main.index("e8")
    assert planner.plan_warnings(planner.plan_workshop(pool.limit(0), catalog, edges, 60), 60).count() == 4
    assert planner.excluded_requirements(["no-props", "no-audience"]) == ["props_objects", "audience_input", "audience_on_stage"]


# ---- vocabulary


def clustered(spark, kind, *names):
    terms = spark.createDataFrame([(kind, n, i) for i, n in enumerate(names)], "kind string, term string, ord long")
    return {frozenset([r["canonical"], *r["variants"]]) for r in vocabulary.cluster_terms(terms).collect()}


def test_term_clusters(spark):
    assert clustered(spark, "mechanics", "freeze", "freezing") == {frozenset(["freeze", "freezing"])}
    assert clustered(spark, "mechanics", "freeze", "freeze signal") == {frozenset(["freeze", "freeze signal"])}
    four = ("letter avoidance constraint", "dialogue constraint", "singing constraint", "alphabet constraint")
    assert len(clustered(spark, "mechanics", *four)) == 4
    assert clustered(spark, "skills", "abc", "xyz", "xyz") == {frozenset(["abc"]), frozenset(["xyz"])}


def test_fillers_and_rewrite(spark):
    terms = spark.createDataFrame([(str(i), "mechanics", "Filler " if i < 9 else "rare", None, i) for i in range(10)], "id string, kind string, term string, category string, ord long")
    total = spark.createDataFrame([(10,)], "total long")
    assert [tuple(r) for r in vocabulary.detect_fillers(terms, total).collect()] == [("filler", 9, 0.9, "mechanics")]
    kind = "array<struct<name:string,originalName:string,category:string>>"
    rows = spark.createDataFrame([("e1", [("circle", None, "c"), ("Ring", "old", None), ("free", "kept", None)], [])], f"id string, mechanics {kind}, skills {kind}")
    out = vocabulary.apply_canonical_terms(rows, vocab(spark, ("mechanics", "Ring", ["circle"], None, 0))).first()
    assert [(m["name"], m["originalName"]) for m in out["mechanics"]] == [("Ring", "circle"), ("Ring", None), ("free", "kept")]


# ---- assembly, sources, extraction


def test_merge_and_tags(spark):
    rows = spark.createDataFrame([("a", "x", ["t", "u"], 1), ("a", None, ["u", "v"], 2), ("b", "y", None, 3), ("a", "z", [], 4)], "identifier string, name string, tags array<string>, ord long")
    merged = {r["identifier"]: r for r in assemble.keyed_merge(rows).collect()}
    assert (merged["a"]["name"], merged["a"]["tags"], merged["a"]["ord"]) == ("z", ["t", "u", "v"], 1) and merged["b"]["tags"] == []
    assert [tuple(r) for r in assemble.merge_conflicts(rows).collect()] == [("a", "name")]
    names = spark.createDataFrame([("game", "Spiel", "Game", 0), ("x2", "spiel", "X", 1)], "tag_id string, de string, en string, dict_ord int")
    tagged = assemble.translated_tags(assemble.tag_ids(rows.limit(1).withColumn("tags", F.array(F.lit("SPIEL"), F.lit("game"), F.lit("odd"))).withColumn("languageCode", F.lit("de")), names), names).first()
    assert tagged["tagIds"] == ["game", "no_translation_id_odd"] and tagged["translatedTags"] == ["Spiel", "no_translation_id_odd"]


def test_files(spark, tmp_path):
    (tmp_path / "raw.json").write_text(json.dumps({"meta": {}, "elements": [{"identifier": "i", "name": "n", "url": "u", "card_Age": "5"}, {"identifier": "j", "name": "m", "url": "u"}]}))
    raw = readers.read_raw(spark, str(tmp_path / "raw.json"))
    assert [(r["identifier"], r["card"], r["ord"]) for r in raw.orderBy("ord").collect()] == [("i", {"card_Age": "5"}, 0), ("j", {}, 1)]
    assert readers.read_raw_by_url(spark, str(tmp_path / "raw.json")).first()["identifier"] == "j"
    assert readers.read_raw(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_raw(spark, str(tmp_path / "none.json"), missing_ok=False)
    (tmp_path / "o.json").write_text(json.dumps({"version": 1, "overrides": [{"type": "reject_match", "elementA": "a", "elementB": "b"}]}))
    assert readers.read_overrides(spark, str(tmp_path / "o.json")).first()["elementB"] == "b"
    assert readers.read_overrides(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "t.json").write_text(json.dumps({"sameAs": [{"canonical": "Freeze Tag", "variants": ["Freeze"]}]}))
    assert {tuple(r) for r in readers.read_thesaurus(spark, str(tmp_path / "t.json")).collect()} == {("freeze tag", "Freeze Tag"), ("freeze", "Freeze Tag")}
    (tmp_path / "v.json").write_text(json.dumps({"mechanics": [{"canonical": "a", "variants": ["b"], "parent": None}], "skills": []}))
    assert readers.read_vocabulary(spark, str(tmp_path / "v.json")).count() == 1
    xml = spark.createDataFrame([(0, "<urlset><url><loc> http://a </loc><lastmod>1</lastmod></url><url><loc>http://a</loc><lastmod>2</lastmod></url><url><loc></loc></url></urlset>"), (1, "<sitemapindex><sitemap><loc>http://a</loc></sitemap><sitemap><loc>http://b</loc></sitemap></sitemapindex>")], "ord long, xml string")
    assert {tuple(r) for r in readers.parse_sitemaps(xml).collect()} == {("http://a", "2"), ("http://b", None)}
    writers.write_graph(raw.selectExpr("identifier AS id", "'Element' AS type"), raw.selectExpr("'t' AS type"), raw.limit(1).select("identifier"), str(tmp_path / "g"))
    assert readers.read_graph(spark, str(tmp_path / "g"))[0].count() == 2


def test_pages_to_elements(spark):
    html = '<html><link rel="alternate" hreflang="en" href="https://x/en/wiki/a"><h1 class="font-comic big">#Freeze</h1><div class="article-content"><p>A <b>bold</b> <a href="/wiki/b">b</a></p><ul><li>one</li></ul></div><div><h3>Kategorien</h3><p><a>Spiel</a> <a>Spiel</a></p><h3>Number of Players</h3><p> 4 bis 8 </p></div><p>Zuletzt bearbeitet am 01.02.2020</p></html>'
    pages = spark.createDataFrame([("https://x/de/wiki/a", html), ("https://x/none", "<p>no title</p>"), ("u", None)], "url string, html string")
    row = html_pages.add_markdown(html_pages.extract_pages(pages, html_pages.CARD_WIKI, ("warmup",))).first()
    assert (row["name"], row["languageCode"], row["tags"], row["lastUpdate"], row["translationLinkEn"]) == ("Freeze", "de", ["warmup", "Spiel"], "01.02.2020", "https://x/en/wiki/a")
    assert row["links"] == ["https://x/wiki/b"] and row["card"] == {"card_Number Players": "4 bis 8"} and row["markdown"] == "A **bold** [b](/wiki/b)\n\n*   one"
    listing = spark.createDataFrame([("https://x/l", '<main><a href="/wiki/1"><h3>1</h3></a><a href="/wiki/2">2</a><a href="/wiki/3"><h3>3</h3></a></main>')], "url string, html string")
    assert [r["link"] for r in html_pages.listing_links(listing, html_pages.CARD_WIKI).collect()] == ["https://x/wiki/1", "https://x/wiki/3"]
    assert html_pages.listing_links(listing, html_pages.CARD_WIKI, 1).count() == 1


def test_responses(spark):
    texts = ['```json\n{"name":"A"}\n```', 'x {"name":"B"} y', '[{"name":"C"},{"name":"D"}]', '{"name":"E","tips":["t', "nothing", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "identifier int, response string")
    parsed = extract.coerce(extract.parse_responses(rows)).orderBy("identifier", "part").collect()
    assert [(r["identifier"], r["part"], r["name"]) for r in parsed] == [(0, 0, "A"), (1, 0, "B"), (2, 0, "C"), (2, 1, "D"), (3, 0, "E")]
    assert parsed[4]["normalized"]["tips"][0].asDict() == {"text": "t", "category": "general"}
    full = {"name": "N", "description": "D", "howToPlay": "just do", "mechanics": ["m", {"name": "k", "category": "c"}], "practical": {"typicalDurationMinutes": 5, "groupSize": {"min": 2}}, "variations": [{"name": "v", "differsBy": ["a"]}]}
    n = extract.coerce(extract.parse_responses(spark.createDataFrame([(1, json.dumps(full))], "identifier int, response string"))).first()["normalized"]
    assert n["summary"] == "D" and n["howToPlay"]["steps"][0]["action"] == "just do" and [(m["name"], m["category"]) for m in n["mechanics"]] == [("m", None), ("k", "c")]
    assert n["practical"]["typicalDurationMinutes"] == 5 and n["practical"]["groupSize"]["min"] == 2 and n["variations"][0]["differsBy"] == ["a"]


def test_model_fallback():
    waits, seen = [], []

    def call(model, prompt):
        seen.append(model)
        if model == "a":
            raise extract.OutOfCredit
        if len(seen) < 4:
            raise OSError
        return "ok"

    assert extract.call_with_fallback(call, "p", ["a", "b"], sleep=waits.append, jitter=lambda: 0.0) == ("ok", "b")
    assert seen == ["a", "b", "b", "b"] and waits == [1.0, 2.0]
    with pytest.raises(RuntimeError):
        extract.call_with_fallback(lambda *_: 1 / 0, "p", ["x"], tries=2, sleep=waits.append)
    assert extract.parse_model_list(" a, ,b") == ["a", "b"] and extract.parse_model_list(None) == ["default"]


def test_violations(spark):
    good = {"identifier": "a" * 32, "url": "https://x/y", "languageCode": "en", "normalized": {"summary": "long enough", "description": "certainly long enough too", "practical": {}}, "relatedIdentifiers": []}
    bad = {**good, "identifier": "short", "languageCode": "fr"}
    rows = spark.createDataFrame([json.dumps(good), json.dumps(bad)], "string").select(F.from_json("value", schema.ELEMENT).alias("e")).select("e.*")
    assert [(r["identifier"], r["broken"]) for r in schema.violations(rows).collect()] == [("short", ["identifier", "languageCode"])]


def test_upsert_stream(spark, tmp_path):
    from weftgraph.streaming.incremental import upsert_stream

    kind = "id string, hash string, ord long"
    parts = [[("a", "0", 1), ("a", "1", 2), ("b", "1", 3)], [("a", "1", 4), ("b", "2", 6), ("b", "9", 5), ("c", "1", 7)], [("b", "1", 8), ("a", "1", 9)]]
    for part in parts:
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        upsert_stream(stream, str(tmp_path / "out"), "id", "hash", lambda df: df, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out" / "rows")).collect()
    assert sorted((r["id"], r["hash"], r["batch"]) for r in rows) == [("a", "1", 0), ("b", "1", 0), ("b", "1", 2), ("b", "2", 1), ("c", "1", 1)]
    state = spark.read.parquet(str(tmp_path / "out" / "state" / "batch=2")).collect()
    assert sorted((r["id"], r["hash"]) for r in state) == [("a", "1"), ("b", "1"), ("c", "1")]


def test_translations_are_followed_to_the_end(spark):
    kind = "url string, identifier string, translationLinkEn string, translationLinkDe string, ord long"
    pages = spark.createDataFrame([(f"u{i}", f"i{i}", f"u{i + 1}", None, i) for i in range(24)], kind)
    found = assemble.follow_translations(pages.where("url = 'u0'"), pages).collect()
    assert len(found) == 24 and {r["translationLinkEnIdentifier"] for r in found} == {f"i{i}" for i in range(1, 24)} | {None}


def test_seeds_add_rename_and_open_clusters(spark):
    rows = vocab(spark, ("mechanics", "circle", ["Kreis", "ring"], None, 0), ("mechanics", "story", [], None, 1), ("mechanics", "other", ["Fang"], None, 2))
    seeds = spark.createDataFrame([("mechanics", "geschichte", "Story"), ("mechanics", "fang", "tag game"), ("mechanics", "neu", "new"), ("mechanics", "frisch", "New"), ("mechanics", "kreis", "circle")], "kind string, term_lc string, canonical string")
    found = {r["canonical"]: r["variants"] for r in vocabulary.apply_seeds(rows, seeds).collect()}
    assert found == {"circle": ["Kreis", "ring"], "story": ["geschichte"], "tag game": ["tag game"], "New": ["frisch", "neu"]}


def test_blocks_are_shown_to_the_matcher(spark):
    import pandas as pd

    rows = catalogue(spark, *(flat(f"e{i}", f"Name {i // 2}", "ab"[i % 2]) for i in range(10)), flat("e20", "Name 0", "c"))

    def matcher(batches):
        for pdf in batches:
            out = [(x["id"], y["id"], 0.9) for a, b in zip(pdf["names_a"], pdf["names_b"]) for x in a for y in b if x["label"] == y["label"]]
            yield pd.DataFrame(out, columns=["a", "b", "confidence"])

    found = {(r["a"], r["b"]) for r in match.block_matches(rows, matcher, size=2).collect()}
    assert found == {(f"e{i}", f"e{i + 1}") for i in range(0, 10, 2)} | {("e0", "e20"), ("e1", "e20")}


def test_dedup_stage_runs_once_for_an_input(spark):
    rows = catalogue(spark, flat("e1", "Story Circle", "a", mechanics=["m"]), flat("e2", "Story Circle", "b", mechanics=["m"]), flat("e4", "Kreis", "a", "de", link_en="e1"))
    state = spark.createDataFrame([("other", "x")], "stage string, hash string")
    done, state = match.dedup_stage(rows, state)
    assert {r["id"]: [x["identifier"] for x in r["related"]] for r in done.collect()} == {"e1": ["e2", "e4"], "e2": ["e1"], "e4": ["e1"]}
    again, same = match.dedup_stage(rows.orderBy(F.desc("ord")), state)
    assert again is None and sorted(map(tuple, same.collect())) == sorted(map(tuple, state.collect()))
    assert match.dedup_stage(rows.where("id <> 'e2'"), state)[0] is not None


def test_materialised_paths(spark):
    assert new_path(spark, "x") != new_path(spark, "x")


def test_scrape(spark):
    from weftgraph.sources.scrape import Listing, scrape

    page = lambda name: f'<h1 class="entry-title">{name}</h1><div class="entry-content"><p>About {name}.</p></div>'
    listing = lambda *links: '<ul class="lcp_catlist">' + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in links) + "</ul>"
    rows = [("https://x/l1", listing("a", "b")), ("https://x/l2", listing("b", "c", "gone")), *((f"https://x/{x}", page(x)) for x in "abcd")]
    pages = spark.createDataFrame(rows, "url string, html string")
    listings = [Listing("https://x/l1", ("warmup",)), Listing("https://x/l2", ("game",))]
    found = {r["name"]: (r["tags"], r["markdown"]) for r in scrape(pages, listings, html_pages.BLOG).collect()}
    assert found == {"a": (["warmup"], "About a."), "b": (["warmup", "game"], "About b."), "c": (["game"], "About c.")}
    known = spark.createDataFrame([("https://x/a", "2024-05-01"), ("https://x/b", "2024-05-01")], "url string, fetchedAt string")
    changed = spark.createDataFrame([("https://x/b", "2024-06-01")], "loc string, lastmod string")
    assert {r["name"] for r in scrape(pages, listings, html_pages.BLOG, known, changed).collect()} == {"b", "c"}
    assert {r["name"] for r in scrape(pages, listings, html_pages.BLOG, per_listing=1).collect()} == {"a", "b"}


def test_reports_of_the_derived_graph_list_no_prerequisites(spark, monkeypatch):
    rows = [flat(f"e{k}", f"Name {k}", mechanics=["m", "n"][: 1 + k % 2], difficulty="beginner") for k in range(1, 9)]
    listed = graph.derive_graph(catalogue(spark, *rows), vocab(spark))
    assert listed.edges.where("type = 'buildsOn'").select("src", "dst").distinct().count() == 16
    assert listed.meta.first()["e_buildsOn"] == 16

    def refuse(*_):
        raise AssertionError("prerequisites were listed")

    monkeypatch.setattr(graph, "builds_on", refuse)
    g = graph.derive_graph(catalogue(spark, *rows), vocab(spark))
    meta = g.meta.first()
    assert (meta["e_buildsOn"], meta["edgeCount"]) == (16, listed.edges.count())
    assert g.nodes.where("type = 'Element'").count() == 8
    assert review.cluster_review(g.edges_of("canonicalOf", "translationOf")).count() == 0


def test_batches_are_dealt_out(spark):
    rows = catalogue(spark, *(flat(f"e{i}", f"Name {i}", "abc"[i % 3]) for i in range(24)))
    found = match.match_batches(rows, 2)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, found.collect())) == sorted((s, i, t, j) for s, t in ("ab", "ac", "bc") for i in range(4) for j in range(4))


def test_blocks_meet_in_cells_and_come_in_small_batches(spark, monkeypatch):
    import pandas as pd

    rows = catalogue(spark, *(flat(f"e{i}", "Long name " * 50 + str(i // 2), "ab"[i % 2]) for i in range(4000)))
    monkeypatch.setattr(match, "CELL", 7)
    monkeypatch.setattr(match, "BATCH_BYTES", "200k")

    def matcher(batches):
        for pdf in batches:
            pairs = [(x["id"], y["id"], 0.9) for a, b in zip(pdf["names_a"], pdf["names_b"]) for x in a for y in b if x["label"] == y["label"]]
            yield pd.DataFrame([*pairs, ("shown", str(len(pdf)), 0.9)], columns=["a", "b", "confidence"])

    found = [(r["a"], r["b"]) for r in match.block_matches(rows, matcher, size=100).collect()]
    shown = [int(b) for a, b in found if a == "shown"]
    assert sorted(x for x in found if x[0] != "shown") == sorted((f"e{i}", f"e{i + 1}") for i in range(0, 4000, 2))
    assert sum(shown) == 400 and max(shown) <= 4


def test_matches_compare_lists_once_a_pair(spark):
    import random

    rng = random.Random(5)
    lists = [None, [], ["m"], ["M", "m"], ["m", "n"], ["m", None], ["m", "n", "o"], ["N", "o"], ["m", "n", "o", "p", "q"]]
    labels = ["Story Circle", "Story Circle Game", "story circel", "Circle", "Story Time", "The Story Circle", "Circle Dance " * 4]
    rows = catalogue(spark, *(flat(f"e{k}", rng.choice(labels), rng.choice("abc"), mechanics=rng.choice(lists), skills=rng.choice(lists)) for k in range(150)))
    e = rows.select("id", "label", "source", "mechanics", "skills")
    side = lambda s: e.select(*(F.col(c).alias(f"{c}_{s}") for c in e.columns))
    score = match.match_score(*(F.col(f"{c}_{s}") for c in ("label", "mechanics", "skills") for s in "ab"))
    shares = F.arrays_overlap(X.name_tokens(F.col("label_a")), X.name_tokens(F.col("label_b")))
    every = side("a").join(side("b"), (F.col("source_a") < F.col("source_b")) & shares).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), score.alias("c"))
    for least in (0.65, 0.85):
        found = match.deterministic_matches(rows, least=least)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, every.where(F.col("c") >= least).collect()))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_intersect") == 2 and "Generate" in plan


def test_members_are_chosen_from_components_as_they_are(spark):
    rows = catalogue(spark, flat("e1", "A", "a"), flat("e2", "A", "a"), flat("e3", "A", "b"), flat("e4", "B", "a"), flat("e5", "C", "a"), flat("e6", "C", "a"))
    links = spark.createDataFrame([("e1", "e3", 0.7), ("e2", "e3", 0.9), ("e3", "x", 1.0), ("e4", "y", 1.0), ("e5", "e6", 1.0)], "src string, dst string, confidence double")
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    member = connected_components(links).withColumn("id", counted("id"))
    kept = clusters.one_per_source(rows, member, links)
    assert {(r["component"], r["id"]) for r in kept.collect()} == {("e1", "e2"), ("e1", "e3")}
    assert seen.value == 8  # each of the ids once


def test_merge_reads_elements_once_for_all_modes(spark, tmp_path):
    rows = [flat("e1", "A", difficulty="x", energy="high"), flat("e2", "B", difficulty="y", energy=""), flat("e3", "C", difficulty="y"), flat("e4", "D", difficulty="x", energy="low"), flat("e5", "E", lang="de", difficulty="")]
    catalogue(spark, *rows).write.parquet(str(tmp_path / "elements"))
    member = spark.createDataFrame([("e1", f"e{k}") for k in range(1, 6)], "component string, id string")
    merged = clusters.merge_canonicals(spark.read.parquet(str(tmp_path / "elements")), member)
    assert {r["lang"]: (r["difficulty"], r["energy"]) for r in merged.collect()} == {"en": ("x", "high"), "de": (None, None)}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.endswith(" parquet") for line in plan.split("\n")) == 2


def test_prerequisites_are_written_no_pair_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", 3)
    written, keep, put = [], graph.Scratch.keep, graph.materialize
    monkeypatch.setattr(graph.Scratch, "keep", lambda self, df, tag: written.append(keep(self, df, tag).persist()) or written[-1])
    monkeypatch.setattr(graph, "materialize", lambda df, tag: written.append(put(df, tag)) or written[-1])
    rows = [(f"e{k}", f"n{k % 7}", "s" if k % 9 else "t", ("beginner", "advanced", None)[k % 3], (None, 0, 5, 9)[k % 4]) for k in range(60)]
    sets = {f"e{k}": {f"m{j}" for j in range(5) if (k % 29) >> j & 1} for k in range(60)}
    elements = spark.createDataFrame(rows, "id string, label string, source string, difficulty string, minutes int")
    links = spark.createDataFrame([(i, m) for i, s in sets.items() for m in s], "src string, dst string")
    rank = {"beginner": 0, "advanced": 2, None: 0}
    fits = lambda a, b: a[2] == b[2] and a[1] != b[1] and rank[a[3]] <= rank[b[3]] and (not a[4] or not b[4] or a[4] <= b[4])
    expected = sorted((b[0], a[0]) for a in rows for b in rows if sets[a[0]] and sets[a[0]] < sets[b[0]] and fits(a, b))
    found = sorted((r.src, r.dst) for r in graph.builds_on(elements, links).collect())
    assert found == expected and len(expected) > 2 * len(rows)
    assert sum(len(r.members) for r in written[-1].collect()) == sum(map(bool, sets.values())) and all(t.count() <= len(rows) for t in written)
