"""Derivation of the typed graph: nodes, edges, requirements, prerequisites, counters, overrides."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import derived_id, difficulty_rank, node_id
from ..plans.lineage import Scratch, materialize
from . import clusters
from .match import apply_match_overrides, symmetric

#: Requirement, kind of term, term.
REQUIREMENT_RULES = (
    ("audience_input", "mechanic", "audience suggestion"),
    ("audience_input", "mechanic", "audience voting"),
    ("audience_input", "tag", "Ask For"),
    ("audience_input", "tag", "Zuschauer auf der Bühne"),
    ("physical_contact", "mechanic", "physical contact"),
    ("physical_contact", "mechanic", "touch to speak"),
    ("physical_contact", "tag", "Physical Contact"),
    ("physical_contact", "tag", "Körperkontakt und Berührung"),
    ("music_singing", "mechanic", "singing constraint"),
    ("music_singing", "mechanic", "musical accompaniment"),
    ("music_singing", "tag", "Musik und Gesang"),
    ("music_singing", "tag", "Musikspiele"),
    ("props_objects", "mechanic", "object prompt"),
    ("props_objects", "mechanic", "Human Props"),
    ("props_objects", "tag", "Objects"),
    ("props_objects", "tag", "Spiele mit Gegenständen"),
    ("audience_on_stage", "tag", "Audience on stage"),
    ("audience_on_stage", "tag", "Zuschauer auf der Bühne"),
)
EDGE_TYPES = ("hasMechanic", "trainsSkill", "hasTag", "sourcedFrom", "translationOf", "derivedFrom", "canonicalOf", "requires", "buildsOn", "variationOf")
#: Elements of one set of mechanics that a row holds, about.
CHUNK = 512
TERM_EDGES = (("mechanics", "hasMechanic", "mechanic", "Mechanic"), ("skills", "trainsSkill", "skill", "Skill"), ("tags", "hasTag", "tag", "Tag"))


def requirement_rules(spark: SparkSession, rules=REQUIREMENT_RULES) -> DataFrame:
    return spark.createDataFrame([(r, k, t.lower()) for r, k, t in rules], "requirement string, kind string, term string")


def requirements(terms: DataFrame, rules: DataFrame) -> DataFrame:
    """``(id, requirement)`` for terms (id, kind, term) that a rule names, case-insensitively. The rules are a fixed short list."""
    low = terms.select("id", "kind", F.trim(F.lower("term")).alias("term"))
    return low.join(F.broadcast(rules), ["kind", "term"]).select("id", "requirement").distinct()


def term_map(vocabulary: DataFrame) -> DataFrame:
    """``(kind, term_lc, canonical)``: variants and canonicals, the later cluster holds."""
    terms = vocabulary.select("kind", "ord", "canonical", F.explode(F.array_union(F.coalesce("variants", F.array()), F.array("canonical"))).alias("term"))
    return terms.groupBy("kind", F.lower("term").alias("term_lc")).agg(F.max_by("canonical", "ord").alias("canonical"))


def resolve_terms(terms: DataFrame, mapping: DataFrame) -> DataFrame:
    """Terms (kind, term, ...) with the canonical form in ``term``, where the vocabulary has one."""
    found = terms.withColumn("term_lc", F.lower("term")).join(mapping, ["kind", "term_lc"], "left")
    return found.withColumn("term", F.coalesce("canonical", "term")).drop("term_lc", "canonical")


def first_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key in ``ord`` order; an aggregate, so copies of a key combine before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), "ord").alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def element_summary(summary: Column, description: Column) -> Column:
    return F.coalesce(summary, F.substring(description, 1, 100))


def set_containment(sets: DataFrame) -> DataFrame:
    """``(a, b)`` within a group with all of a's items in b and b larger. ``sets``: grp, id, item, distinct.

    The pair count over shared items equals a's size. Only a's rarest item has to
    be joined for b to be a candidate; the rest is an array test.
    """
    rarity = sets.groupBy("grp", "item").agg(F.count("*").alias("df"))
    lists = sets.join(rarity, ["grp", "item"]).groupBy("grp", "id").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("f")).select("grp", "id", F.transform("f", lambda x: x["item"]).alias("items"))
    probe = lists.select("grp", F.col("id").alias("a"), F.col("items").alias("ia"), F.col("items")[0].alias("item"))
    build = lists.select("grp", F.col("id").alias("b"), F.col("items").alias("ib"), F.explode("items").alias("item"))
    return probe.join(build, ["grp", "item"]).where((F.size("ib") > F.size("ia")) & (F.size(F.array_except("ia", "ib")) == 0)).select("grp", "a", "b")


def _mechanic_sets(elements: DataFrame, has_mechanic: DataFrame) -> DataFrame:
    """``(id, grp, label, rank, minutes, items, set)`` of elements with a source, a label and mechanics."""
    rows = elements.select("id", F.col("source").alias("grp"), "label", difficulty_rank(F.col("difficulty")).alias("rank"), F.coalesce("minutes", F.lit(0)).alias("minutes"))
    lists = has_mechanic.where("dst IS NOT NULL").select(F.col("src").alias("id"), "dst").distinct().groupBy("id").agg(F.array_sort(F.collect_list("dst")).alias("items"))
    return rows.where("grp IS NOT NULL AND label IS NOT NULL").join(lists, "id").withColumn("set", _named("grp", "items"))


def _named(*columns: str) -> Column:
    return F.md5(F.to_json(F.struct(*columns)))


def _fits(ra: Column, rb: Column, ma: Column, mb: Column, la: Column, lb: Column) -> Column:
    return (ra <= rb) & ((ma <= 0) | (mb <= 0) | (ma <= mb)) & (la != lb)


def _prerequisites(elements: DataFrame, has_mechanic: DataFrame) -> DataFrame:
    """Prerequisites of classes.

    Elements of one source with equal mechanics, label, difficulty and minutes are
    one class; classes come in pairs with their sizes, ``(na, nb)``. Mechanics
    are compared once for each pair of distinct sets.
    """
    each = _mechanic_sets(elements, has_mechanic).withColumn("class", _named("set", "label", "rank", "minutes"))
    each = materialize(each.select("id", "set", "class", "grp", "items", "label", "rank", "minutes"), "mechanic-sets")
    sets = materialize(each.groupBy("set").agg(F.any_value("grp").alias("grp"), F.any_value("items").alias("items")), "sets")
    contained = set_containment(sets.select("grp", F.col("set").alias("id"), F.explode("items").alias("item")))
    classes = materialize(each.groupBy("class", "set", "label", "rank", "minutes").agg(F.count("*").alias("n")), "classes")
    small, large = (classes.select(F.col("set").alias(s), *(F.col(c).alias(f"{c[0]}{s}") for c in ("n", "label", "rank", "minutes"))) for s in "ab")
    fits = _fits(*(F.col(f"{c}{s}") for c in "rml" for s in "ab"))
    return contained.select("a", "b").join(small, "a").join(large, "b").where(fits).select("na", "nb")


def builds_on(elements: DataFrame, has_mechanic: DataFrame, salts: int = 4) -> DataFrame:
    """buildsOn edges (src builds on dst) among one source's elements.

    dst's mechanics are a proper subset of src's, its difficulty is no higher, its
    minutes are no more where both are known, and the labels differ.

    Sets of mechanics are compared where they meet, at the rarest item of the
    smaller, and carry their elements in lists of about ``CHUNK``, so edges are made
    in the last step and never shuffled or written: each element moves once for
    each of its mechanics and salt. A bit mask drops most pairs before their items are compared.
    """
    scratch = Scratch(elements.sparkSession)
    each = scratch.keep(_mechanic_sets(elements, has_mechanic), "mechanic-sets")
    sets = scratch.keep(each.groupBy("set").agg(F.any_value("grp").alias("grp"), F.any_value("items").alias("items"), F.count("*").alias("n")), "sets")
    item = sets.select("set", "grp", F.explode("items").alias("item"))
    rarity = item.groupBy("grp", "item").agg(F.count("*").alias("df"))
    rarest = item.join(rarity, ["grp", "item"]).groupBy("set").agg(F.min(F.struct("df", "item"))["item"].alias("rarest"))
    known = sets.join(rarest, "set").select("set", "rarest", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    mask = F.aggregate("items", F.lit(0).cast("long"), lambda x, i: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(i), F.lit(64)).cast("int"))))
    member = F.struct("id", "label", "rank", "minutes")
    chunks = each.join(known, "set").groupBy("set", F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk")).agg(*(F.any_value(c).alias(c) for c in ("grp", "items", "rarest")), F.collect_list(member).alias("members"))
    chunks = materialize(chunks.withColumns({"mask": mask, "salt": F.pmod(F.xxhash64("set", "chunk"), F.lit(salts)).cast("int")}).drop("set", "chunk"), "set-members")
    scratch.close()
    shuffles = int(elements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A given number of partitions, as AQE would join keys by their size, not by their pairs.
    dealt = lambda rows: rows.repartition(shuffles, "grp", "item", "salt")
    small = chunks.select("grp", F.col("rarest").alias("item"), "salt", *(F.col(c).alias(f"{c}_a") for c in ("items", "mask", "members")))
    large = chunks.select("grp", F.explode("items").alias("item"), *(F.col(c).alias(f"{c}_b") for c in ("items", "mask", "members")))
    large = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    inside = (F.col("mask_a").bitwiseAND(F.col("mask_b")) == F.col("mask_a")) & (F.size("items_b") > F.size("items_a")) & (F.size(F.array_except("items_a", "items_b")) == 0)
    pairs = dealt(small).hint("merge").join(dealt(large), ["grp", "item", "salt"]).where(inside)
    found = pairs.select(F.explode("members_a").alias("a"), "members_b").select("a", F.explode("members_b").alias("b"))
    fits = _fits(*(F.col(f"{s}.{c}") for c in ("rank", "minutes", "label") for s in "ab"))
    return found.where(fits).select(F.lit("buildsOn").alias("type"), F.col("b.id").alias("src"), F.col("a.id").alias("dst"))


def builds_on_count(elements: DataFrame, has_mechanic: DataFrame) -> DataFrame:
    """One row with the number of buildsOn edges, ``n``, without listing them."""
    return _prerequisites(elements, has_mechanic).agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("n"))


def derived_variations(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and variationOf edges of ``derivedElements``."""
    rows = elements.select("id", "lang", "ord", F.posexplode("derivedElements").alias("i", "d"))
    rows = rows.withColumn("nid", derived_id(F.col("id"), F.col("d.name")))
    nodes = rows.select(F.col("nid").alias("id"), F.lit("Element").alias("type"), F.col("d.name").alias("label"), F.col("d.description").alias("description"), "lang", "ord")
    edges = rows.select(F.lit("variationOf").alias("type"), F.col("nid").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("confidence"), "ord")
    return nodes, edges


def override_edges(edges: DataFrame, overrides: DataFrame, hashes: DataFrame) -> DataFrame:
    """Edges without the removed and with the added ones.

    Understands remove_edge/add_edge (edgeType, elementId, targetId) and
    remove_/add_ requires, buildsOn and variationOf. Adds are applied last, so they
    win over removes of the same key, and may name nodes that do not exist. One
    whose content hash differs from the element's is stale.
    """
    kind = F.when(F.col("type").endswith("_edge"), F.col("edgeType")).otherwise(F.regexp_replace("type", "^(add|remove)_", ""))
    source = F.coalesce("elementId", "fromElementId")
    target = F.coalesce("targetId", "toElementId", F.when(F.col("requirementLabel").isNotNull(), node_id("requirement", F.col("requirementLabel"))))
    rows = overrides.where(F.col("type").rlike("^(add|remove)_(edge|requires|buildsOn|variationOf)$")).select("ord", F.col("type").startswith("add_").alias("add"), kind.alias("type"), source.alias("src"), target.alias("dst"), "contentHash")
    now = hashes.select(F.col("id").alias("src"), "content_hash")
    rows = rows.join(now, "src", "left").where("contentHash IS NULL OR content_hash IS NULL OR contentHash = content_hash")
    key = ["type", "src", "dst"]
    kept = edges.join(rows.where("NOT add").select(*key), key, "left_anti")
    added = rows.where("add").select(*key, F.lit(1.0).alias("confidence"), (F.lit(1 << 50) + F.col("ord")).alias("ord"))
    return first_of_each(kept.select(*key, "confidence", "ord").unionByName(added), key)


def graph_meta(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counters: nodes by type and edges by type."""
    node_counts = nodes.agg(F.count("*").alias("nodeCount"), *(F.count_if(F.col("type") == t).alias(f"n_{t}") for t in ("Element", "Mechanic", "Skill", "Tag", "Source", "Requirement")))
    edge_counts = edges.agg(F.count("*").alias("edgeCount"), *(F.count_if(F.col("type") == t).alias(f"e_{t}") for t in EDGE_TYPES))
    return node_counts.join(F.broadcast(edge_counts))


def flatten_normalized(elements: DataFrame) -> DataFrame:
    """Normalised elements as the flat rows the other operators take."""
    n, p = "normalized", "normalized.practical"
    names = lambda c: F.coalesce(F.transform(f"{n}.{c}", lambda x: x["name"]), F.array().cast("array<string>"))
    return elements.select(
        F.col("identifier").alias("id"), F.col("name").alias("label"), F.col("sourceName").alias("source"), "url", F.col("languageCode").alias("lang"),
        F.col(f"{n}.description").alias("description"), element_summary(F.col(f"{n}.summary"), F.col(f"{n}.description")).alias("summary"), F.col(f"{n}.howToPlay.steps").alias("steps"),
        names("mechanics").alias("mechanics"), names("skills").alias("skills"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.col(f"{p}.difficulty").alias("difficulty"), F.col(f"{p}.typicalDurationMinutes").alias("minutes"), F.col(f"{p}.energyLevel").alias("energy"),
        F.col(f"{p}.groupSize.min").alias("gmin"), F.col(f"{p}.groupSize.max").alias("gmax"), F.col("playerCountMin").alias("pmin"), F.col("playerCountMax").alias("pmax"),
        F.col("translationLinkEnIdentifier").alias("link_en"), F.col("translationLinkDeIdentifier").alias("link_de"), F.col(f"{n}.contentHash").alias("content_hash"), "derivedElements", F.col("relatedIdentifiers").alias("related"), "ord",
    )


class Graph:
    """The whole derivation over flat elements (see ``flatten_normalized``). What is not asked for is not derived."""

    def __init__(self, elements: DataFrame, vocabulary: DataFrame, overrides: DataFrame | None = None):
        self.spark, self._vocabulary, self._overrides = elements.sparkSession, vocabulary, overrides
        self._rows = elements = materialize(elements, "elements")
        matches = elements.select(F.col("id").alias("a"), F.explode("related").alias("r")).select("a", F.col("r.identifier").alias("b"), F.col("r.confidence").alias("confidence"))
        self._hashes = elements.select("id", "content_hash")
        if overrides is not None:
            matches = symmetric(apply_match_overrides(matches, overrides, self._hashes))
        self._links = materialize(clusters.cluster_links(elements, matches), "links")
        self._member = materialize(clusters.one_per_source(elements, clusters.members(elements, self._links), self._links), "members")
        self._canonicals = materialize(clusters.merge_canonicals(elements, self._member), "canonicals")

    @cached_property
    def _wide(self) -> DataFrame:
        """Elements and canonicals."""
        shown = ["id", "label", "lang", "difficulty", "minutes", "energy", "pmin", "pmax", "gmin", "gmax", "summary", "description", "steps", "mechanics", "skills", "tags"]
        later = F.lit(1 << 48) + F.col("ord")
        return self._rows.select(*shown, "source", F.lit(False).alias("canonical"), "ord").unionByName(self._canonicals.select(*shown, F.lit(None).cast("string").alias("source"), "canonical", later.alias("ord")))

    @cached_property
    def elements(self) -> DataFrame:
        variations, _ = derived_variations(self._rows)
        return self._wide.unionByName(variations.select("id", "label", "lang", "description", F.lit(False).alias("canonical"), "ord"), allowMissingColumns=True)

    @cached_property
    def _terms(self) -> DataFrame:
        parts = [self._wide.select("id", "ord", F.lit(column).alias("kind"), F.posexplode(column).alias("i", "term")) for column, *_ in TERM_EDGES]
        return materialize(resolve_terms(parts[0].unionByName(parts[1]).unionByName(parts[2]), term_map(self._vocabulary)).withColumn("ord", F.col("ord") * 1024 + F.col("i")), "terms")

    @cached_property
    def _needed(self) -> DataFrame:
        kinds = F.when(F.col("kind") == "mechanics", "mechanic").when(F.col("kind") == "tags", "tag")
        return requirements(self._terms.where("kind <> 'skills'").select("id", kinds.alias("kind"), "term"), requirement_rules(self.spark)).join(self._wide.select("id", "ord"), "id")

    @cached_property
    def _has_mechanic(self) -> DataFrame:
        """Of elements alone, not of canonicals."""
        found = self._terms.where("kind = 'mechanics'").select(F.col("id").alias("src"), node_id("mechanic", F.col("term")).alias("dst"))
        return found.join(self._rows.select(F.col("id").alias("src")), "src", "left_semi")

    @cached_property
    def _ids_differ(self) -> bool:
        return self._rows.groupBy("id").count().where("count > 1").limit(1).count() == 0

    @cached_property
    def nodes(self) -> DataFrame:
        elements, terms = self._rows, self._terms
        found = self.elements.select("id", F.lit("Element").alias("type"), "label", "ord")
        found = found.unionByName(elements.where("source IS NOT NULL").select(node_id("source", F.col("source")).alias("id"), F.lit("Source").alias("type"), F.col("source").alias("label"), "ord"))
        for column, _, prefix, node_type in TERM_EDGES:
            found = found.unionByName(terms.where(F.col("kind") == column).select(node_id(prefix, F.col("term")).alias("id"), F.lit(node_type).alias("type"), F.col("term").alias("label"), "ord"))
        found = found.unionByName(self._needed.select(node_id("requirement", F.col("requirement")).alias("id"), F.lit("Requirement").alias("type"), F.col("requirement").alias("label"), "ord"))
        return materialize(first_of_each(found, ["id"]), "nodes")

    def _listed(self, types: tuple[str, ...]) -> DataFrame:
        """Edges of some types but buildsOn, the first of each key."""
        elements, none = self._rows, F.lit(None).cast("double").alias("confidence")
        links = elements.select("id", "ord", F.explode(F.array("link_en", "link_de")).alias("dst")).where("dst IS NOT NULL")
        makers = [
            ("sourcedFrom", lambda: elements.select(F.lit("sourcedFrom").alias("type"), F.col("id").alias("src"), node_id("source", F.col("source")).alias("dst"), none, "ord")),
            ("variationOf", lambda: derived_variations(elements)[1]),
            ("canonicalOf", lambda: clusters.canonical_edges(elements, self._member, self._links, self._canonicals)),
            ("translationOf", lambda: clusters.canonical_translations(self._canonicals)),
            ("translationOf", lambda: links.select(F.lit("translationOf").alias("type"), F.col("id").alias("src"), "dst", F.lit(1.0).alias("confidence"), "ord")),
            ("requires", lambda: self._needed.select(F.lit("requires").alias("type"), F.col("id").alias("src"), node_id("requirement", F.col("requirement")).alias("dst"), none, "ord")),
        ]
        for column, edge_type, prefix, _ in TERM_EDGES:
            makers.append((edge_type, lambda column=column, edge_type=edge_type, prefix=prefix: self._terms.where(F.col("kind") == column).select(F.lit(edge_type).alias("type"), F.col("id").alias("src"), node_id(prefix, F.col("term")).alias("dst"), none, "ord")))
        parts = [make() for edge_type, make in makers if edge_type in types]
        found = parts[0]
        for more in parts[1:]:
            found = found.unionByName(more)
        return first_of_each(found, ["type", "src", "dst"])

    @cached_property
    def _plain(self) -> DataFrame:
        return materialize(self._listed(EDGE_TYPES), "edges")

    @cached_property
    def _derived(self) -> DataFrame:
        """All edges before overrides. Pairs of elements with different ids are listed once, so buildsOn needs no aggregate."""
        found = builds_on(self._rows, self._has_mechanic)
        found = (found if self._ids_differ else found.distinct()).select("type", "src", "dst", F.lit(None).cast("double").alias("confidence"), F.lit(1 << 49).alias("ord"))
        return self._plain.unionByName(found)

    @cached_property
    def edges(self) -> DataFrame:
        return self._derived if self._overrides is None else materialize(override_edges(self._derived, self._overrides, self._hashes), "edges")

    def edges_of(self, *types: str) -> DataFrame:
        """Edges of some types, of which buildsOn is none; without overrides the others are not derived."""
        return self.edges.where(F.col("type").isin(*types)) if self._overrides is not None else self._listed(types)

    @cached_property
    def meta(self) -> DataFrame:
        if self._overrides is None and self._ids_differ:
            counted = builds_on_count(self._rows, self._has_mechanic).select(F.col("n").alias("more"))
            found = graph_meta(self.nodes, self._plain).join(F.broadcast(counted))
            return found.withColumns({"edgeCount": F.col("edgeCount") + F.col("more"), "e_buildsOn": F.col("e_buildsOn") + F.col("more")}).drop("more")
        found = graph_meta(self.nodes, self._derived)
        if self._overrides is None:
            return found
        return found.drop("edgeCount").join(F.broadcast(self.edges.agg(F.count("*").alias("edgeCount"))))


def derive_graph(elements: DataFrame, vocabulary: DataFrame, overrides: DataFrame | None = None) -> Graph:
    """The whole derivation over flat elements (see ``flatten_normalized``)."""
    return Graph(elements, vocabulary, overrides)
