"""Lookups over elements, nodes and edges.

``elements``: id, label, lang, difficulty, minutes, energy, canonical, pmin, pmax, ord (and whatever else there is).
``edges``: type, src, dst, confidence, ord. ``nodes``: id, type, label, ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_TYPES = {"hasMechanic": "mechanics", "trainsSkill": "skills", "hasTag": "tags"}
MOST_A_PAGE = 100


# ---- filters --------------------------------------------------------------


def scalar_filter(canonical: bool | None = True, language: str | None = "en", difficulty: str | None = None, min_players: int | None = None, max_players: int | None = None, min_duration: int | None = None, max_duration: int | None = None) -> Column:
    """The conjunction of the scalar filters; unknown bounds of an element pass, written so that they reach the scan."""
    col, ok = F.col, F.lit(True)
    if canonical is not False:
        ok &= col("canonical")
    ok &= col("lang") == (language or "en")
    if difficulty:
        ok &= col("difficulty") == difficulty
    if min_players is not None:
        ok &= (col("pmax").isNull() | (col("pmax") >= min_players)) & (col("pmin").isNull() | (col("pmin") <= min_players))
    if max_players is not None:
        ok &= col("pmin").isNull() | (col("pmin") <= max_players)
    if min_duration is not None:
        ok &= col("minutes").isNull() | (col("minutes") >= min_duration)
    if max_duration is not None:
        ok &= col("minutes").isNull() | (col("minutes") <= max_duration)
    return ok


def fits_players(n: int) -> Column:
    """Both bounds unknown, or n between them with an unknown end open."""
    return (F.col("pmin").isNull() | (F.col("pmin") <= n)) & (F.col("pmax").isNull() | (F.col("pmax") >= n))


def linked_to(edges: DataFrame, nodes: DataFrame, edge_type: str, labels: list[str]) -> DataFrame:
    """``(src, dst)`` of edges to nodes with one of the labels, case-insensitively."""
    wanted = nodes.where(F.lower("label").isin([x.lower() for x in labels])).select(F.col("id").alias("dst"))
    return edges.where(F.col("type") == edge_type).join(wanted, "dst", "left_semi").select("src", "dst")


def with_label(elements: DataFrame, edges: DataFrame, nodes: DataFrame, edge_type: str, label: str) -> DataFrame:
    """Semi join: elements with an edge to the label; an unknown label leaves none."""
    return elements.join(linked_to(edges, nodes, edge_type, [label]), elements["id"] == F.col("src"), "left_semi")


def without_requirements(elements: DataFrame, edges: DataFrame, nodes: DataFrame, labels: list[str]) -> DataFrame:
    """Anti join: elements with none of the requirements; unknown labels exclude nothing."""
    return elements.join(linked_to(edges, nodes, "requires", labels), elements["id"] == F.col("src"), "left_anti")


def with_all_requirements(elements: DataFrame, edges: DataFrame, nodes: DataFrame, labels: list[str]) -> DataFrame:
    """Relational division: elements with every known one of the requirements; all unknown filters nothing."""
    wanted = nodes.where((F.col("type") == "Requirement") & F.lower("label").isin([x.lower() for x in labels])).select(F.col("id").alias("dst"))
    have = edges.where("type = 'requires'").join(wanted, "dst", "left_semi").groupBy("src").agg(F.countDistinct("dst").alias("have"))
    need = wanted.agg(F.countDistinct("dst").alias("need"))
    return elements.join(have, elements["id"] == have["src"], "left").join(F.broadcast(need)).where(F.coalesce("have", F.lit(0)) >= F.col("need")).drop("src", "have", "need")


def filter_elements(elements: DataFrame, edges: DataFrame, nodes: DataFrame, *, tag: str | None = None, mechanic: str | None = None, skill: str | None = None, exclude_requirements: list[str] | None = None, require_requirements: list[str] | None = None, **scalars) -> DataFrame:
    """All filters of the element query as one plan."""
    out = elements.where(scalar_filter(**scalars))
    for edge_type, label in (("hasTag", tag), ("hasMechanic", mechanic), ("trainsSkill", skill)):
        if label:
            out = with_label(out, edges, nodes, edge_type, label)
    if exclude_requirements:
        out = without_requirements(out, edges, nodes, exclude_requirements)
    if require_requirements:
        out = with_all_requirements(out, edges, nodes, require_requirements)
    return out


# ---- labels, pages, details -----------------------------------------------


def label_arrays(elements: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add mechanics, skills and tags of each element, in edge order. Join late: only the rows of ``elements`` are looked up."""
    wanted = edges.where(F.col("type").isin(*LABEL_TYPES)).join(elements.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    named = wanted.join(nodes.select(F.col("id").alias("dst"), "label"), "dst")
    lists = named.groupBy(F.col("src").alias("id")).agg(
        *(F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == t, F.struct(named["ord"], named["label"])))), lambda x: x["label"]).alias(name) for t, name in LABEL_TYPES.items())
    )
    out = elements.join(lists, "id", "left")
    return out.withColumns({name: F.coalesce(name, F.array().cast("array<string>")) for name in LABEL_TYPES.values()})


def paginate(rows: DataFrame, page: int | None = 1, limit: int | None = 20, most: int = MOST_A_PAGE) -> tuple[DataFrame, DataFrame]:
    """One page in ``ord`` order and the total as a one-row table; a page or limit of 0 means the default."""
    page, limit = page or 1, min(limit or 20, most)
    return rows.orderBy("ord").offset((page - 1) * limit).limit(limit), rows.agg(F.count("*").alias("total"))


def query_elements(elements: DataFrame, edges: DataFrame, nodes: DataFrame, page: int | None = 1, limit: int | None = 20, most: int = MOST_A_PAGE, **filters) -> DataFrame:
    """A page of matching elements with their labels; ``total`` counts all matches."""
    rows, total = paginate(filter_elements(elements, edges, nodes, **filters), page, limit, most)
    return label_arrays(rows, edges, nodes).join(F.broadcast(total))


def labelled_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the labels of both ends; an end that is no node shows the first 8 characters of its id."""
    ends = lambda side: nodes.select(F.col("id").alias(side), F.col("label").alias(f"{side}_label"))
    out = edges.join(ends("src"), "src", "left").join(ends("dst"), "dst", "left")
    return out.withColumns({f"{s}_label": F.coalesce(f"{s}_label", F.substring(F.col(s).cast("string"), 1, 8)) for s in ("src", "dst")})


def element_detail(edges: DataFrame, nodes: DataFrame, element_id) -> DataFrame:
    """All edges of one element: type, direction, the other end and its label, in order."""
    out = edges.where(F.col("src") == element_id).select("type", F.lit("out").alias("direction"), F.col("dst").alias("other"), "confidence", "ord")
    into = edges.where(F.col("dst") == element_id).select("type", F.lit("in").alias("direction"), F.col("src").alias("other"), "confidence", "ord")
    both = out.unionByName(into)
    return both.join(nodes.select(F.col("id").alias("other"), "label"), "other", "left").withColumn("label", F.coalesce("label", F.substring(F.col("other").cast("string"), 1, 8)))


def element_view(elements: DataFrame, edges: DataFrame, nodes: DataFrame, element_id, most: int = 10) -> DataFrame:
    """``(part, type, direction, other, label, score, ord)``: one element's edges, then the canonical elements most similar to it."""
    detail = element_detail(edges, nodes, element_id).select(F.lit("edge").alias("part"), "type", "direction", "other", "label", F.lit(None).cast("double").alias("score"), "ord")
    near = similar_elements(feature_pairs(edges), element_id, elements.where("canonical"), most)
    none = F.lit(None).cast("string")
    return detail.unionByName(near.select(F.lit("similar").alias("part"), none.alias("type"), none.alias("direction"), F.col("id").alias("other"), "label", "score", F.lit(None).cast("long").alias("ord")))


def find_element(elements: DataFrame, text: str) -> DataFrame:
    """The element with this id, else the first whose label holds the text."""
    rank = F.when(F.col("id").cast("string") == text, 0).when(F.lower("label").contains(text.lower()), 1)
    return elements.withColumn("_rank", rank).where("_rank IS NOT NULL").orderBy("_rank", "ord").limit(1).drop("_rank")


def one_hop(edges: DataFrame, nodes: DataFrame, node_id, most: int = 50) -> DataFrame:
    """Neighbours of a node in both directions, by label."""
    near = edges.where(F.col("src") == node_id).select(F.col("dst").alias("id")).union(edges.where(F.col("dst") == node_id).select(F.col("src").alias("id"))).distinct()
    return nodes.join(near, "id", "left_semi").orderBy("label", "id").limit(most)


def one_hop_edges(edges: DataFrame, nodes: DataFrame, node_id, most: int = 50) -> DataFrame:
    """Display edges among a node and its neighbours, those between two neighbours included."""
    shown = one_hop(edges, nodes, node_id, most).select("id").union(nodes.where(F.col("id") == node_id).select("id")).distinct()
    return display_edges(edges, shown)


def display_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends both exist, one for each (src, dst) whatever the type: the first."""
    ids = nodes.select("id")
    whole = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return whole.groupBy("src", "dst").agg(F.min_by(F.struct("type", "confidence", "ord"), "ord").alias("e")).select("src", "dst", "e.*")


def visible_nodes(nodes: DataFrame, types: list[str], text: str = "") -> DataFrame:
    shown = nodes.where(F.col("type").isin(types))
    return shown.where(F.lower("label").contains(text.strip().lower())) if text.strip() else shown


# ---- similarity -----------------------------------------------------------


def feature_pairs(edges: DataFrame, types: tuple[str, ...] = ("hasMechanic", "trainsSkill")) -> DataFrame:
    return edges.where(F.col("type").isin(*types)).select("src", "dst").distinct()


def similar_elements(features: DataFrame, element_id, candidates: DataFrame, limit: int = 10) -> DataFrame:
    """Candidates by Jaccard similarity of their features to one element's.

    Only candidates that share a feature are met, through an equi-join on it;
    the element's own features are few, so their side is the small one.
    """
    own = features.where(F.col("src") == element_id).select("dst")
    sizes = features.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"))
    shared = features.where(F.col("src") != element_id).join(own, "dst", "left_semi").groupBy(F.col("src").alias("id")).agg(F.count("*").alias("common"))
    total = own.agg(F.count("*").alias("own"))
    score = F.col("common") / (F.col("n") + F.col("own") - F.col("common"))
    scored = shared.join(sizes, "id").join(F.broadcast(total)).join(candidates.select("id", "label", "ord"), "id").withColumn("score", score)
    return scored.orderBy(F.desc("score"), "ord").limit(limit).select("id", "label", "score")


def similar_pairs(features: DataFrame, least: float) -> DataFrame:
    """All pairs a < b with Jaccard similarity of at least ``least`` (over 0), by prefix filtering.

    A pair that similar shares one of the rarest ``n - ceil(least * n) + 1``
    features of each side, so only those prefixes are joined; the pairs found are
    then counted exactly.
    """
    rarity = features.groupBy("dst").agg(F.count("*").alias("df"))
    sets = features.join(rarity, "dst").groupBy("src").agg(F.array_sort(F.collect_list(F.struct("df", "dst"))).alias("f")).select("src", F.transform("f", lambda x: x["dst"]).alias("f"))
    length = F.size("f") - F.ceil(F.lit(least) * F.size("f") - 1e-9).cast("int") + 1
    prefix = sets.select("src", "f", F.explode(F.slice("f", 1, length)).alias("token"))
    a, b = prefix.select(F.col("src").alias("a"), F.col("f").alias("fa"), "token"), prefix.select(F.col("src").alias("b"), F.col("f").alias("fb"), "token")
    sizes_fit = (F.size("fa") >= F.lit(least) * F.size("fb") - 1e-9) & (F.size("fb") >= F.lit(least) * F.size("fa") - 1e-9)
    met = a.join(b, "token").where((F.col("a") < F.col("b")) & sizes_fit)
    common = F.size(F.array_intersect("fa", "fb"))
    score = common / (F.size("fa") + F.size("fb") - common)
    return met.select("a", "b", common.cast("long").alias("common"), score.alias("score")).where(F.col("score") >= least).distinct()
