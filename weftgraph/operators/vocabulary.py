"""Terms of elements: counts, filler report, clustering to canonical terms, rewriting."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_english, levenshtein_ratio, normalize_term, term_tokens
from ..plans.lineage import materialize
from .components import connected_components

JACCARD = 0.5
LEVENSHTEIN = 0.6
SHORT_TERM = 15
GREAT = 0.9


def term_rows(elements: DataFrame) -> DataFrame:
    """``(id, kind, term, category, ord)`` of mechanics and skills (arrays of name, category structs)."""
    parts = [elements.select("id", "ord", F.lit(k).alias("kind"), F.posexplode(k).alias("i", "t")) for k in ("mechanics", "skills")]
    return parts[0].unionByName(parts[1]).select("id", "kind", F.col("t.name").alias("term"), F.col("t.category").alias("category"), (F.col("ord") * 1024 + F.col("i")).alias("ord"))


def collect_terms(terms: DataFrame) -> DataFrame:
    return terms.where("term IS NOT NULL AND term <> ''").select("kind", "term").distinct().orderBy("kind", "term")


def term_stats(terms: DataFrame) -> DataFrame:
    """Occurrences and sorted categories of each lower-case term."""
    return terms.groupBy("kind", F.lower("term").alias("term_lc")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("category")).alias("categories"), F.min("ord").alias("ord"))


def detect_fillers(terms: DataFrame, total: DataFrame, threshold: float = 0.05, least: int = 2) -> DataFrame:
    """Terms in more than a share of all elements, at least ``least`` times; occurrences count, blank names do not.

    ``total``: one row with the number of elements, ``total``.
    """
    counted = terms.withColumn("name", F.lower(F.trim("term"))).where("name <> ''").groupBy(F.col("kind").alias("field"), "name").agg(F.count("*").alias("count"))
    share = F.col("count") / F.greatest("total", F.lit(1))
    return counted.join(F.broadcast(total)).withColumn("percentage", share).where((share > threshold) & (F.col("count") >= least)).select("name", "count", "percentage", "field").orderBy(F.desc("percentage"), "field", "name")


def canonical_key(term: Column, count: Column, seeded: Column, ord_: Column) -> Column:
    """The order by which max_by picks a cluster's canonical term: seeded, frequent, several words, English, short, first."""
    return F.struct(seeded, count, term.contains(" "), is_english(term), -F.length(term), -ord_)


def term_pairs(stats: DataFrame) -> DataFrame:
    """``(kind, a, b, score)`` for terms (kind, tid, term, place) that may share a cluster, a earlier by ``place``.

    Token similarity needs a common token; edit similarity is for two short
    terms, and joined by length and a common bigram, which any two terms that
    close share unless they are of one or two letters (those join by length alone).
    """
    mech = F.col("kind") == "mechanics"
    rows = stats.select("kind", "tid", "place", normalize_term(F.col("term")).alias("norm"), F.when(mech, term_tokens(F.col("term"), True)).otherwise(term_tokens(F.col("term"), False)).alias("tokens")).where("norm <> ''")
    side = lambda s: rows.select("kind", *(F.col(c).alias(f"{c}_{s}") for c in ("tid", "place", "norm", "tokens")))
    by_token = side("a").withColumn("key", F.explode("tokens_a")).join(side("b").withColumn("key", F.explode("tokens_b")), ["kind", "key"])
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(F.concat(F.lit(""), c), i, F.lit(2))))
    edges = lambda c: F.array_union(F.array_union(grams(F.col(c)), F.array(F.concat(F.lit("^"), F.substring(c, 1, 1)))), F.array(F.concat(F.substring(c, -1, 1), F.lit("$"))))
    short = lambda s: side(s).where(F.length(f"norm_{s}") <= SHORT_TERM).withColumn("key", F.explode(edges(f"norm_{s}")))
    by_gram = short("a").join(short("b"), ["kind", "key"])
    both = by_token.unionByName(by_gram).where(F.col("place_a") < F.col("place_b")).drop("key", "place_a", "place_b").distinct()
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size(F.array_union("tokens_a", "tokens_b"))
    jac = F.when((F.size("tokens_a") > 0) & (F.size("tokens_b") > 0), common / F.greatest(union, F.lit(1))).otherwise(0.0)
    ratio = levenshtein_ratio(F.col("norm_a"), F.col("norm_b"))
    both_short = (F.length("norm_a") <= SHORT_TERM) & (F.length("norm_b") <= SHORT_TERM)
    score = F.when(jac >= JACCARD, jac).when(both_short & (ratio >= LEVENSHTEIN), ratio)
    return both.select("kind", F.col("tid_a").alias("a"), F.col("tid_b").alias("b"), score.alias("score")).where("score IS NOT NULL")


def greedy_assign(ranks: list[int], scores: dict[int, list[tuple[int, float]]]) -> dict[int, int]:
    """Terms in rank order join the cluster of their best earlier member, the first cluster of equals, else open one."""
    cluster: dict[int, int] = {}
    for r in ranks:
        best, chosen = -1.0, r
        by_cluster: dict[int, float] = {}
        for other, score in sorted(scores.get(r, ())):
            c = cluster[other]
            if by_cluster.get(c, -1.0) < GREAT:  # a cluster is left at its first great match
                by_cluster[c] = max(by_cluster.get(c, -1.0), score)
        for c in sorted(by_cluster):
            if by_cluster[c] > best:
                best, chosen = by_cluster[c], c
        cluster[r] = chosen
    return cluster


def _assigned(stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(tid, cluster)`` of every term; a cluster is the ``tid`` of the term that opened it.

    Terms that no chain of pairs connects never meet, so the sequential pass runs
    for each component of the pairs by itself; a term without pairs needs none.
    """
    found = connected_components(pairs, "a", "b").withColumnRenamed("id", "tid")
    rows = stats.join(found, "tid").select("component", "tid", F.col("place.n").alias("n"), F.col("place.ord").alias("ord"), F.col("place.term").alias("term"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("double").alias("score"))
    linked = pairs.join(found, F.col("b") == F.col("tid")).select("component", "tid", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("ord"), F.lit(None).cast("string").alias("term"), "a", "score")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["a"].isna()].sort_values(["n", "ord", "term"], kind="stable")
        names = own["tid"].tolist()
        rank = {tid: k for k, tid in enumerate(names)}
        scores: dict[int, list[tuple[int, float]]] = {}
        for tid, other, score in pdf.dropna(subset=["a"])[["tid", "a", "score"]].itertuples(index=False):
            scores.setdefault(rank[tid], []).append((rank[int(other)], score))
        chosen = greedy_assign(list(range(len(names))), scores)
        return pd.DataFrame({"tid": [names[r] for r in chosen], "cluster": [names[c] for c in chosen.values()]})

    placed = rows.unionByName(linked).groupBy("component").applyInPandas(assign, "tid long, cluster long")
    return stats.select("tid").join(placed, "tid", "left").select("tid", F.coalesce("cluster", "tid").alias("cluster"))


def cluster_terms(terms: DataFrame, seeds: DataFrame | None = None, thesaurus: DataFrame | None = None) -> DataFrame:
    """A vocabulary ``(kind, canonical, variants, parent, ord)`` for terms (kind, term, ord).

    Thesaurus clusters (kind, canonical, variants, ord) stand first, with the terms
    of theirs that occur, and take them out. The rest are scored pairwise in
    parallel and assigned in one sequential pass for each component of the scored
    pairs. ``seeds``: (kind, term_lc, canonical), terms known to be translations; a
    cluster with a seeded canonical is named by it, and ``apply_seeds`` follows.
    """
    names = terms.where("term IS NOT NULL AND term <> ''").groupBy("kind", "term").agg(F.count("*").alias("own"), F.min("ord").alias("ord"))
    frequency = names.groupBy("kind", F.lower("term").alias("term_lc")).agg(F.sum("own").alias("n"))
    names = names.withColumn("term_lc", F.lower("term")).join(frequency, ["kind", "term_lc"])
    if thesaurus is not None:
        occurring = names.select("kind", "term_lc").distinct()
        held = thesaurus.select("kind", F.explode(F.transform(F.array_union(F.array("canonical"), "variants"), F.lower)).alias("term_lc")).distinct()
        names = names.join(held, ["kind", "term_lc"], "left_anti")
    stats = materialize(names.withColumn("tid", F.monotonically_increasing_id()).withColumn("place", F.struct((-F.col("n")).alias("n"), "ord", "term")), "terms")
    pairs = materialize(term_pairs(stats), "term-pairs")
    placed = stats.join(_assigned(stats, pairs), "tid")
    seeded = F.lit(False)
    if seeds is not None:
        placed = placed.join(seeds.select("kind", F.lower("canonical").alias("term_lc")).distinct().withColumn("seeded", F.lit(True)), ["kind", "term_lc"], "left")
        seeded = F.coalesce("seeded", F.lit(False))
    grouped = placed.groupBy("kind", "cluster").agg(
        F.max_by("term", canonical_key(F.col("term"), F.col("n"), seeded, F.col("ord"))).alias("canonical"),
        F.transform(F.array_sort(F.collect_list("place")), lambda x: x["term"]).alias("all"),
        F.min("ord").alias("ord"),
    )
    out = grouped.select("kind", "canonical", F.filter("all", lambda t: F.lower(t) != F.lower("canonical")).alias("variants"), F.lit(None).cast("string").alias("parent"), "ord")
    if seeds is not None:
        out = apply_seeds(out, seeds)
    if thesaurus is not None:
        out = _thesaurus_clusters(thesaurus, occurring).unionByName(out)
    return out


def _thesaurus_clusters(thesaurus: DataFrame, occurring: DataFrame) -> DataFrame:
    """Thesaurus clusters some term of which occurs, with the variants that do."""
    each = thesaurus.select("kind", "canonical", "ord", F.posexplode(F.array_union(F.array("canonical"), "variants")).alias("i", "term")).withColumn("term_lc", F.lower("term"))
    met = each.join(occurring, ["kind", "term_lc"], "left_semi").groupBy("kind", "canonical", "ord").agg(F.array_sort(F.collect_list(F.struct("i", "term"))).alias("met"))
    variants = F.filter(F.transform("met", lambda x: x["term"]), lambda t: F.lower(t) != F.lower("canonical"))
    return met.select("kind", "canonical", variants.alias("variants"), F.lit(None).cast("string").alias("parent"), (F.col("ord") - (1 << 40)).alias("ord"))


def apply_seeds(clusters: DataFrame, seeds: DataFrame) -> DataFrame:
    """Clusters with translation seeds (kind, term_lc, canonical) merged in.

    A seed goes to the first cluster that its canonical names, where its term
    becomes a variant, or that holds its term as a variant, which is renamed:
    then the seed's canonical stands for the cluster and heads its variants in
    the term's place. A seed that fits no cluster opens one, together with the
    seeds of the same canonical. Seeds meet the clusters as they were; of several
    that rename one cluster the last term names it.
    """
    rows = materialize(clusters.withColumn("cid", F.monotonically_increasing_id()), "vocabulary")
    named = seeds.withColumn("canonical_lc", F.lower("canonical")).join(rows.select("kind", "cid", "ord", F.lower("canonical").alias("canonical_lc")), ["kind", "canonical_lc"]).select("kind", "term_lc", "canonical", F.struct("ord", "cid", F.lit(0).alias("renames")).alias("to"))
    held = rows.select("kind", "cid", "ord", F.explode(F.transform("variants", F.lower)).alias("term_lc")).distinct()
    varied = seeds.join(held, ["kind", "term_lc"]).select("kind", "term_lc", "canonical", F.struct("ord", "cid", F.lit(1).alias("renames")).alias("to"))
    goes = materialize(named.unionByName(varied).groupBy("kind", "term_lc", "canonical").agg(F.min("to").alias("to")), "seeds-placed")
    added = goes.where("to.renames = 0").groupBy(F.col("to.cid").alias("cid")).agg(F.array_sort(F.collect_set("term_lc")).alias("more"))
    renamed = goes.where("to.renames = 1").groupBy(F.col("to.cid").alias("cid")).agg(F.max_by("canonical", "term_lc").alias("new"), F.collect_set("term_lc").alias("gone"))
    both = rows.join(added, "cid", "left").join(renamed, "cid", "left")
    none = F.array().cast("array<string>")
    lower = F.transform("variants", F.lower)
    kept = F.filter("variants", lambda t: ~F.array_contains(F.coalesce("gone", none), F.lower(t)) & ~F.lower(t).eqNullSafe(F.lower("new")))
    variants = F.concat(F.when(F.col("new").isNotNull(), F.concat(F.array("new"), kept)).otherwise(F.col("variants")), F.array_except(F.coalesce("more", none), lower))
    out = both.select("kind", F.coalesce("new", "canonical").alias("canonical"), variants.alias("variants"), "parent", "ord")
    left = seeds.join(goes.select("kind", "term_lc", "canonical"), ["kind", "term_lc", "canonical"], "left_anti")
    opened = left.groupBy("kind", F.lower("canonical").alias("_lc")).agg(F.min("canonical").alias("canonical"), F.array_sort(F.collect_set("term_lc")).alias("variants"))
    return out.unionByName(opened.select("kind", "canonical", "variants", F.lit(None).cast("string").alias("parent"), F.lit(1 << 40).alias("ord")))


def translation_term_seeds(elements: DataFrame) -> DataFrame:
    """``(kind, term_lc, canonical)``: German elements linked to an English one, each with exactly one mechanic (skill), same category, different name."""
    de = elements.where("lang = 'de' AND link_en IS NOT NULL")
    en = elements.where("lang = 'en'").select(F.col("id").alias("link_en"), *(F.col(k).alias(f"en_{k}") for k in ("mechanics", "skills")))
    pairs = de.join(en, "link_en")
    parts = []
    for k in ("mechanics", "skills"):
        one, other = F.col(k)[0], F.col(f"en_{k}")[0]
        rows = pairs.where((F.size(k) == 1) & (F.size(f"en_{k}") == 1)).select(F.lit(k).alias("kind"), one.alias("de"), other.alias("en"), "ord")
        parts.append(rows.where("de.category <=> en.category AND lower(de.name) <> lower(en.name)"))
    return parts[0].unionByName(parts[1]).groupBy("kind", F.lower("de.name").alias("term_lc")).agg(F.max_by(F.col("en.name"), "ord").alias("canonical"))


def coverage(vocabulary: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct terms of each kind and how many the vocabulary names."""
    from .graph import term_map

    named = terms.select("kind", F.lower("term").alias("term_lc")).distinct().join(term_map(vocabulary), ["kind", "term_lc"], "left")
    return named.groupBy("kind").agg(F.count("*").alias("terms"), F.count("canonical").alias("named"))


def apply_canonical_terms(elements: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rewrite mechanics and skills (arrays of name, originalName, category) to canonical names.

    A rewritten term keeps its old name in ``originalName``; one that is already
    canonical loses an earlier ``originalName``; a term the vocabulary does not
    know stays as it is.
    """
    from .graph import term_map

    mapping = term_map(vocabulary)
    out = elements
    for kind in ("mechanics", "skills"):
        rows = elements.select("id", F.posexplode(kind).alias("i", "t")).withColumn("term_lc", F.lower("t.name"))
        known = rows.join(mapping.where(F.col("kind") == kind).drop("kind"), "term_lc", "left")
        changed = F.col("canonical") != F.col("t.name")
        put = F.struct(
            F.coalesce("canonical", "t.name").alias("name"),
            F.when(changed, F.col("t.name")).when(F.col("canonical").isNull(), F.col("t.originalName")).alias("originalName"),
            F.col("t.category").alias("category"),
        )
        lists = known.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", put.alias("t")))), lambda x: x["t"]).alias("_new"))
        out = out.join(lists, "id", "left").withColumn(kind, F.coalesce("_new", kind)).drop("_new")
    return out


def unchanged_iterator(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A matcher or extractor that changes nothing; the default hook."""
    yield from batches
