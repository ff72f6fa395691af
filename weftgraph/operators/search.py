"""Keyword search with ranking, a retry without the least useful word, and suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import whole_word

#: Fixed values.
STOP_WORDS = ("a", "the", "is", "of", "in", "and", "to", "for", "with", "on")
SUGGESTIONS = ("storytelling", "status", "characters", "rhyming", "singing", "active listening", "physicality", "emotions", "scene work", "spontaneity")
WEIGHTS = {"label": 10, "summary": 5, "mechanics": 4, "skills": 4, "tags": 3}
FEW_RESULTS = 5


def query_words(query: str) -> list[str]:
    """Words in order; repeats stay and count twice."""
    return [w for w in query.lower().split() if w not in STOP_WORDS]


def _score(words: list[str]) -> F.Column:
    total = F.lit(0)
    for w in words:
        for name in ("label", "summary"):
            total += F.when(whole_word(F.col(name), w), WEIGHTS[name]).otherwise(0)
        for name in ("mechanics", "skills", "tags"):
            total += WEIGHTS[name] * _matching(F.col(name), w)
    return total


def _matching(labels: F.Column, word: str) -> F.Column:
    return F.size(F.filter(labels, lambda x: whole_word(x, word)))


def rank(rows: DataFrame, words: list[str]) -> DataFrame:
    """Rows that match, with their score. Words are literals, so this is one pass without a join."""
    return rows.withColumn("score", _score(words)).where("score > 0")


def search_elements(rows: DataFrame, query: str, canonical_only: bool = True, language: str = "en", limit: int = 50) -> DataFrame:
    """The best matches of rows with (label, summary, mechanics, skills, tags, lang, canonical, ord).

    If fewer than five rows match a query of several words, the word that occurs
    in the fewest labels of all rows is dropped, and the shorter query is used if
    it matches more. The counts are the only thing that reaches the driver.
    """
    candidates = rows.where((F.col("canonical") if canonical_only else F.lit(True)) & (F.col("lang") == (language or "en")))
    words = query_words(query)
    if not words:
        return rank(candidates, []).limit(0)
    found = rank(candidates, words)
    if len(words) > 1:
        n = found.count()
        if n < FEW_RESULTS:
            kept = without_rarest(rows, words)
            if kept:
                shorter = rank(candidates, kept)
                if shorter.count() > n:
                    found = shorter
    return found.orderBy(F.desc("score"), "ord").limit(limit)


def word_matches(rows: DataFrame, words: list[str]) -> DataFrame:
    """``(word, n)``: labels of mechanics, skills and tags of all rows that hold each word, one count for each occurrence."""
    labels = F.concat("mechanics", "skills", "tags")
    counted = rows.agg(*(F.sum(_matching(labels, w)).cast("long").alias(f"w{i}") for i, w in enumerate(words)))
    pairs = ", ".join(f"struct({i} as at, w{i} as n)" for i in range(len(words)))
    by_word = counted.select(F.explode(F.expr(f"array({pairs})")).alias("p")).select("p.*")
    names = F.array(*map(F.lit, words))
    return by_word.select("at", F.element_at(names, F.col("at") + 1).alias("word"), F.coalesce("n", F.lit(0)).alias("n"))


def without_rarest(rows: DataFrame, words: list[str]) -> list[str]:
    """The words without every copy of the first of those that match fewest labels."""
    counts = word_matches(rows, words).collect()  # one row for each word of the query
    least = min(counts, key=lambda r: (r["n"], r["at"]))["word"]
    return [w for w in words if w != least]


def suggestions(matched_labels: list[str], most: int = 5) -> list[str]:
    """Curated queries that are not among the matched concepts."""
    have = {x.lower() for x in matched_labels}
    return [s for s in SUGGESTIONS if s not in have][:most]


def matched_concepts(nodes: DataFrame, words: list[str]) -> DataFrame:
    """Mechanic, skill and tag nodes that a word of the query matches, distinct by lower label."""
    hit = F.lit(False)
    for w in words:
        hit |= whole_word(F.col("label"), w)
    found = nodes.where(F.col("type").isin("Mechanic", "Skill", "Tag") & hit)
    return merge_concepts(found)


def merge_concepts(concepts: DataFrame) -> DataFrame:
    """Concepts distinct by lower label: the last label, at the first one's place."""
    return concepts.groupBy(F.lower("label").alias("key")).agg(F.max_by("label", "ord").alias("label"), F.min("ord").alias("ord"))
