"""Column expressions for names, terms and identifiers; all run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``\b`` between ASCII word characters only, whatever the engine's own notion of a word is.
ASCII_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
#: Endings that say what kind of element a name is.
TYPE_SUFFIX = r"(?iu)-(?:exercise|game|variation|handle|übung|spiel|show|format)$"


# ---- identifiers ----------------------------------------------------------


def element_id(name: Column, url: Column) -> Column:
    return F.md5(F.concat(F.lit("element;"), name, F.lit(";"), url))


def split_child_id(parent_id: Column, name: Column) -> Column:
    return F.md5(F.concat(parent_id, name))


def node_id(prefix: str | Column, name: Column) -> Column:
    """Labels that differ by case only share a node."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.md5(F.concat(prefix, F.lit(":"), F.lower(name)))


def cluster_id(member_ids: Column) -> Column:
    return F.md5(F.array_join(F.array_sort(F.array_distinct(member_ids)), ","))


def canonical_id(language: Column, cluster: Column) -> Column:
    return F.md5(F.concat(F.lit("canonical:"), language, F.lit(":"), cluster))


def derived_id(parent_id: Column, name: Column) -> Column:
    return F.md5(F.concat(F.lit("derived:"), parent_id, F.lit(":"), name))


# ---- normalisation and tokens ---------------------------------------------


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_name(name: Column) -> Column:
    """Lower case, without parentheses and without "the" at the very start."""
    plain = F.regexp_replace(F.lower(name), r"\s*\([^)]*\)\s*", " ")
    return collapse(F.regexp_replace(plain, r"^the\s+", ""))


def normalize_term(term: Column) -> Column:
    spaced = F.regexp_replace(F.lower(term), "[-/]", " ")
    return collapse(F.regexp_replace(spaced, "[^a-z0-9 äöüß]", ""))


def name_tokens(name: Column) -> Column:
    return F.filter(F.split(F.lower(name), r"[\s\-—–,.;:!?()]+"), lambda w: F.length(w) > 0)


def term_tokens(term: Column, mechanics: bool) -> Column:
    """Tokens of a normalised term; the generic word "constraint" says nothing about a mechanic."""
    words = F.filter(F.split(normalize_term(term), " "), lambda w: F.length(w) > 0)
    return F.array_distinct(F.array_except(words, F.array(F.lit("constraint"))) if mechanics else words)


def is_english(term: Column) -> Column:
    return ~F.lower(term).rlike("[äöüß]")


# ---- similarity -----------------------------------------------------------


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / F.greatest(longest, F.lit(1)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays taken as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def token_jaccard(a: Column, b: Column) -> Column:
    """0 if either side is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(jaccard(a, b))


def shares_words(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Strictly more similar than the threshold."""
    return token_jaccard(name_tokens(a), name_tokens(b)) > threshold


def valid_substring(a: Column, b: Column) -> Column:
    """One name holds the other; both have over 3 characters and the shorter has several words."""
    shorter = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    return (F.length(a) > 3) & (F.length(b) > 3) & (a.contains(b) | b.contains(a)) & (F.instr(shorter, " ") > 0)


def round_half_up(x: Column, digits: int = 0) -> Column:
    scale = 10**digits
    return F.floor(x * scale + 0.5) / scale


# ---- search and display ---------------------------------------------------


def whole_word(text: Column, word: str) -> Column:
    """Case-insensitive match of a literal word between ASCII word edges."""
    literal = re.sub(r"[.*+?^${}()|\[\]\\]", lambda m: "\\" + m.group(), word)
    return text.rlike(f"(?iu){ASCII_EDGE}{literal}{ASCII_EDGE}")


def truncate(text: Column, length: int) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def escape_html(text: Column) -> Column:
    for raw, named in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(named))
    return text


def confidence_band(score: Column) -> Column:
    return F.when(score >= 0.95, ">=0.95").when(score >= 0.85, ">=0.85").when(score >= 0.75, ">=0.75").otherwise("<0.75")


def clean_title(title: Column) -> Column:
    return F.trim(F.replace(title, F.lit("#"), F.lit("")))


def language_of_url(url: Column) -> Column:
    return F.when(url.contains("/en/"), "en").otherwise("de")


def split_tags(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, ","), lambda t: F.trim(t)), lambda t: F.length(t) > 0)


def player_range(value: Column) -> Column:
    """``{min, max}`` of "4 to 12" or "4 bis 12"; null ends where there is none."""
    pattern = r"(\d+)\s+(?:bis|to)\s+(\d+)"
    ends = [F.regexp_extract(value, pattern, k).try_cast("int") for k in (1, 2)]
    return F.struct(ends[0].alias("min"), ends[1].alias("max"))


def last_update(text: Column) -> Column:
    """The first dd.MM.yyyy date in a text, as text."""
    return F.nullif(F.regexp_extract(text, r"\d{1,2}\.\d{1,2}\.\d{4}", 0), F.lit(""))


def wiki_modified(text: Column) -> Column:
    """ISO text of "on D Month YYYY, at HH:MM" (UTC); null where there is none."""
    found = F.regexp_extract(text, r"on (\d{1,2} [A-Z][a-z]+ \d{4}), at (\d{2}:\d{2})", 0)
    plain = F.regexp_replace(found, "^on |, at", "")
    return F.date_format(F.try_to_timestamp(F.nullif(plain, F.lit("")), F.lit("d MMMM yyyy HH:mm")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


#: What is removed from or replaced in scraped Markdown, in this order.
MARKDOWN_PASSES = (
    (r"<!--(?s:.*?)-->", ""),
    (r"(?m)^\[edit]\(.*/edit\)(\r?\n\r?\n)?", ""),
    (r"(?m)^#{2,3} Filmbeispiel[^#]*", ""),
    (r"(?m)^_?[Ss]iehe [Aa]uch_?.*$", ""),
    (r" \(_?[Ss]iehe [Aa]uch_?.*?(\(.*?\)).*?\)", ""),
    (r"(?m)^#{2,3} [Ss]iehe [Aa]uch[^#]*", ""),
    (r"(?m)^#{2,3} Verwandt[^#]*", ""),
    (r"\[(.*?)]\(.*?\)", "$1"),
    (r"(?im)^#{2,3} (?:Inhaltsverzeichnis|Table of Contents)(?s:.*?)^[^#]*", "\n"),
)


def clean_markdown(markdown: Column) -> Column:
    out = F.trim(markdown)
    for pattern, put in MARKDOWN_PASSES:
        out = F.regexp_replace(out, pattern, put)
    return out


def markdown_changed(markdown: Column) -> Column:
    """Whether cleaning changes a text; blanks at its ends alone count as no change."""
    return F.coalesce(clean_markdown(markdown) != F.trim(markdown), F.lit(False))


def suitable_for(difficulty: Column, minutes: Column, energy: Column) -> Column:
    """What an element suits: the first rule that holds. Missing minutes count as 10, missing energy as medium."""
    minutes, energy = F.coalesce(minutes, F.lit(10)), F.coalesce(energy, F.lit("medium"))
    return (
        F.when((energy == "high") & (minutes <= 5), "encore")
        .when((difficulty == "beginner") & (minutes <= 10) & energy.isin("medium", "high"), "warmup")
        .when(difficulty.isin("intermediate", "advanced") & (minutes >= 15), "performance")
        .otherwise("exercise")
    )


def difficulty_rank(difficulty: Column) -> Column:
    return F.when(difficulty == "intermediate", 1).when(difficulty == "advanced", 2).otherwise(0)


def energy_rank(energy: Column) -> Column:
    return F.when(energy == "high", 0).when(energy == "low", 2).otherwise(1)
