"""Training-data operators: one module each, with its query and, where there is one, its SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "warc",
    "pieces",
    "decontaminate",
    "embedding_links",
    "surrogates",
    "suffix_spans",
    "simhash",
    "langid",
    "html_text",
    "shuffle_shards",
)


def queries() -> dict:
    """Query name -> function of (spark, sf_dir)."""
    return {name: f for m in MODULES for name, f in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict:
    """Query name -> DuckDB SQL, for those that SQL can express."""
    return {name: sql for m in MODULES for name, sql in import_module(f"{__name__}.{m}").ORACLE_SQL.items()}
