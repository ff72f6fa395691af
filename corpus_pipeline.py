"""Corpus pipeline: documents go through stages that each apply one training-data operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import decontaminate, langid, near_copies, pieces, surrogates
from weftgraph.llm.common import table
from weftgraph.plans.lineage import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told.

    A text that is null, empty or without a letter is rejected; a very long one is
    scored whole; of languages that tie the first in the alphabet is taken;
    repeated rows stay repeated. Extra columns stay, but for ``lang_pred`` and
    ``lang_score``. Where nothing can be learned all rows are rejected.
    """
    model = langid.train_on_documents(docs)
    return langid.identify(docs, model).where(f"lang_pred <> '{langid.UNDETERMINED}'").drop("lang_pred", "lang_score")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that with the smallest doc_id.

    Null, empty and blank texts are one group; equal texts, however long, are one
    group; rows repeated under one doc_id count once. All columns stay.
    """
    return near_copies.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark text: a whole window of eight words, or windows of two items.

    A lone match of an item shorter than a window is common speech and stays, as
    do null and empty texts. Texts are read whole, however long; repeated rows
    stay or go together; all columns stay.
    """
    return decontaminate.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put surrogates in place of personal data; n_chars follows the text.

    Null and empty texts stay as they are; entities and texts may have any length;
    equal entities get equal surrogates in all rows, repeated rows too. Extra
    columns stay, but for ``pii_kinds``.
    """
    found = surrogates.replace_pii(docs)
    length = F.when(F.size("pii_kinds") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).drop("pii_kinds")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text; ``text`` is the ids decoded again, ``piece_ids`` the ids and ``n_tokens`` their number.

    A null or empty text has no ids and an empty text; texts may have any length;
    repeated rows stay repeated. Columns named ``piece_ids``, ``piece_text`` and
    ``n_tokens`` are replaced, all others stay.
    """
    found = pieces.encode_decode(docs, pieces.model_path())
    return found.withColumn("text", F.col("piece_text")).withColumn("n_tokens", F.size("piece_ids").cast("long")).drop("piece_text")


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("sentencepiece", sentencepiece),
]
#: The language model, the fingerprints and the codec are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
