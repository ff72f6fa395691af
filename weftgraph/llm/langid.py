"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams in parallel; the log-probability matrix (languages x
hash dimensions, a size fixed by parameters) is broadcast. Whole texts are scored
in numpy, many at a time: the n-grams of a batch are the entries of a sparse
matrix (texts x dimensions), whose product with the log-probabilities is taken
entry by entry and summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extended, map_batches, table

ORDERS = (1, 2, 3)
DIMENSIONS = 1 << 16
TRAINING_ROWS = 20_000
BLOCK = 1 << 20
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray  # languages
    log_prob: np.ndarray  # languages x dimensions
    orders: tuple[int, ...]


def code_blocks(texts: list[str], reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased texts as code points, in blocks of bounded size: codes, the place in ``texts`` of each code, and how many codes follow in its text.

    Texts share blocks; a text beyond the size of a block goes on in the next,
    which repeats nothing: the last ``reach`` codes of a block are only looked at.
    """
    held: list[str] = []
    names: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        text = text.lower()
        if size and size + len(text) > BLOCK:
            yield _block(held, names, [len(t) for t in held])
            held, names, size = [], [], 0
        if len(text) > BLOCK:
            for start in range(0, len(text), BLOCK):
                yield _block([text[start : start + BLOCK + reach]], [i], [min(BLOCK, len(text) - start)])
        else:
            held.append(text)
            names.append(i)
            size += len(text)
    if size:
        yield _block(held, names, [len(t) for t in held])


def _block(held: list[str], names: list[int], own: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(t) for t in held])
    place = np.repeat(np.array(names), lengths)
    ahead = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    place[ahead <= np.repeat(lengths - np.array(own), lengths)] = -1  # no n-gram starts there in this block
    return codes, place, ahead


def ngram_entries(texts: list[str], orders: tuple[int, ...], dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sparse matrix of hashed character n-grams: rows (places in ``texts``, in order) and columns, in blocks of bounded size."""
    for codes, place, ahead in code_blocks(texts, max(orders) - 1):
        hashed = np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, max(orders) + 1):
            hashed = hashed[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
            if n in orders:
                mixed = (hashed ^ np.uint32(n)) * np.uint32(0x9E3779B1)
                starts = (ahead[: len(hashed)] >= n) & (place[: len(hashed)] >= 0)
                yield place[: len(hashed)][starts], ((mixed >> np.uint32(8)) & np.uint32(dimensions - 1))[starts]


def _count(batches: Iterator[pa.RecordBatch], orders: tuple[int, ...], dimensions: int) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            held = counts.setdefault(lang, np.zeros(dimensions, dtype=np.int64))
            for _, columns in ngram_entries(texts, orders, dimensions):
                held += np.bincount(columns, minlength=dimensions)
    for lang, held in counts.items():
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(held[at])], ["lang", "feature", "n"])


def train(labelled: DataFrame, max_rows: int = TRAINING_ROWS, orders: tuple[int, ...] = ORDERS, dimensions: int = DIMENSIONS, key: str = "doc_id") -> Model:
    """Fit on (``key``, text, lang); rows without text or lang are left out.

    About ``max_rows`` rows are used, an equal share for each language, those
    whose hashed key and text are smallest: a bound on the training sample, documented here.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0").select(key, "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(0), np.zeros((0, dimensions)), orders)
    share = max_rows / len(sizes)
    spark = labelled.sparkSession
    fractions = spark.createDataFrame([(k, int(min(1.0, share / n) * (1 << 30))) for k, n in sizes.items()], "lang string, _most long")
    chosen = known.join(F.broadcast(fractions), "lang").where(F.pmod(F.xxhash64(key, F.crc32("text")), F.lit(1 << 30)) < F.col("_most")).select("lang", "text")
    rows = map_batches(chosen, lambda it: _count(it, orders, dimensions), "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    counts = np.zeros((len(languages), dimensions))
    counts[np.searchsorted(languages, rows["lang"].to_numpy(dtype=str)), rows["feature"].to_numpy()] = rows["n"].to_numpy()
    log_prob = np.log(counts + 1.0) - np.log(counts.sum(axis=1, keepdims=True) + dimensions)
    prior = np.array([sizes[x] for x in languages], dtype=float)
    return Model(languages, np.log(prior / prior.sum()), log_prob.astype(np.float32), orders)


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """The most probable language of each text and its posterior; ties go to the first in the alphabet."""
    asked = [i for i, t in enumerate(texts) if t and model.languages and any(map(str.isalpha, t))]
    total = np.tile(model.log_prior, (len(asked), 1))
    for rows, columns in ngram_entries([texts[i] for i in asked], model.orders, model.log_prob.shape[1]):
        if len(rows):
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            for k in range(len(model.languages)):
                total[rows[first], k] += np.add.reduceat(model.log_prob[k].take(columns), first, dtype=np.float64)
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if asked:
        best = total.argmax(axis=1)
        scores[asked] = 1.0 / np.exp(total - total[np.arange(len(asked)), best, None]).sum(axis=1)
        for i, k in zip(asked, best.tolist()):
            names[i] = model.languages[k]
    return names, scores


def identify(df: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``lang_score`` to every row; reads the column ``text`` alone.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when nothing could be learned. Texts are scored whole, however long;
    equal texts score alike; of languages that tie the first in the alphabet is
    taken. Columns with these names are replaced, all others stay.
    """
    df = df.drop("lang_pred", "lang_score")
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = extended(df.schema, lang_pred=T.StringType(), lang_score=T.DoubleType())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = score_texts(batch["text"].to_pylist(), held.value)
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "lang_pred", "lang_score"])

    return map_batches(df, scored, schema)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True for the rows that are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train_on_documents(documents: DataFrame) -> Model:
    return train(documents.where(~held_out()))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = train_on_documents(documents)
    found = identify(documents.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


QUERIES = {"op8_language_id": op8_language_id}
ORACLE_SQL: dict[str, str] = {}
