"""Benchmark decontamination by a prefix-filtered set join.

An item's windows (eight consecutive words; a shorter item is one window) are
sets of shingles of three words that a document must contain whole. Shingles are
ordered by their rarity over all documents; full containment makes the rarest
shingle of a window its necessary prefix. Documents' shingles are joined with
these prefix tokens only; a match that leaves the document at either end fails
the length and positional bounds, and what remains is verified word by word over
a window of the item's own size.

A filter of hashed tokens goes to all tasks first, so that of the documents only
the places of likely tokens are shuffled, each with the words around it. The
filter has a fixed number of bits for each window up to a bound, and rarity is
counted in a table of fixed size; neither decides about a match. Texts are not
shuffled by the join: rows are named by file and place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import Scratch, materialize
from .common import map_batches, named_rows, table, text_bytes, unused

WINDOW = 8
SHINGLE = 3
CONTAMINATED_ITEMS = 2
#: Rarity is counted in a table of 2**20 cells. The token filter has 64 bits a window, from 2**16 to 2**29 (64 MB) in all.
RARITY_BITS = 20
FILTER_BITS = (16, 29)

#: Lower-cases A-Z and turns every other ASCII character that is no digit and no letter into a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def item_windows(words: list[bytes], window: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """All windows of an item; the whole item if it is shorter; none if it has no words."""
    if words:
        for i in range(max(1, len(words) - window + 1)):
            yield tuple(words[i : i + window])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(3)), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def window_rows(items: DataFrame, window: int) -> DataFrame:
    """``(words, size, items)`` of every distinct window; ``words`` joined by spaces, ``items`` sorted as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, words, sizes = [], [], []
            for name, text in zip(batch["item_id"].to_pylist(), text_bytes(batch["text"])):
                for w in set(item_windows(words_of(text), window)):
                    names.append(name)
                    words.append(b" ".join(w))
                    sizes.append(len(w))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.binary()), pa.array(sizes, pa.int32())], ["item_id", "words", "size"])

    found = map_batches(items, run, "item_id string, words binary, size int")
    return found.groupBy("words", "size").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _filter_cells(tokens: DataFrame, bits: int) -> np.ndarray:
    """The filter: one bit for each cell, set where a token falls. Tokens: rows of ``token``."""
    low_bits = min(15, bits - 1)
    cell = F.shiftrightunsigned("token", 64 - bits)
    chunks = tokens.select(cell.alias("cell")).distinct().groupBy(F.shiftright("cell", low_bits).alias("chunk")).agg(F.collect_list(F.col("cell").bitwiseAND((1 << low_bits) - 1)).alias("low"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for low in batch["low"]:
                held = np.zeros(1 << low_bits, dtype=bool)
                held[low.values.to_numpy()] = True
                out.append(np.packbits(held).tobytes())
            yield pa.RecordBatch.from_arrays([batch["chunk"], pa.array(out, pa.binary())], ["chunk", "held"])

    whole = np.zeros(1 << (bits - 3), dtype=np.uint8).reshape(-1, max(1, (1 << low_bits) >> 3))
    for row in map_batches(chunks, packed, "chunk long, held binary").toLocalIterator():
        whole[row["chunk"]] = np.frombuffer(row["held"], dtype=np.uint8)
    return whole.reshape(-1)


def _in_filter(cell: np.ndarray, held: np.ndarray) -> np.ndarray:
    return (held[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)


def shingle_counts(rows: DataFrame, tokens: DataFrame, sizes: list[int]) -> np.ndarray:
    """How often the documents' shingles fall into each cell that a shingle of a window falls into."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(_filter_cells(tokens, RARITY_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for batch in batches:
            for text in text_bytes(batch["text"]):
                hashes = word_hashes(words_of(text))
                for size in sizes:
                    cell = cells(shingle_hashes(hashes, size), RARITY_BITS)
                    np.add.at(counts, cell[_in_filter(cell, held.value)], 1)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["cell", "n"])

    found = map_batches(rows.select("text"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts


def prefix_rows(windows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Adds ``token`` (the rarest shingle of a window) and ``place`` (its first word's place); windows with a shingle that no document has are left out."""
    rarity = windows.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, tokens, places = [], [], []
            for i, words in enumerate(batch["words"]):
                hashes = word_hashes(words.as_py().split(b" "))
                shingles = shingle_hashes(hashes, min(SHINGLE, len(hashes)))
                met = rarity.value[cells(shingles, RARITY_BITS)]
                if met.all():
                    at = int(np.lexsort((shingles, met))[0])
                    kept.append(i)
                    tokens.append(shingles[at])
                    places.append(at)
            part = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.array(tokens, dtype=np.uint64).view(np.int64)), pa.array(places, pa.int32())], [*part.schema.names, "token", "place"])

    return map_batches(windows, run, "words binary, size int, items array<string>, token long, place int")


def token_places(rows: DataFrame, held: np.ndarray, bits: int, sizes: list[int], window: int) -> DataFrame:
    """``(file, at, n_words, found)`` of every document; ``found``: likely tokens, their place, and the words around from place ``first`` on."""
    kept = rows.sparkSession.sparkContext.broadcast(held)
    around = pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32()), ("first", pa.int32()), ("words", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = [], []
            for text in text_bytes(batch["text"]):
                words = words_of(text)
                hashes = word_hashes(words)
                likely = []
                for size in sizes:
                    shingles = shingle_hashes(hashes, size)
                    for at in np.flatnonzero(_in_filter(cells(shingles, bits), kept.value)).tolist():
                        first = max(0, at - window + size)
                        likely.append({"token": int(shingles[at].view(np.int64)), "place": at, "first": first, "words": b" ".join(words[first : at + window])})
                n.append(len(words))
                found.append(likely)
            yield pa.RecordBatch.from_arrays([batch["file"], batch["at"], pa.array(n, pa.int64()), pa.array(found, around)], ["file", "at", "n_words", "found"])

    return map_batches(rows, run, "file long, at long, n_words long, found array<struct<token:long,place:int,first:int,words:binary>>")


def verified(places: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(file, at, first, last, items)`` of every occurrence of a window: the join on prefix tokens, the bounds, and the words themselves."""
    found = places.select("file", "at", "n_words", F.explode("found").alias("f")).select("file", "at", "n_words", "f.token", F.col("f.place").alias("met"), F.col("f.first").alias("from"), F.col("f.words").alias("around"))
    joined = found.join(prefixes.select("token", "place", "size", "words", "items"), "token").withColumn("first", F.col("met") - F.col("place"))
    joined = joined.where((F.col("first") >= F.col("from")) & (F.col("first") + F.col("size") <= F.col("n_words")))
    own = F.array_join(F.slice(F.split(F.col("around").cast("string"), " "), F.col("first") - F.col("from") + 1, F.col("size")), " ")
    return joined.where(own == F.col("words").cast("string")).select("file", "at", "first", (F.col("first") + F.col("size")).cast("int").alias("last"), "items")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


_SPAN = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
_ARROW_SPAN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def located(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """For rows of (text, file, at): ``(file, at, n_words)`` of all, and ``(file, at, hit_spans, item_ids)`` of those that hold a window."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = scratch.keep(window_rows(items, window), "windows")
    sizes = sorted({min(SHINGLE, r["size"]) for r in windows.select("size").distinct().collect()})  # one to three
    shingled = scratch.keep(_window_shingles(windows), "window-shingles")
    prefixes = scratch.keep(prefix_rows(windows, shingle_counts(rows, shingled, sizes)), "prefixes")
    low, high = FILTER_BITS
    bits = min(high, max(low, (64 * prefixes.count()).bit_length()))
    places = materialize(token_places(rows, _filter_cells(prefixes.select("token"), bits), bits, sizes, window), "token-places")
    hits = verified(places, prefixes).groupBy("file", "at").agg(F.collect_set(F.struct("first", "last")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"first": a, "last": b} for a, b in merged([(s["first"], s["last"]) for s in x])] for x in batch["spans"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["file"], batch["at"], pa.array(spans, _ARROW_SPAN), batch["item_ids"]], ["file", "at", "hit_spans", "item_ids"])

    schema = T.StructType([T.StructField("file", T.LongType()), T.StructField("at", T.LongType()), T.StructField("hit_spans", T.ArrayType(_SPAN)), T.StructField("item_ids", T.ArrayType(T.StringType()))])
    found = materialize(map_batches(hits, run, schema), "overlaps")
    scratch.close()
    return places.select("file", "at", "n_words"), found


def _window_shingles(windows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [word_hashes(w.as_py().split(b" ")) for w in batch["words"]]
            tokens = [shingle_hashes(h, min(SHINGLE, len(h))) for h in hashes]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *tokens]).view(np.int64))], ["token"])

    return map_batches(windows.select("words"), run, "token long").distinct()


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word ranges [first, last)) and ``item_ids`` (sorted as strings) to every document.

    Null texts have no words and hit nothing; texts are taken whole, however
    long; repeated documents repeat each other; benchmark rows without an id or
    without words are passed over; rows repeated under one id add up. Columns of
    ``docs`` with these names are replaced, all others stay.
    """
    docs, file, at = named_rows(docs)
    rows = docs.select("text", file.alias("file"), at.alias("at"))
    counted, found = located(rows, benchmark, window)
    columns = [c for c in docs.columns if c not in ("n_words", "hit_spans", "item_ids")]
    by = [unused("file", docs.columns), unused("at", docs.columns)]
    marked = docs.select(*(f"`{c}`" for c in columns), file.alias(by[0]), at.alias(by[1]))
    all_rows = counted.join(found, ["file", "at"], "left").withColumnsRenamed(dict(zip(["file", "at"], by)))
    none_hit, none_met = F.array().cast(T.ArrayType(_SPAN)), F.array().cast("array<string>")
    return marked.join(all_rows, by).select(*(f"`{c}`" for c in columns), "n_words", F.coalesce("hit_spans", none_hit).alias("hit_spans"), F.coalesce("item_ids", none_met).alias("item_ids"))


def without_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no whole window of ``window`` words of an item, nor windows of two items.

    A lone match of an item shorter than a window is common speech and stays. All
    columns stay; what goes is the smaller list, so texts are left where they are
    while it is small.
    """
    docs, file, at = named_rows(docs)
    _, found = located(docs.select("text", file.alias("file"), at.alias("at")), benchmark, window)
    whole = F.exists("hit_spans", lambda s: s["last"] - s["first"] >= window)
    by = [unused("file", docs.columns), unused("at", docs.columns)]
    goes = found.where(whole | (F.size("item_ids") >= CONTAMINATED_ITEMS)).select(F.col("file").alias(by[0]), F.col("at").alias(by[1]))
    marked = docs.select("*", file.alias(by[0]), at.alias(by[1]))
    return marked.join(materialize(goes, "contaminated"), by, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, hit words and items."""
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("item_ids") >= CONTAMINATED_ITEMS).alias("contaminated"),
    )


_ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(w), 8) AS n, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 6))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, iw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op3_decontaminate": op3_decontaminate}
ORACLE_SQL = {"op3_decontaminate": _ORACLE}
