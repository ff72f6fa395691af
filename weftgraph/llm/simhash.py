"""SimHash near-duplicates with a pigeonring filter.

A fingerprint's bits stand on a ring of m equal segments. If two fingerprints
differ in at most t bits, some segment starts a chain of which every prefix of l
segments differs in at most l*t/m bits. While that budget is below one the
segments are equal, so these leading segments are the join key; the rest of the
chain's budgets are checked next, and the full Hamming distance last.

Equal fingerprints are one vertex, so groups of copies never meet in a task. A
key held by very many distinct fingerprints is dealt out as pairs of blocks.
Each task reduces the links it finds to a spanning forest before it emits them.
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

from ..operators.components import connected_components
from ..plans.lineage import materialize
from .common import extended, map_batches, table, text_bytes

SEED = 42
SHINGLE = 3
DIFFERING = 2
SEGMENTS = 8
#: Segments in a chain that is required before the full check, on rings too wide for a walk over one word.
CHAIN = 4
HOT_KEY = 16_384
PAIRS_AT_ONCE = 1 << 22


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of words, repeats included; the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype=np.uint64, count=len(words) - shingle + 1)


def majority(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits, highest first, that are set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return 2 * ones > len(hashes)


def remix(hashes: np.ndarray, word: int) -> np.ndarray:
    """Another 64 bits for each hash; word 0 is the hash itself."""
    if word == 0:
        return hashes
    x = hashes + np.uint64((word * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: bytes, shingle: int = SHINGLE, words: int = 1) -> bytes:
    """A fingerprint of 64 bits for each word, big-endian; all zero for a text without words."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return bytes(8 * words)
    return b"".join(np.packbits(majority(remix(hashes, k))).tobytes() for k in range(words))


def add_fingerprints(df: DataFrame, text_column: str = "text", shingle: int = SHINGLE, words: int = 1, keep_text: bool = True) -> DataFrame:
    """Add ``_fp`` (binary) to every row.

    A null, empty or blank text has no words and the fingerprint zero; a text of
    fewer words than a shingle is one shingle; texts are read whole, however
    long; repeated shingles count as often as they occur; a bit set in exactly
    half of them is 0. A column named ``_fp`` is replaced, all others stay.
    """
    df = df.drop("_fp")
    kept = [f for f in df.schema.fields if keep_text or f.name != text_column]
    schema = extended(T.StructType(kept), _fp=T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle, words) for t in text_bytes(batch[text_column])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), found], [*(f.name for f in kept), "_fp"])

    return map_batches(df, run, schema)


class Ring:
    """Segments, budgets and keys of fingerprints of ``bits`` bits."""

    def __init__(self, bits: int, segments: int, differing: int):
        if bits % segments or 64 % (bits // segments):
            raise ValueError("a segment's width must divide 64 and the fingerprint")
        self.bits, self.segments, self.differing = bits, segments, differing
        self.width = bits // segments
        self.budgets = [l * differing // segments for l in range(segments + 1)]
        #: Leading segments that are equal by the budgets; none where a segment alone may differ, and then keys come from elsewhere.
        self.lead = max(l for l in range(segments + 1) if self.budgets[l] == 0)
        if self.lead * self.width > 48:
            raise ValueError("the leading segments must have 48 bits at most")

    def parts(self, words: np.ndarray) -> np.ndarray:
        """The segments of each fingerprint (rows of 64-bit words) as small integers."""
        each = 64 // self.width
        shifts = np.arange(64 - self.width, -1, -self.width, dtype=np.uint64)
        return ((words[:, :, None] >> shifts) & np.uint64((1 << self.width) - 1)).reshape(len(words), self.segments)

    def keys(self, words: np.ndarray) -> np.ndarray:
        """A key for each start of a chain: the start and the leading segments."""
        parts = self.parts(words)
        out = np.empty(parts.shape, dtype=np.int64)
        for start in range(self.segments):
            value = np.zeros(len(parts), dtype=np.uint64)
            for l in range(self.lead):
                value = value << np.uint64(self.width) | parts[:, (start + l) % self.segments]
            out[:, start] = value.astype(np.int64) | (start << 48)
        return out

    def linked(self, left: np.ndarray, right: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which pairs of rows are within the distance.

        The budgets of growing chains prune first. At 64 bits the chain from the
        key's start is followed to its end, the whole ring, whose budget is the
        full check. On wider rings a chain of ``CHAIN`` segments from any start
        is required, then the full distance is taken.
        """
        if self.bits == 64:
            turn = (start * self.width).astype(np.uint64)
            apart = (left ^ right)[:, 0]
            apart = apart << turn | apart >> (np.uint64(64) - turn) % np.uint64(64)
            alive = np.arange(len(apart))
            for l in range(self.lead + 1, self.segments + 1):
                alive = alive[np.bitwise_count(apart[alive] >> np.uint64(64 - l * self.width)) <= self.budgets[l]]
            return alive
        apart = np.bitwise_count(self.parts(left ^ right)).astype(np.int16)
        alive = np.flatnonzero(self.chained(apart))
        return alive[apart[alive].sum(axis=1) <= self.differing]

    def chained(self, apart: np.ndarray) -> np.ndarray:
        """Whether some chain of ``CHAIN`` segments keeps every budget; ``apart`` holds each segment's differing bits."""
        run, within = np.zeros_like(apart), np.ones(apart.shape, dtype=bool)
        for l in range(1, CHAIN + 1):
            run += np.roll(apart, 1 - l, axis=1)
            within &= run <= self.budgets[l]
        return within.any(axis=1)


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each pair, the smaller root on top."""
    while len(a):
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def cell_links(ring: Ring, words: np.ndarray, vertex: np.ndarray, cell: np.ndarray, start: np.ndarray, parent: np.ndarray) -> None:
    """Compare the rows that share a cell and unite the linked vertices. Rows are sorted by cell."""
    size = len(cell)
    edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    ends = np.repeat(edges[1:], np.diff(edges))
    at = np.arange(size)
    ahead = 1
    while len(at):
        at = at[at + ahead < ends[at]]
        for k in range(0, len(at), PAIRS_AT_ONCE >> 4):
            i = at[k : k + (PAIRS_AT_ONCE >> 4)]
            j = i + ahead
            same = parent[vertex[i]] == parent[vertex[j]]
            i, j = i[~same], j[~same]
            hit = ring.linked(words[vertex[i]], words[vertex[j]], start[i])
            unite(parent, vertex[i[hit]], vertex[j[hit]])
        ahead += 1


def spanning_links(distinct: DataFrame, ring: Ring, hot_key: int = HOT_KEY) -> DataFrame:
    """Links ``(src, dst)`` that connect whatever fingerprints of ``distinct`` (column ``_fp``) the ring connects."""
    if not ring.lead:
        raise ValueError("the ring's budgets make no segment equal, so it has no keys")
    count = ring.bits // 64

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch["_fp"]
            words = _words(held.to_pylist(), count)
            keys = ring.keys(words).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(keys), held.take(pa.array(np.repeat(np.arange(len(held)), ring.segments)))], ["key", "_fp"])

    rows = map_batches(distinct.select("_fp"), keyed, "key long, _fp binary")
    # Keys of more fingerprints than a task should hold: at most the number of rows divided by that, so few.
    hot = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_key), "hot-keys")
    if hot.limit(1).count():
        return links_by_key(rows.join(hot, "key", "left"), ring, hot_key)
    return links_by_key(rows.withColumn("n", F.lit(None).cast("long")), ring, hot_key)


def links_by_key(rows: DataFrame, ring: Ring, hot_key: int = HOT_KEY, vertex_column: str = "_fp") -> DataFrame:
    """Links that connect what ``ring`` links among the vertices of one key.

    ``rows``: key, n (the key's number of vertices; null counts as few), _fp and
    the vertex column, which is the fingerprint itself or names it.
    """
    count = ring.bits // 64
    kind = rows.schema[vertex_column].dataType.simpleString()
    arrow = pa.binary() if kind == "binary" else pa.int64()
    blocks = F.greatest(F.coalesce(F.ceil(F.col("n") / F.lit(hot_key)), F.lit(1)), F.lit(1)).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(vertex_column), F.col("blocks")).cast("int"))
    names = list(dict.fromkeys((vertex_column, "_fp")))
    dealt = dealt.select("key", *names, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", *names, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        own = whole[vertex_column].to_pylist()
        print_of = dict(zip(own, whole["_fp"].to_pylist()))
        names = sorted(print_of)  # so that the forest is the same in whatever order rows arrive
        index = {p: k for k, p in enumerate(names)}
        vertex = np.fromiter(map(index.__getitem__, own), dtype=np.int64, count=len(own))
        key, low, high = (whole[c].to_numpy() for c in ("key", "low", "high"))
        order = np.lexsort((vertex, high, low, key))
        key, low, high, vertex = key[order], low[order], high[order], vertex[order]
        change = np.r_[False, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
        parent = np.arange(len(names))
        cell_links(ring, _words([print_of[n] for n in names], count), vertex, np.cumsum(change), (key >> 48).astype(np.int64), parent)
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        moved = np.flatnonzero(parent != np.arange(len(names)))
        for k in range(0, len(moved), 65_536):
            part = moved[k : k + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in part], arrow), pa.array([names[parent[i]] for i in part], arrow)], ["src", "dst"])

    return map_batches(dealt.repartition(parts, "key", "low", "high"), compare, f"src {kind}, dst {kind}")


def _words(prints: list[bytes], count: int) -> np.ndarray:
    return np.frombuffer(b"".join(prints), dtype=">u8").astype(np.uint64).reshape(-1, count)


def near_duplicate_groups(prints: DataFrame, ring: Ring, id_column: str = "doc_id") -> DataFrame:
    """``(_fp, component_id)`` for every distinct fingerprint of ``prints``.

    ``component_id`` is the smallest id among all rows whose fingerprints are
    connected by links of at most ``ring.differing`` bits; null where no row of
    the group has an id.
    """
    distinct = materialize(prints.groupBy("_fp").agg(F.min(id_column).alias("least")), "fingerprints")
    return group_ids(distinct, spanning_links(distinct, ring))


def group_ids(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """``(_fp, component_id)`` of the fingerprints (``distinct``: _fp, least) by their links."""
    found = connected_components(links)
    joined = distinct.join(found.withColumnRenamed("id", "_fp"), "_fp", "left").withColumn("component", F.coalesce("component", "_fp"))
    joined = materialize(joined, "groups")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return materialize(joined.join(materialize(least, "least"), "component").select("_fp", "component_id"), "group-ids")


RING = Ring(64, SEGMENTS, DIFFERING)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 3-word shingles, links at 2 or fewer differing bits."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = materialize(add_fingerprints(documents, keep_text=False), "prints")
    groups = near_duplicate_groups(prints, RING)
    return prints.join(groups, "_fp").select("doc_id", F.lower(F.hex("_fp")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLE_SQL: dict[str, str] = {}
