"""One document of each group of near-duplicates: the pipeline's SimHash stage.

Two documents are near-duplicates if their sets of distinct five-word shingles
have a Jaccard similarity of 0.8 or more; a group is what such pairs connect.

At that similarity fingerprints differ in about 15 % of their bits, so no
segment wide enough to be a key need be equal. Keys are therefore bands of
minima of the shingle set, and the pigeonring does the pruning: a pair that
shares a key must have a chain of consecutive segments of its 384-bit
fingerprints whose cumulative differences keep within proportional budgets, then
the whole Hamming distance, and at last the shingles themselves are compared.

Keys travel with the number of a distinct shingle set only. Fingerprints are
joined to the keys that several sets share, and texts to the sets that are
compared, so what is shuffled for a document without relatives is its keys. A
key of very many sets is dealt out as pairs of blocks, a component of very much
text as blocks whose groups are then joined. Rows are named by file and place,
so texts are not written again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..plans.lineage import Scratch, materialize
from .common import map_batches, named_rows, text_bytes, unused
from .simhash import HOT_KEY, SEED, Ring, _words, links_by_key, majority, remix, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Keys: bands of minima. A pair at similarity s shares none with probability (1 - s**6)**32: 6e-5 at 0.8, 8e-6 at 0.82, 5e-9 at 0.88.
BANDS, ROWS = 32, 6
#: Of 384 bits, as a filter before the exact check. At 0.8 sets of many shingles differ in about 58 bits, the worst small
#: ones (4 in 5) in 72, with a standard deviation of 8.
RING = Ring(384, 24, 115)
WORDS = RING.bits // 64
#: What one task compares exactly, of each side: shingles and texts.
BLOCK_SHINGLES, BLOCK_TEXTS = 1 << 20, 1024
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """The hashes of a text's distinct shingles, in order."""
    return np.unique(shingle_hashes(text, SHINGLE))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of minima; none of an empty set."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    least = np.full(len(MULTIPLIERS), 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (MULTIPLIERS[:, None] * hashes[at : at + 2048]).min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = remix(key ^ bands[:, k], k + 1)
    return key.view(np.int64)


def sketch(hashes: np.ndarray) -> bytes:
    """The fingerprint of a shingle set."""
    return b"".join(np.packbits(majority(remix(hashes, k))).tobytes() if len(hashes) else bytes(8) for k in range(WORDS))


def add_sketches(rows: DataFrame) -> DataFrame:
    """Sketches of rows of (doc_id, text, file, at): the set's digest, its size, its fingerprint and its keys; a null text has no words."""
    kept = ["doc_id", "file", "at"]
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, file long, at long, digest binary, n long, _fp binary, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, n, fp, keys = [], [], [], []
            for text in text_bytes(batch["text"]):
                hashes = shingle_set(text)
                digest.append(xxhash.xxh128_digest(hashes.tobytes(), SEED))
                n.append(len(hashes))
                fp.append(sketch(hashes))
                keys.append(band_keys(hashes))
            added = [pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *added], [*kept, "digest", "n", "_fp", "keys"])

    return map_batches(rows, run, schema)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have the stage's Jaccard similarity."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common >= SIMILARITY * (len(both) - common) - 1e-9


def forest(names: list[int], prints: list[bytes], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, root: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect the sets which are similar: each of ``right`` with those of ``left``, unless ``root`` has them as one already."""
    words = _words(prints, WORDS)
    for i in right:
        near = left[root[left] != root[i]]
        apart = np.bitwise_count(words[near] ^ words[i]).sum(axis=1, dtype=np.int64)
        near = near[np.argsort(apart, kind="stable")[: int((apart <= RING.differing).sum())]]
        while len(near):
            j = near[0]
            near = near[1:]
            if similar(sets[i], sets[j]):
                root[root == root[i]] = root[j]
                near = near[root[near] != root[i]]
                yield names[i], names[j]


def links_in_cells(rows: DataFrame) -> DataFrame:
    """Links ``(src, dst)`` of exact similarity inside each cell, as a spanning forest.

    ``rows``: component, cell, part, node, root, _fp, set. Parts 0 are compared
    with one another, parts 2 with parts 1; rows of one root are one already.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["component", "cell", "part", "node", "root", "_fp", "set"]

    def of_cell(held: list[tuple]) -> list[tuple[int, int]]:
        part, names, root, prints, sets = zip(*held)
        part = np.array(part)
        arrays = [np.frombuffer(x, dtype=np.uint64) for x in sets]
        _, root = np.unique(np.array(root), return_inverse=True)
        out: list[tuple[int, int]] = []
        every = np.flatnonzero(part == 0)
        for k in range(1, len(every)):
            out += forest(names, prints, arrays, every[:k], every[k : k + 1], root)
        out += forest(names, prints, arrays, np.flatnonzero(part == 1), np.flatnonzero(part == 2), root)
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, out = None, [], []
        for batch in batches:
            for component, number, *row in zip(*(batch[c].to_pylist() for c in columns)):
                if (component, number) != cell:
                    if len(held) > 1:
                        out += of_cell(held)
                    cell, held = (component, number), []
                held.append(row)
            if out:
                yield _links(out)
                out = []
        if len(held) > 1:
            out += of_cell(held)
        if out:
            yield _links(out)

    order = ["component", "cell"]
    return map_batches(rows.select(columns).repartition(parts, *order).sortWithinPartitions(*order, "part", "node"), compare, "src long, dst long")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*pairs)], ["src", "dst"])


def shingled(rows: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """``(component, node, _fp, blocks, block, set)`` of the members, with their shingles; ``rows`` has text, file and at."""
    sizes = members.groupBy("component").agg(F.sum("n").alias("all"), F.count("*").alias("count"))
    blocks = F.greatest(F.ceil(F.col("all") / BLOCK_SHINGLES), F.ceil(F.col("count") / BLOCK_TEXTS), F.lit(1)).cast("int")
    held = members.join(sizes.select("component", blocks.alias("blocks")), "component")
    held = held.select("component", "node", "_fp", "file", "at", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    kept = ["component", "node", "_fp", "blocks", "block"]
    texts = rows.select("text", "file", "at").join(scratch.keep(held, "stage-members"), ["file", "at"]).select(*kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingle_set(t).tobytes() for t in text_bytes(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), sets], [*kept, "set"])

    return scratch.keep(map_batches(texts, run, "component long, node long, _fp binary, blocks int, block int, set binary"), "stage-shingles")


def exact_links(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links ``(src, dst)`` that connect what exact similarity connects in each component of ``sets`` (see ``shingled``).

    A component of one block is compared whole. One of several blocks is compared
    block by block first; then the largest group of each block with those of the
    other blocks, which makes one group of near copies one however large it is;
    and at last whatever is outside of the component's largest group with all the
    rest, in cells of two blocks. So the work beyond one pass grows with what is
    not yet settled, and no pair of different groups stays uncompared.
    """
    zero = F.lit(0).cast("int")
    inside = scratch.keep(links_in_cells(sets.select("component", F.col("block").alias("cell"), zero.alias("part"), "node", F.col("node").alias("root"), "_fp", "set")), "stage-links")
    large = sets.where("blocks > 1")
    if large.select("node").limit(1).count() == 0:
        return inside
    grouped = _rooted(large, inside, scratch)
    heads = grouped.groupBy("component", "block", "root").agg(F.count("*").alias("size")).groupBy("component", "block").agg(F.max_by("root", F.struct("size", -F.col("root"))).alias("node"))
    heads = large.join(heads.select("node"), "node", "left_semi")
    few = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.ceil(F.col("blocks") / BLOCK_TEXTS), F.lit(1)))
    across = scratch.keep(links_in_cells(heads.select("component", few.cast("int").alias("cell"), zero.alias("part"), "node", F.col("node").alias("root"), "_fp", "set")), "stage-links")
    both = inside.unionByName(across)
    grouped = _rooted(large, both, scratch)
    sizes = grouped.groupBy("component", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("component").agg(F.max_by("root", F.struct("size", -F.col("root"))).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    left = scratch.keep(grouped.join(main.select("component", "main"), "component").withColumn("stray", F.col("root") != F.col("main")), "stage-unsettled")
    if left.limit(1).count() == 0:
        return both
    strays = left.where("stray").groupBy("component").agg(F.ceil(F.count("*") / BLOCK_TEXTS).cast("int").alias("stray_blocks"))
    dealt = left.join(strays, "component").join(large.select("node", "blocks", "_fp", "set"), "node")
    stray_block = F.pmod(F.xxhash64("node", F.lit(2)), F.col("stray_blocks")).cast("int")
    columns = ["component", "node", "root", "_fp", "set"]
    members = dealt.select(*columns, "block", "stray_blocks", F.lit(1).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1)).alias("s")).withColumn("cell", F.col("block") * F.col("stray_blocks") + F.col("s"))
    guests = dealt.where("stray").withColumn("s", stray_block).select(*columns, "s", "stray_blocks", F.lit(2).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).withColumn("cell", F.col("block") * F.col("stray_blocks") + F.col("s"))
    last = ["component", "cell", "part", "node", "root", "_fp", "set"]
    return both.unionByName(links_in_cells(members.select(last).unionByName(guests.select(last))))


def _rooted(sets: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(component, block, node, root)`` by the links so far."""
    found = connected_components(links).select(F.col("id").alias("node"), F.col("component").alias("root"))
    return scratch.keep(sets.select("component", "block", "node").join(found, "node", "left").select("component", "block", "node", F.coalesce("root", "node").alias("root")), "stage-roots")


def candidate_links(distinct: DataFrame, scratch: Scratch, hot_key: int = HOT_KEY) -> DataFrame:
    """Links between sets (node, _fp, keys) that share a key and pass the ring's checks, as a spanning forest."""
    keyed = distinct.select(F.explode("keys").alias("key"), "node")
    shared = scratch.keep(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "stage-shared")
    met = scratch.keep(keyed.join(shared, "key").select("key", "n", "node"), "stage-met")
    return links_by_key(met.join(distinct.select("node", "_fp"), "node"), RING, hot_key, "node")


def groups(rows: DataFrame, sketches: DataFrame, scratch: Scratch) -> DataFrame:
    """``(file, at)`` of the row that stays of each group; ``rows`` has text, file and at, ``sketches`` comes of ``add_sketches``."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at")
    distinct = sketches.groupBy("digest").agg(F.min(first).alias("first"), F.first("n").alias("n"), F.first("_fp").alias("_fp"), F.first("keys").alias("keys"))
    distinct = scratch.keep(distinct.withColumn("node", F.monotonically_increasing_id()), "stage-sets")
    candidates = connected_components(candidate_links(distinct, scratch)).withColumnRenamed("id", "node")
    members = scratch.keep(distinct.select("node", "_fp", "n", "first.file", "first.at").join(candidates, "node"), "stage-candidates")
    found = connected_components(exact_links(shingled(rows, members, scratch), scratch)).withColumnRenamed("id", "node")
    by_group = distinct.select("node", "first").join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
    # Rows of one doc_id count once, so groups that share their smallest id are one.
    chosen = by_group.agg(F.min("first").alias("first"))
    same = chosen.groupBy(F.col("first.doc_id").alias("doc_id"), F.when(F.col("first.none"), F.col("component")).alias("c")).agg(F.min("first").alias("first"))
    return same.select("first.file", "first.at")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group that with the smallest doc_id stays.

    Near-duplicates have sets of 5-word shingles with a Jaccard similarity of 0.8
    or more (a text of fewer words is one shingle), and a group is what such
    pairs connect. Null, empty and blank texts have the same empty set, so one of
    them stays. Equal texts, however long, are one set. Rows repeated with the
    same doc_id count once; rows without a doc_id stay only if no other row of
    their group has one. All other columns, whatever their names, stay as they are.
    """
    docs, file, at = named_rows(docs)
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text", file.alias("file"), at.alias("at"))
    sketches = scratch.keep(add_sketches(rows), "stage-sketches")
    stays = scratch.keep(groups(rows, sketches, scratch), "stage-stays")
    # What goes is the smaller list; a join with it leaves the texts where they are while it is small.
    goes = materialize(sketches.select("file", "at").join(stays, ["file", "at"], "left_anti"), "stage-goes")
    scratch.close()
    columns = docs.columns
    mark_file, mark_at = (unused(name, columns) for name in ("file", "at"))
    marked = docs.select("*", file.alias(mark_file), at.alias(mark_at))
    goes = goes.select(F.col("file").alias(mark_file), F.col("at").alias(mark_at))
    return marked.join(goes, [mark_file, mark_at], "left_anti").select(*(f"`{c}`" for c in columns))

