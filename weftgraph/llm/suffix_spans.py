"""Repeated byte strings by interval expansion on a Burrows-Wheeler transform.

A byte is removed if a string of ``least`` bytes that covers it also starts
elsewhere. The corpus is cut so that equal strings meet in one task: every
string of that length has an anchor, the rightmost smallest hash among its
k-grams, which its own content determines. Neighbouring strings with the same
anchor form a segment; an anchor met once has no repeats. A segment whose whole
content is met twice is repeated from end to end. What is left, segments of one
anchor with different contents, is indexed: a task sorts the suffixes of its
segments, takes their Burrows-Wheeler transform and derives common-prefix
boundaries by increasing length, breadth first: a boundary between two rows at
length l extends backward to the rows of the preceding character at length
l + 1. At the minimum length it stops; rows without a boundary between them then
share that many bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import Scratch
from .common import extended, map_batches, table, text_bytes, unused

LEAST = 200
GRAM = 32
INDEX_BYTES = 1 << 19
MOST_CONTENTS = 16_384

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def segments(text: bytes, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first and last string start of each segment of a text, and the anchor's place after the first."""
    starts = len(text) - least + 1
    if starts < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    power, inverse = _power_tables(len(text) + 1)
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    grams = _mix((total[gram:] - total[:-gram]) * inverse[: len(text) - gram + 1])
    n, width = len(grams), least - gram + 1
    # The high half of the hash, then the place from the right, so that the smallest key is the rightmost of the smallest.
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    place = (np.uint64(0xFFFFFFFF) - (smallest & np.uint64(0xFFFFFFFF))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], starts] - 1
    anchor = place[first]
    content = _mix((total[last + least] - total[first]) * inverse[first]) ^ _mix(((last - first) << 20 | (anchor - first)).astype(np.uint64))
    return grams[anchor].view(np.int64), content.view(np.int64), first, last, anchor - first


def suffix_order(text: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` sorted by their first ``depth`` bytes; a suffix with less room than is compared stands alone."""
    n = len(text)
    # Seven symbols of nine bits; the end of a part is 0, below every byte, so no other suffix sorts between equal ones.
    wide = np.zeros(n + 7, dtype=np.uint64)
    wide[:n] = text
    wide += np.uint64(1)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | np.where(room > k, wide[k : k + n], np.uint64(0))
    length = 7
    order = np.argsort(key).astype(np.int32)
    ranked, alone = key[order], (room < length)[order]
    new = np.ones(n, dtype=bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | alone[1:] | alone[:-1]
    rank = np.empty(n, dtype=np.uint32)
    while True:
        rank[order] = np.cumsum(new, dtype=np.uint32)
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))  # rows of classes of two or more
        if length == depth or not len(tied):
            return order
        step = min(length, depth - length)
        at = order[tied]
        # Beyond the end of a part there is 0, below every class.
        second = np.where(room[at] > step, rank[np.minimum(at + step, n - 1)], np.uint32(0))
        key = rank[at].astype(np.uint64) << np.uint64(32) | second
        by = np.argsort(key)
        order[tied] = at = at[by]
        key, alone = key[by], room[at] < length + step
        parted = np.ones(len(tied), dtype=bool)
        parted[1:] = (key[1:] != key[:-1]) | alone[1:] | alone[:-1]
        new[tied] |= parted
        new[tied[alone]] = True
        length += step


def common_prefix_boundaries(text: np.ndarray, room: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """True where a row of the suffix order shares fewer than ``least`` bytes with the row above.

    Breadth first over the transform: at length 1 rows part where their first
    byte changes. A boundary at row q found at length l is extended backward: the
    row that the byte before q's suffix leads to parts at length l + 1 if the row
    above has the same byte before it. Rows whose predecessors were not
    neighbours part once any boundary lies between those.
    """
    n = len(text)
    row_of = np.empty(n, dtype=np.int32)
    row_of[order] = np.arange(n, dtype=np.int32)
    nxt = row_of[np.minimum(order + 1, n - 1)]  # the row of the suffix one byte on
    above = np.r_[nxt[:1], nxt[:-1]]
    byte, ends = text[order], room[order] <= 1
    bound = np.ones(n, dtype=bool)
    bound[1:] = byte[1:] != byte[:-1]
    short = ~bound & (ends | np.r_[False, ends[:-1]])  # the last byte of a part: one byte is all they can share
    whole = ~bound & ~short  # rows that may still part
    neighbours = whole & (nxt == above + 1)
    back = np.full(n, -1, dtype=np.int32)  # q -> the row that follows it backward
    at = np.flatnonzero(neighbours)
    back[nxt[at]] = at
    apart = np.flatnonzero(whole & ~neighbours)
    low, high = np.minimum(above[apart], nxt[apart]), np.maximum(above[apart], nxt[apart])
    fresh = np.flatnonzero(bound)
    ends, built = None, n
    for length in range(1, least):
        reached = back[fresh]
        reached = reached[reached >= 0]
        if length == 1:
            reached = np.r_[reached, np.flatnonzero(short)]
        reached = reached[~bound[reached]]
        if len(apart):
            # Earlier boundaries have parted their pairs already, so only the last round's count.
            if 4 * len(apart) < built:  # few pairs left: count between their ends only
                ends, at = np.unique(np.r_[low, high], return_inverse=True)
                low_at, high_at, built = at[: len(apart)], at[len(apart) :], len(apart)
            if ends is None:
                count = np.zeros(n, dtype=np.int32)
                count[fresh] = 1
                np.cumsum(count, out=count)
                parted = count[high] != count[low]
            else:
                count = np.bincount(np.searchsorted(ends, fresh), minlength=len(ends) + 1)
                np.cumsum(count, out=count)
                parted = count[high_at] != count[low_at]
            if parted.any():
                found = apart[parted]
                reached = np.r_[reached, found[~bound[found]]]
                keep = ~parted
                apart, low, high = apart[keep], low[keep], high[keep]
                if ends is not None:
                    low_at, high_at = low_at[keep], high_at[keep]
        elif not len(reached):
            break
        bound[reached] = True
        fresh = reached
    return bound


def repeated_starts(parts: list[bytes], weights: list[int], least: int = LEAST) -> list[np.ndarray]:
    """For each part, which of its string starts (0 to length - least) are met twice among all parts, weights counted."""
    sizes = np.array([len(p) for p in parts])
    text = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(len(text))
    order = suffix_order(text, room, least)
    bound = common_prefix_boundaries(text, room, order, least)
    group = np.cumsum(bound) - 1
    weight = np.repeat(np.array(weights, dtype=np.int64), sizes)[order]
    met = np.bincount(group, weights=weight * (room[order] >= least))
    again = np.zeros(len(text), dtype=bool)
    again[order] = met[group] >= 2
    again &= room >= least
    return [again[e - s : max(e - s, e - least + 1)] for e, s in zip(ends.tolist(), sizes.tolist())]


def _index(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Spans (print, first, last) of the segments met once; rows come sorted by anchor."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        prints, firsts, lasts = [], [], []
        found = repeated_starts([r[4] for r in rows], [r[1] for r in rows], least)
        for (_, n, print_, first, _), again in zip(rows, found):
            if n == 1 and again.any():
                edge = np.flatnonzero(np.diff(np.r_[0, again.view(np.int8), 0]))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    prints.append(print_)
                    firsts.append(first + a)
                    lasts.append(first + b - 1 + least)
        return pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64())], ["print", "first", "last"])

    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("anchor", "n", "print", "first", "content")]
        for row in zip(*columns):
            if size > INDEX_BYTES and row[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield solve(held)


def _refined(parts: DataFrame, least: int, scratch: Scratch, step: int = 16) -> tuple[DataFrame, DataFrame]:
    """Finer groups for anchors with very many contents: (rows for the index, spans already decided).

    Strings of one anchor are dealt by their distance to it, in steps; those of a
    step all hold a core of ``least - step + 1`` bytes, whose content joins the
    key. Equal contents are one row with a count, so only what differs within a
    step at the edges of an equal core comes together.
    """
    extent = F.octet_length("content") - least
    near, far = F.col("place") - extent, F.col("place")
    k = F.explode(F.sequence(F.floor(near / step).cast("int"), F.floor(far / step).cast("int")))
    rows = parts.withColumn("k", k).withColumn("far", F.least(far, F.col("k") * step + (step - 1))).withColumn("near", F.greatest(near, F.col("k") * step))
    core = F.substring("content", (F.col("place") - F.col("k") * step + 1).cast("int"), F.lit(least - step + 1))
    cut = F.substring("content", (F.col("place") - F.col("far") + 1).cast("int"), (F.col("far") - F.col("near") + least).cast("int"))
    rows = scratch.keep(rows.select(F.xxhash64("anchor", "k", core).alias("anchor"), "n", "print", (F.col("first") + F.col("place") - F.col("far")).alias("first"), F.col("far").alias("place"), cut.alias("content")), "refined")
    kinds = scratch.keep(rows.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(F.struct("print", "first", "place")).alias("one")), "refined-kinds")
    again = rows.join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"]).select("print", "first", (F.col("first") + F.octet_length("content")).alias("last"))
    return kinds.select("anchor", F.least("n", F.lit(2)).alias("n"), "one.print", "one.first", "one.place", "content"), again


def _split_hot(parts: DataFrame, least: int, most_contents: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of hot anchors dealt out until no group has very many contents: (rows for the index, spans already decided).

    First in steps, which share the index's work; groups that are still hot, such
    as the edges of a passage that very many texts share, string by string: then
    equal strings are one row with a count, and nothing is left to index.
    """
    finer, again = _refined(parts, least, scratch)
    sizes = finer.groupBy("anchor").agg(F.count("*").alias("contents")).where(F.col("contents") > most_contents).select("anchor")
    hot = scratch.keep(sizes, "hot-groups")
    if hot.limit(1).count():
        _, more = _refined(finer.join(hot, "anchor", "left_semi"), least, scratch, 1)
        again = again.unionByName(more)
        finer = finer.join(hot, "anchor", "left_anti")
    return finer.select("anchor", "n", "print", "first", "content"), again


def repeated_spans(docs: DataFrame, text_column: str = "text", least: int = LEAST, most_contents: int = MOST_CONTENTS, scratch: Scratch | None = None) -> DataFrame:
    """``(print, spans)``: for the MD5 of each text with repeats, byte ranges [first, last), sorted but not merged.

    What is written on the way is in ``scratch``, for the caller to delete once the result is read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(text.alias("text")).where(F.octet_length("text") >= least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "content", "first", "last", "place", "print"]
        for batch in batches:
            held: list[list] = [[], [], [], [], [], []]
            size = 0
            for t in text_bytes(batch["text"]):
                found = segments(t, least)
                for k in range(5):
                    held[k].append(found[k])
                held[5] += [hashlib.md5(t).digest()] * len(found[0])
                size += len(found[0])
                if size > 50_000:
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in held[:5]), pa.array(held[5], pa.binary())], names)
                    held, size = [[], [], [], [], [], []], 0
            if size:
                yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in held[:5]), pa.array(held[5], pa.binary())], names)

    cuts = map_batches(rows, cut, "anchor long, content long, first long, last long, place long, print binary")
    # Copies of a text share its print, so they are one row with a count from here on.
    early = Scratch(spark)
    cuts = early.keep(cuts.groupBy("anchor", "content", "print", "first", "last", "place").agg(F.count("*").alias("n")), "cuts")
    anchors = cuts.groupBy("anchor").agg(F.sum("n").alias("met"), (F.min("content") != F.max("content")).alias("mixed")).where("met > 1")
    # A content that very many texts share is joined in parts, by the number of times its anchor was met.
    shares = F.ceil(F.col("met") / F.lit(most_contents)).cast("int").alias("shares")
    met = scratch.keep(cuts.join(early.keep(anchors.select("anchor", "mixed", shares), "anchors"), "anchor").withColumn("share", F.pmod(F.xxhash64("print", "first"), F.col("shares")).cast("int")), "met")
    early.close()  # most segments are met once
    kinds = met.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(F.struct("print", "first", "last", "place")).alias("one"), F.max("mixed").alias("mixed"), F.max("shares").alias("shares"))
    kinds = scratch.keep(kinds, "kinds")
    repeated = kinds.where("n > 1").select("anchor", "content", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    whole = met.join(repeated, ["anchor", "content", "share"]).select("print", "first", (F.col("last") + least).alias("last"))
    # Anchors all of whose contents are met twice have nothing left to find.
    open_anchors = kinds.where("mixed").groupBy("anchor").agg(F.min("n").alias("fewest"), F.count("*").alias("contents")).where("fewest = 1").select("anchor", "contents")
    open_anchors = scratch.keep(open_anchors, "open-anchors")
    asked = kinds.join(open_anchors, "anchor").select(F.col("one.print").alias("print"), F.struct("anchor", F.least("n", F.lit(2)).alias("n"), F.col("one.first").alias("first"), F.col("one.last").alias("last"), F.col("one.place").alias("place"), (F.col("contents") > most_contents).alias("hot")).alias("want"))
    wants = scratch.keep(asked.groupBy("print").agg(F.collect_list("want").alias("wants")), "wants")
    prints = rows.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("print"), F.col("text").cast("binary").alias("raw"))
    # One text for each print: copies would only repeat its segments.
    texts = prints.join(wants, "print").dropDuplicates(["print"])
    content = F.transform("wants", lambda w: F.struct(w["anchor"].alias("anchor"), w["n"].alias("n"), w["first"].alias("first"), w["place"].alias("place"), w["hot"].alias("hot"), F.substring(F.col("raw"), (w["first"] + 1).cast("int"), (w["last"] - w["first"] + least).cast("int")).alias("content")))
    parts = texts.select("print", F.explode(content).alias("w")).select("w.anchor", "w.n", "print", "w.first", "w.content", "w.place", "w.hot")
    if open_anchors.where(F.col("contents") > most_contents).limit(1).count():
        parts = scratch.keep(parts, "parts")
        finer, again = _split_hot(parts.where("hot"), least, most_contents, scratch)
        whole = whole.unionByName(again)
        parts = parts.where("NOT hot").select(finer.columns).unionByName(finer)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = map_batches(parts.repartition(shuffles, "anchor").sortWithinPartitions("anchor"), lambda it: _index(it, least), "print binary, first long, last long")
    spans = whole.unionByName(found).distinct()
    return spans.groupBy("print").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


def remove_repeats(docs: DataFrame, text_column: str = "text", least: int = LEAST, most_contents: int = MOST_CONTENTS) -> DataFrame:
    """Add ``removed_spans`` (merged byte ranges [first, last)) and ``kept`` (the bytes that remain) to every row.

    A null text is empty; texts shorter than ``least`` bytes keep everything;
    repeated rows repeat each other; texts may have any length. Columns with
    these names are replaced, all others stay.
    """
    docs = docs.drop("removed_spans", "kept")
    scratch, found = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    spans = found.keep(repeated_spans(docs, text_column, least, most_contents, scratch), "spans")
    scratch.close()  # before texts are shuffled to their spans
    raw = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    mark, own = unused("print", docs.columns), unused("spans", docs.columns)
    spans = spans.select(F.col("print").alias(mark), F.col("spans").alias(own))
    joined = docs.withColumn(mark, F.unhex(F.md5(raw))).join(spans, mark, "left").drop(mark)
    kept_fields = [f for f in joined.schema.fields if f.name != own]
    schema = extended(T.StructType(kept_fields), removed_spans=_SPANS, kept=T.BinaryType())
    arrow_spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                merged, left = [], []
                for text, found in zip(text_bytes(batch[text_column]), batch[own].to_pylist()):
                    out: list[dict] = []
                    for s in found or ():
                        if out and s["first"] <= out[-1]["last"]:
                            out[-1]["last"] = max(out[-1]["last"], s["last"])
                        else:
                            out.append(s)
                    merged.append(out)
                    edges = [0, *(x for s in out for x in (s["first"], s["last"])), len(text)]
                    left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept_fields), pa.array(merged, arrow_spans), pa.array(left, pa.binary())], schema.names)

    return map_batches(joined, cut, schema)


def op6_suffix_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that 200-byte repeats cover."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    return found.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op6_suffix_spans": op6_suffix_spans}
ORACLE_SQL: dict[str, str] = {}
