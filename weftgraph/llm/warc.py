"""WARC archives: writing, reading and revisit resolution.

Archives are written by Spark's text sink, one record a row with the blank lines
that end a WARC record as line separator, so any file system Spark knows will do
and a lost executor's files are never committed. They are read back and cut by
Content-Length: files of at most 32 MB as one value each, inflated piece by
piece, larger ones as a stream of lines by the same separator. Either way a
reader holds one record beside that, however well a file is compressed and
however often a payload has such lines.

Revisit resolution shuffles headers only, by payload digest: per digest the
record with the largest id stays a response, the others become revisits of it.
Payloads meet the decisions once, by record id, when the deduplicated archives
are written with fresh headers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import materialize, new_path
from .common import map_batches, table

REVISIT_BYTES = 1000
RECORDS_A_FILE = 4000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
BATCH_BYTES = 4 << 20
#: Archives up to this size are read whole; pieces of this size are inflated at a time.
WHOLE_FILE, INFLATED = 32 << 20, 1 << 20

HEADERS = "record_id string, record_type string, page_id long, url string, declared_digest string, payload_digest string, payload_bytes long, refers_to_record string"


def _line(name: str, value: Column) -> Column:
    """A header line; null where there is no value, which concat_ws then leaves out."""
    return F.concat(F.lit(f"{name}: "), value)


def _record(kind: Column, payload_digest: Column, refers_to: Column, http: Column, body: Column) -> Column:
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), payload_digest)),
        _line("WARC-Profile", F.when(refers_to.isNotNull(), F.lit(PROFILE))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), refers_to, F.lit(">"))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
    )
    return F.concat(head, F.lit(END), http, body)


def _http(payload: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit(END))


def _write(records: DataFrame, path: str, records_a_file: int) -> None:
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_a_file).text(path)


def write_archives(pages: DataFrame, path: str, records_a_file: int = RECORDS_A_FILE) -> None:
    """Write one response record for every row of ``pages`` (page_id, url, html).

    A null html is an empty payload; a null page_id or url has no header line;
    characters that would break a header line are left out of the url. Record ids
    are fixed once written: they also tell repeated rows apart.
    """
    digest = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url", F.monotonically_increasing_id().cast("string")))
    uuid = F.regexp_replace(digest, "^(.{8})(.{4}).(.{3})(.{4})(.{12}).*$", "$1-$2-4$3-$4-$5")
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.regexp_replace("url", r"[\x00-\x20\x7f]", "").alias("url"), body.alias("body")).withColumn("record_id", F.substring(uuid, 1, 36))
    none = F.lit(None).cast("string")
    _write(rows.select(_record(F.lit("response"), F.sha1("body"), none, _http(F.col("body")), F.col("body"))), path, records_a_file)


class Records:
    """Cuts a stream of bytes into records: headers (lower-case names) and block."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.need = 0  # bytes that the next step waits for
        self.headers: dict[str, str] | None = None

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.held += data
        while len(self.held) >= self.need:
            if self.headers is None:
                at = self.held.find(b"WARC/")
                end = self.held.find(b"\r\n\r\n", max(at, 0))
                if at < 0 or end < 0:
                    self.need = len(self.held) + 1
                    return
                lines = self.held[at:end].decode("utf-8", "replace").split("\r\n")[1:]
                self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                del self.held[: end + 4]
                self.need = int(self.headers["content-length"])
            else:
                headers, self.headers = self.headers, None
                block = bytes(self.held[: self.need])
                del self.held[: self.need]
                self.need = 1
                yield headers, block

    def close(self) -> None:
        if self.headers is not None or self.held.strip():
            raise ValueError(f"record {(self.headers or {}).get('warc-record-id')} is cut off")


def inflated(content: bytes) -> Iterator[bytes]:
    """A gzip file's bytes in pieces of bounded size; members follow one another."""
    while content:
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            yield member.decompress(content, INFLATED)
            content = member.unconsumed_tail
            if not content and not member.eof:
                yield member.flush()
                break
        content = member.unused_data


def parse(content: bytes, packed: bool) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file's bytes."""
    records = Records()
    for piece in inflated(content) if packed else (content,):
        yield from records.feed(piece)
    records.close()


def _bare(value: str | None) -> str | None:
    return value.removeprefix("<urn:uuid:").removesuffix(">") if value else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives below ``path``: HEADERS, and ``payload`` (binary) if asked for.

    ``payload_digest`` and ``payload_bytes`` are those of the payload found; a revisit has none of its own.
    Files named ``*.gz`` may have any size, files named ``*.warc`` must be below 2 GB.
    """
    schema = HEADERS + (", payload binary" if payloads else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]

    def run(records: Iterator[tuple[dict[str, str], bytes]]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        def row(headers: dict[str, str], block: bytes) -> tuple:
            kind = headers["warc-type"]
            payload = block.partition(b"\r\n\r\n")[2]
            own = kind != "revisit"
            page = headers.get("x-page-id")
            found = (
                _bare(headers["warc-record-id"]),
                kind,
                int(page) if page else None,
                headers.get("warc-target-uri"),
                headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                hashlib.sha1(payload).hexdigest() if own else None,
                len(payload) if own else None,
                _bare(headers.get("warc-refers-to")),
            )
            return (*found, payload) if payloads else found

        for headers, block in records:
            rows.append(row(headers, block))
            held += len(block) if payloads else 300
            if held > BATCH_BYTES:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
        name, records = None, Records()
        for pieces in batches:
            for path, piece in zip(pieces["path"].to_pylist(), pieces["piece"]):
                if path != name:
                    records.close()
                    name, records = path, Records()
                yield from records.feed(piece.as_py() + b"\r\n\r\n")
        records.close()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
        for files in batches:
            for name, content in zip(files["path"].to_pylist(), files["content"]):
                yield from parse(content.as_py(), name.endswith(".gz"))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path)
    large = F.col("path").endswith(".gz") & (F.col("length") > WHOLE_FILE)
    found = map_batches(files.where(~large).select("path", "content"), lambda it: run(whole(it)), schema)
    if files.where(large).select("path").limit(1).count() == 0:
        return found
    lines = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path).where(F.col("_metadata.file_size") > WHOLE_FILE)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))
    return found.unionByName(map_batches(lines, lambda it: run(streamed(it)), schema))


def resolve_revisits(headers: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(record_id, refers_to_record)`` for every response that repeats another's payload of at least ``least_bytes``.

    Of equal payloads (SHA-1 and length) the record with the largest page_id
    stays; a null page_id counts as smallest, ties go to the largest record id.
    """
    eligible = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes)).select("record_id", "page_id", "payload_digest", "payload_bytes")
    original = F.max(F.struct("page_id", "record_id"))
    groups = eligible.groupBy("payload_digest", "payload_bytes").agg(original.alias("original"), F.count("*").alias("n")).where("n > 1")
    originals = materialize(groups.select("payload_digest", "payload_bytes", F.col("original.record_id").alias("refers_to_record")), "originals")
    return eligible.join(originals, ["payload_digest", "payload_bytes"]).where("record_id <> refers_to_record").select("record_id", "refers_to_record")


def deduplicate_archives(spark: SparkSession, source: str, target: str, least_bytes: int = REVISIT_BYTES, records_a_file: int = RECORDS_A_FILE) -> None:
    """Write the archives below ``source`` again below ``target``, repeats as revisit records."""
    headers = materialize(read_archives(spark, source), "headers")
    revisits = materialize(resolve_revisits(headers, least_bytes).withColumnRenamed("refers_to_record", "original"), "revisits")
    rows = read_archives(spark, source, payloads=True).join(revisits, "record_id", "left")
    payload = F.col("payload").cast("string")
    again = F.col("original").isNotNull()
    body = F.when(again, F.lit("")).otherwise(payload)
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    _write(rows.select(_record(kind, F.col("payload_digest"), F.col("original"), _http(payload), body)), target, records_a_file)


def resolved(headers: DataFrame) -> DataFrame:
    """All records with payload digest and length; revisits take theirs from the response they join by digest and id."""
    responses = headers.where("record_type = 'response'")
    revisits = headers.where("record_type = 'revisit'").select("record_id", "page_id", "url", F.col("declared_digest").alias("payload_digest"), F.col("refers_to_record").alias("original"))
    originals = responses.select("payload_digest", F.col("record_id").alias("original"), "payload_bytes", F.col("page_id").alias("refers_to"))
    joined = revisits.join(originals, ["payload_digest", "original"])
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = responses.withColumn("refers_to", F.lit(None).cast("long"))
    return first.select(columns).unionByName(joined.withColumn("record_type", F.lit("revisit")).select(columns))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, write the deduplicated archives, and read those back."""
    source, target = new_path(spark, "warc"), new_path(spark, "warc-deduplicated")
    write_archives(table(spark, sf_dir, "pages"), source)
    deduplicate_archives(spark, source, target)
    headers = materialize(read_archives(spark, target), "headers")
    return resolved(headers).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to FROM q
"""

QUERIES = {"op1_warc_revisits": op1_warc_revisits}
ORACLE_SQL = {"op1_warc_revisits": _ORACLE}
