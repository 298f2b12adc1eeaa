"""WARC archives through a chunked record table.

A payload never travels whole: it is a run of (record, chunk number, bytes) rows,
and a record in the archive is a run of WARC segments (``WARC-Segment-Number``,
``continuation``) of one chunk each.  Digests are carried forward from chunk
to chunk, on the way in and on the way out.

Writing: a first pass over the chunks gives each payload's length, SHA-1 and a second
digest; of equal payloads one record stays a response.  The decisions are joined
to the pages and Spark's text sink writes the segments, whose end is the line
separator, as gzip files.  A gzip file cannot be split, so one task reads it from its
start, in order; that is what lets the reader carry its state without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import materialize, prepare

VERSION, END = "WARC/1.1\r\n", "\r\n\r\n"
#: Payload bytes of one chunk; an Arrow batch of 1,024 rows then stays within 16 MiB.
CHUNK_BYTES = 16 << 10
#: The date written into the records (an argument, so that reruns agree).
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DIGEST_SCHEMA = "page_id long, fingerprint long, payload_bytes long, payload_digest string, payload_key binary"
CHUNK_SCHEMA = ("record_id string, segment long, warc_type string, target_uri string, refers_to string, declared_digest string, "
                "declared_bytes long, content_start boolean, record_end boolean, body binary")
RECORD_SCHEMA = ("record_id string, warc_type string, target_uri string, refers_to string, declared_digest string, "
                 "declared_bytes long, stored_bytes long, stored_digest string, segments long")


def chunks_of(payload: Column, size: int) -> Column:
    """The chunks of a binary column as an array of (chunk, body, last); an empty payload has one empty chunk.
    Exploding this array, and not the payload itself, keeps the copying linear in the payload."""
    last = F.greatest(F.ceil(F.octet_length(payload) / F.lit(size)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
        k.cast("long").alias("chunk"), F.substring(payload, k * size + 1, F.lit(size)).alias("body"),
        (k == last).alias("last")))


def payload_digests(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Length and digests of each payload (page_id, fingerprint, payload), carried over its
    chunks; ``payload_key`` joins SHA-1 and BLAKE2 (equal keys: equal payloads)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, other, size = hashlib.sha1(), hashlib.blake2b(digest_size=16), 0
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (body, last) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                sha.update(body)
                other.update(body)
                size += len(body)
                if last:
                    digest = sha.digest()
                    for column, v in zip(out, (ids[i], marks[i], size, base64.b32encode(digest).decode(),
                                               digest + other.digest()), strict=True):
                        column.append(v)
                    sha, other, size = hashlib.sha1(), hashlib.blake2b(digest_size=16), 0
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()),
                                              pa.array(out[4], pa.binary())],
                                             names=["page_id", "fingerprint", "payload_bytes", "payload_digest", "payload_key"])

    rows = pages.select("page_id", "fingerprint", F.explode(chunks_of(F.col("payload"), chunk_bytes)).alias("c"))
    return rows.select("page_id", "fingerprint", "c.body", "c.last").mapInArrow(run, DIGEST_SCHEMA)


def record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _clean(value: Column) -> Column:
    """A header value: blanks, control characters and angle brackets would end or break the line."""
    return F.regexp_replace(value, r"[\x00-\x20\x7f<>]", "%20")


def _head(*fields: tuple[str, Column | str]) -> Column:
    """Header lines; a null field leaves its line out."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v), F.lit("\r\n")), F.lit(""))
             for name, v in fields]
    return F.concat(F.lit(VERSION), *lines, F.lit("\r\n"))


def decide(pages: DataFrame, chunk_bytes: int, min_revisit_bytes: int) -> DataFrame:
    """Length, digest and response of each distinct (page_id, fingerprint, payload)."""
    digests = materialize(payload_digests(pages, chunk_bytes).distinct(), "warc-digests")
    winners = (digests.where(F.col("payload_bytes") >= min_revisit_bytes)
               .groupBy("payload_key").agg(F.max("page_id").alias("response")))
    return (digests.join(winners, "payload_key", "left")
            .select("page_id", "fingerprint", "payload_bytes", "payload_digest",
                    F.when(~F.col("page_id").eqNullSafe(F.coalesce("response", "page_id")), F.col("response")).alias("refers_to")))


def write_warc(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, warc_date: str = WARC_DATE) -> None:
    """Write one record per row to gzip files under ``out``.

    Of records with equal payloads of ``min_revisit_bytes`` or more the one with the largest id
    is a response, the others are revisits (no payload; length and digest of the full
    one in their headers); smaller ones are all responses.  Payloads over
    ``chunk_bytes`` become segments.  A null payload is empty.  A null id counts as
    the smallest and is written as ``null``; rows that repeat an id and its
    payload share their decision, so equal rows with the largest id are all responses.
    A null URL leaves the header out.  An empty table writes no record.
    """
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("fingerprint", F.xxhash64("payload"))
    decided = decide(rows.select("page_id", "fingerprint", "payload"), chunk_bytes, min_revisit_bytes)
    d = decided.select(*[F.col(c).alias(f"d_{c}") for c in decided.columns])
    joined = rows.join(d, F.col("page_id").eqNullSafe(F.col("d_page_id")) & (F.col("fingerprint") == F.col("d_fingerprint")))

    rid, revisit = record_id(F.col("page_id")), F.col("d_refers_to").isNotNull()
    n_bytes = F.col("d_payload_bytes").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes, F.lit(END))
    made = joined.select(
        rid.alias("rid"), "url", "d_refers_to", "d_payload_digest", n_bytes.alias("n_bytes"), http.alias("http"),
        revisit.alias("revisit"),
        F.explode(chunks_of(F.when(revisit, F.lit(b"")).otherwise(F.col("payload")), chunk_bytes)).alias("c"))
    first, single = F.col("c.chunk") == 0, F.col("c.last") & (F.col("c.chunk") == 0)
    number = (F.col("c.chunk") + 1).cast("string")
    block = F.when(first, F.concat(F.encode("http", "UTF-8"), F.col("c.body"))).otherwise(F.col("c.body"))
    head = _head(
        ("WARC-Type", F.when(F.col("revisit"), "revisit").when(first, "response").otherwise("continuation")),
        ("WARC-Record-ID", F.when(first, F.col("rid")).otherwise(F.regexp_replace("rid", ">$", F.concat(F.lit("/"), number, F.lit(">"))))),
        ("WARC-Date", warc_date),
        ("WARC-Target-URI", _clean(F.col("url"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("d_payload_digest")))),
        ("WARC-Refers-To", F.when(F.col("revisit"), record_id(F.col("d_refers_to")))),
        ("WARC-Profile", F.when(F.col("revisit"), REVISIT_PROFILE)),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("rid"))),
        ("WARC-Segment-Number", F.when(~single, number)),
        ("WARC-Segment-Total-Length", F.when(~first & F.col("c.last"), (F.octet_length("http") + F.col("n_bytes").cast("long")).cast("string"))),
        ("Content-Type", F.when(first, "application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")))
    value = F.concat(F.encode(head, "UTF-8"), block).cast("string")  # bytes as they are
    (made.select(value.alias("value")).write.option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", 0).text(out))


class _Parser:
    """Records of one file from the pieces between version lines, body bytes passed on as they come.

    A piece ends where the next version line stands.  When that line is part of a body (the
    declared length is not reached), it and the next piece continue the body.
    """

    def __init__(self) -> None:
        self.left = 0  # body bytes of the current segment still to come
        self.fields: dict[str, str] = {}
        self.record = self.total = None
        self.segment = 0
        self.http = b""
        self.in_http = False
        self.declared = None
        self.stored = 0  # block bytes of the record so far, HTTP header included

    def piece(self, data: bytes) -> Iterator[tuple]:
        if self.left:
            yield from self.body(VERSION.encode() + data)
            return
        head, found, rest = data.partition(END.encode())
        if not found:
            if data.strip():
                raise ValueError("a record without the end of its header")
            return
        self.fields = {k.strip().lower(): v.strip() for k, _, v in
                       (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))}
        f, self.left = self.fields, int(self.fields["content-length"])
        number = int(f.get("warc-segment-number", 1))
        if f.get("warc-type") == "continuation":
            if (f.get("warc-segment-origin-id"), number) != (self.record, self.segment + 1):
                raise ValueError(f"segment {number} of {f.get('warc-segment-origin-id')} without the one before it")
            self.total = f.get("warc-segment-total-length")
        else:
            self.record, self.total, self.http, self.declared, self.stored = f["warc-record-id"], None, b"", None, 0
            self.in_http = f.get("content-type", "").startswith("application/http")
            self.kept = (f["warc-type"], f.get("warc-target-uri"), f.get("warc-refers-to"),
                         f.get("warc-payload-digest", "").removeprefix("sha1:") or None)
            self.open = "warc-segment-number" in f
        self.segment = number
        if self.left == 0:
            yield self.row(b"", True)
        else:
            yield from self.body(rest)

    def body(self, data: bytes) -> Iterator[tuple]:
        data = data[:self.left]
        self.left -= len(data)
        self.stored += len(data)
        if self.in_http:  # the payload begins after the HTTP header
            self.http += data
            head, found, data = self.http.partition(END.encode())
            if found:
                self.in_http, self.http = False, b""
                for line in head.split(b"\r\n"):
                    name, _, v = line.partition(b":")
                    if name.strip().lower() == b"content-length":
                        self.declared = int(v)
            else:
                data = b""
        yield self.row(data, self.left == 0)

    def row(self, data: bytes, whole: bool) -> tuple:
        end = whole and (not self.open or self.total is not None)
        if end and self.total is not None and int(self.total) != self.stored:
            raise ValueError(f"{self.record}: {self.stored} of {self.total} bytes")
        return (self.record, self.segment, *self.kept, self.declared, self.segment == 1, end, data)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of WARC files (gzip): rows (record_id, segment, warc_type, target_uri,
    refers_to, declared_digest, declared_bytes, content_start, record_end, body) in file order.

    ``body`` holds payload bytes without the HTTP header; a payload that holds version
    lines of its own comes in more rows.  A chain of segments that is broken, or
    a header without an end, raises ValueError.  No files, or empty ones, give no rows.
    """
    prepare(spark)
    schema = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file = _Parser(), None
        for batch in batches:
            out: list[tuple] = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != file:
                    if file is not None and parser.left:
                        raise ValueError(f"{file} ends within a record")
                    parser, file = _Parser(), name
                out.extend(parser.piece(data))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema, strict=True)],
                                                 names=names)
        if parser.left:
            raise ValueError(f"{file} ends within a record")

    pieces = spark.read.option("lineSep", VERSION).text(path)
    return pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")) \
        .mapInArrow(run, CHUNK_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of WARC files: record_id, warc_type, target_uri, refers_to, declared_digest,
    declared_bytes, stored_bytes, stored_digest (SHA-1 of the stored payload, base32), segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        kinds = [*[pa.string()] * 5, pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6, 1, 8, 9)]
            for *kept, segment, end, body in zip(*columns, strict=True):
                sha.update(body)
                size += len(body)
                if end:
                    out.append((*kept, size, base64.b32encode(sha.digest()).decode(), segment))
                    sha, size = hashlib.sha1(), 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=names)

    return read_chunks(spark, path).mapInArrow(run, RECORD_SCHEMA)


def page_of(record: str) -> Column:
    """The page id in a column of record ids that :func:`write_warc` made; null for a null id."""
    return F.regexp_extract(record, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def record_report(spark: SparkSession, path: str) -> DataFrame:
    """Per record of archives that :func:`write_warc` wrote: page_id, payload_bytes, payload_digest,
    record_type, refers_to.  A response is measured by its stored payload, and fails
    if that is not what its headers declare; a revisit has the full payload's values in its headers.
    """
    r = read_records(spark, path)
    stored = F.col("warc_type") == "response"
    agree = (F.col("stored_bytes") == F.col("declared_bytes")) & (F.col("stored_digest") == F.col("declared_digest"))
    checked = F.when(stored & ~agree, F.raise_error(F.concat(F.lit("payload differs from its header: "), F.col("record_id"))))
    return r.select(page_of("record_id").alias("page_id"),
                    F.when(stored, F.coalesce(checked.cast("long"), F.col("stored_bytes"))).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
                    F.when(stored, F.col("stored_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
                    F.col("warc_type").alias("record_type"), page_of("refers_to").alias("refers_to"))
