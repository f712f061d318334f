"""WARC archives written by Spark, and segment reassembly on reading them back.

*Writing.* Every page becomes a WARC/1.1 record. Payloads of equal SHA-256 and at least MIN_REVISIT
bytes are stored once: the page with the smallest page_id is the response, the others are revisit records
that refer to it. A response's block is an HTTP message with the body in chunked transfer framing;
blocks longer than SEGMENT_BYTES are cut into a first segment and continuation records with the
origin's identifier, their segment number and, on the last one, the total length. Records are
written through Spark's text writer (the record separator is its line separator), so archives go to
any storage Spark can write, compressed with gzip. RECORDS_PER_FILE and SEGMENT_BYTES bound the size of an
archive.

*Reading.* Archives of one or of many gzip members (or plain ones) are inflated piece by piece and parsed
record by record by Content-Length, so a task holds the compressed file and one record. Segments are grouped by origin
identifier, ordered by segment number, checked for gaps and against the total length, joined, and the
chunked framing is decoded; the digest of the decoded payload is compared with the declared one.
Revisits get length and digest through the response they refer to.

Cases: a null html is an empty payload; a null url is written as an empty target; a null page_id
is written without that header and reads back as null, and such a page is a revisit where a page with an id has
the payload, else a response; pages that repeat page_id and payload are each written as response (or each as revisit); an incomplete or damaged record reads back with
``complete`` false, and its payload null; other columns are ignored; an empty table writes and reads no record.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import materialize, work_dir

MIN_REVISIT = 100
SEGMENT_BYTES = 16_000
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 1_000
PIECE_BYTES = 1 << 16  # inflated at once
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date, so that reruns agree
CRLF = b"\r\n"


# ---------------------------------------------------------------- writing

def assign_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), digest, refers_to (null for responses)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    src = pages.select("page_id", "url", payload.alias("payload"))
    src = src.withColumn("digest", F.sha2("payload", 256))
    origin = (pages.select("page_id", payload.alias("payload")).filter(F.octet_length("payload") >= MIN_REVISIT)
              .groupBy(F.sha2("payload", 256).alias("digest")).agg(F.min("page_id").alias("origin"), F.count("*").alias("n"))
              .filter("n > 1").select("digest", "origin"))
    out = src.join(origin, "digest", "left")
    return out.select("page_id", "url", "payload", "digest", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("origin")), F.col("origin")).alias("refers_to"))


def chunked(body: bytes) -> bytes:
    """The body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (body[i:i + CHUNK_BYTES] for i in range(0, len(body), CHUNK_BYTES))]
    return b"".join(parts) + b"0\r\n\r\n"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def page_records(rid: str, page_id, url: str, payload: bytes, digest: str, refers_to) -> Iterator[bytes]:
    """The records of one page, without the blank lines that end a record."""
    head = [("WARC-Date", DATE), ("WARC-Target-URI", re.sub(r"[\r\n]", "", url or "")), ("X-Page-ID", page_id),
            ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{rid}>"), *head,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("X-Refers-To-Page-ID", refers_to), ("Content-Type", "application/http; msgtype=response")],
                      b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i:i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    number = 1 if len(parts) > 1 else None
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{rid}>"), *head, ("WARC-Segment-Number", number),
                   ("Content-Type", "application/http; msgtype=response")], parts[0])
    for i, part in enumerate(parts[1:], 2):
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{rid}:{i}>"), ("WARC-Date", DATE),
                       ("WARC-Segment-Origin-ID", f"<{rid}>"), ("WARC-Segment-Number", i),
                       ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None)], part)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns = [b.column(c) for c in ("rid", "page_id", "url", "payload", "digest", "refers_to")]
        out, size = [], 0
        for i in range(b.num_rows):
            for r in page_records(*(c[i].as_py() for c in columns)):
                out.append(r)
                size += len(r)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write gzipped WARC files of the pages (page_id, url, html) into the folder ``path``."""
    rows = assign_roles(pages).withColumn("rid", F.concat(F.lit("urn:page:"), F.monotonically_increasing_id()))
    records = rows.select("rid", "page_id", "url", "payload", "digest", "refers_to").mapInArrow(_write, "value binary")
    (records.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


# ---------------------------------------------------------------- reading

def inflated(raw: bytes) -> Iterator[bytes]:
    """The content of an archive in bounded pieces: all gzip members after each other, or plain bytes."""
    if not raw.startswith(b"\x1f\x8b"):
        yield from (raw[i:i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES))
        return
    at, member = 0, None
    while at < len(raw):
        if member is None:
            at = raw.find(b"\x1f\x8b", at)  # members may be padded
            if at < 0:
                return
            member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        fed = raw[at:at + PIECE_BYTES]
        try:
            piece = member.decompress(fed, PIECE_BYTES)
        except zlib.error:  # damaged: go on with the next member
            member, at = None, at + 2
            continue
        at += len(fed) - len(member.unconsumed_tail) - len(member.unused_data)
        if piece:
            yield piece
        if member.eof:
            member = None
    if member is not None and (rest := member.flush()):
        yield rest


def parse_records(data: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive, given whole or in pieces; a truncated last block
    comes short."""
    pieces = iter([data] if isinstance(data, bytes) else data)
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    def find(mark: bytes, lo: int) -> int:
        while (i := held.find(mark, lo)) < 0:
            lo = max(lo, len(held) - len(mark) + 1)
            if not more():
                return -1
        return i

    while True:
        while (at := held.find(b"WARC/1.")) < 0:
            del held[:max(0, len(held) - 6)]
            if not more():
                return
        del held[:at]
        end = find(b"\r\n\r\n", 0)
        if end < 0:
            return
        headers = {}
        for line in held[:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size = headers.get("content-length", "")
        size = int(size) if size.isdigit() else 0
        while len(held) < end + 4 + size and more():
            pass
        yield headers, bytes(held[end + 4:end + 4 + size])
        del held[:end + 4 + size]


_SEGMENT = "origin string, number int, total bigint, type string, page_id bigint, url string, declared string, refers_to bigint, length bigint, block binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _SEGMENT.split(", ")]
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    number = lambda h, k: int(h[k]) if h.get(k, "").lstrip("-").isdigit() else None
    for b in batches:
        for content in b.column("content"):
            rows, size = [], 0
            for h, block in parse_records(inflated(content.as_py())):
                kind = h.get("warc-type")
                if kind not in ("response", "revisit", "continuation"):
                    continue
                origin = h.get("warc-segment-origin-id") or h.get("warc-record-id")
                rows.append((origin, number(h, "warc-segment-number"), number(h, "warc-segment-total-length"), kind, number(h, "x-page-id"),
                             h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                             number(h, "x-refers-to-page-id"), number(h, "content-length"), block))
                size += len(block)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def dechunk(body: bytes) -> bytes | None:
    """The body out of chunked framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        chunk = body[end + 2:end + 2 + size]
        if len(chunk) < size or body[end + 2 + size:end + 4 + size] != CRLF:
            return None
        out.append(chunk)
        at = end + 4 + size


def payload_of(message: bytes) -> bytes | None:
    """Body of an HTTP message, out of its chunked framing if it has one."""
    head, gap, body = message.partition(b"\r\n\r\n")
    if not gap:
        return None
    return dechunk(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(CRLF, b"\n")) else body


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lengths, digests, bodies = [], [], []
        for whole, block in zip(b.column("whole"), b.column("block"), strict=True):
            body = payload_of(block.as_py()) if whole.as_py() else None
            lengths.append(None if body is None else len(body))
            digests.append(None if body is None else hashlib.sha256(body).hexdigest())
            bodies.append(body)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("page_id", "url", "type", "declared", "refers_to")), pa.array(lengths, pa.int64()),
             pa.array(digests, pa.string()), pa.array(bodies, pa.binary())],
            names=["page_id", "url", "record_type", "declared", "refers_to", "payload_bytes", "payload_digest", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record of the archives in ``path``: page_id, url,
    record_type, declared (digest), refers_to, payload_bytes, payload_digest and payload (for
    responses). Records in segments are put together first."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parts = materialize(files.mapInArrow(_read, _SEGMENT), "segments")
    alone = parts.filter("type <> 'continuation' AND number IS NULL")
    alone = alone.select("page_id", "url", "type", "declared", "refers_to", "block", (F.length("block") == F.col("length")).alias("whole"))
    # segments of one page: as many as one payload has, so a group is bounded by its page
    many = parts.filter("number IS NOT NULL").groupBy("origin").agg(
        *(F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in ("page_id", "url", "type", "declared", "refers_to")),
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("number", "block"))).alias("s"))
    numbers = F.transform("s", lambda x: x.number)
    block = F.aggregate("s", F.lit("").cast("binary"), lambda a, x: F.concat(a, x.block))
    many = many.filter("type IS NOT NULL").select("page_id", "url", "type", "declared", "refers_to", block.alias("block"), "total", numbers.alias("n"))
    many = many.withColumn("whole", F.coalesce((F.length("block") == F.col("total")) & (F.col("n") == F.sequence(F.lit(1), F.size("n"))), F.lit(False)))
    both = alone.unionByName(many.drop("total", "n"))
    return both.mapInArrow(_decode, "page_id bigint, url string, record_type string, declared string, refers_to bigint, "
                                    "payload_bytes bigint, payload_digest string, payload binary")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, complete: responses as read,
    revisits with the length and digest of the response they refer to."""
    seen = materialize(records.drop("payload", "url"), "records")
    own = seen.filter("record_type = 'response'").withColumn("complete", F.coalesce(F.col("payload_digest") == F.col("declared"), F.lit(False)))
    known = own.filter("complete").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared")).agg(F.max("payload_bytes").alias("n"))
    again = seen.filter("record_type = 'revisit'").join(known, ["refers_to", "declared"], "left")
    again = again.select("page_id", F.col("n").alias("payload_bytes"), F.when(F.col("n").isNotNull(), F.col("declared")).alias("payload_digest"),
                         "record_type", "refers_to", F.col("n").isNotNull().alias("complete"))
    return own.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete").unionByName(again)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return resolve_revisits(read_archives(pages.sparkSession, path))
