"""WARC archives: writing pages, and reading them back with segment reassembly.

Writing: one record per page. Of pages with equal payloads the one with the
largest page_id is a response and the others are revisits of it. A block over
``SEGMENT_BYTES`` is written as a first segment and continuation records; HTTP
bodies carry chunked transfer framing. The text sink with the record terminator
as line separator writes the gzip files, so any file system Spark knows will do.

Reading: the text source splits files at blank lines, and the tasks rebuild the
byte stream and cut it by Content-Length, a batch at a time. Segments are grouped
by their origin's record id, ordered by segment number, checked for gaps and
against the total length, and only then decoded from their chunked framing.

Defined results: a null html is an empty payload; a null page_id or url leaves
its header out and reads back as null, and ranks below every page_id; rows that
tie for the largest page_id are all responses; an empty table writes no record.
A record whose segments or framing are damaged is kept with ``complete`` false
and null payload figures. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlake.llm.columns import bound_batches
from playerlake.llm.storage import saved

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 8192
DATE = "2025-01-01T00:00:00Z"
END = b"\r\n\r\n"

HTTP_CHUNKED = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_PLAIN = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

PARSED = "origin string, segment int, total long, record_type string, page_id long, refers_to long, url string, content binary, payload binary, payload_bytes long, payload_digest string, complete boolean"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            # trailer fields end with an empty line
            while (line := body.index(b"\r\n", at)) != at:
                at = line + 2
            return b"".join(parts)
        parts.append(body[at : at + size])
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is longer or shorter than it says")
        at += size + 2


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fields(block: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in block.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _record(fields: list[tuple[str, str | None]], content: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n%b\r\n%b" % (head.encode() + b"Content-Length: %d\r\n" % len(content), content)


def _records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, row: int, segment_bytes: int) -> Iterator[bytes]:
    """The record of one page, without its terminator; several if its block is segmented."""
    digest = digest_of(payload)
    name = f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest} {row}'.encode()).digest())}>"
    uri = url and "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
              ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Page-ID", refers_to)]
        yield _record(fields, HTTP_PLAIN % len(payload))
        return
    block = HTTP_CHUNKED + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    yield _record([*fields, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for k, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{name} {k}'.encode()).digest())}>"), ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if at + segment_bytes >= len(block) else None)]
        yield _record(more, block[at : at + segment_bytes])


def write_archives(pages: DataFrame, path: str, *, min_payload: int = 0, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a WARC record for every (page_id, url, html) row below ``path``."""
    bound_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    key = F.when(F.length("payload") >= min_payload, F.sha1("payload"))
    # saved, so that a small set of repeated payloads is known to be small before the join is planned
    repeated = saved(rows.select("page_id", key.alias("same")).where("same is not null").groupBy("same").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-payloads")
    marked = rows.withColumn("same", key).join(repeated, "same", "left").select("page_id", "url", "payload", "newest", (F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            out, size = [], 0
            for values in zip(batch.column("task").to_pylist(), *[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "newest", "revisit")]):
                task, page_id, url, body, newest, revisit = values
                for record in _records(page_id, url, body, newest, revisit, task << 40 | row, segment_bytes):
                    out.append(record)
                    size += len(record)
                row += 1
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = marked.withColumn("task", F.spark_partition_id().cast("long")).mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string")).write.options(lineSep=END.decode(), compression="gzip", maxRecordsPerFile=records_per_file).text(path)


def _decoded(record_type: str, block: bytes) -> tuple[bytes | None, int | None, str | None, bool]:
    """(payload, its length, its digest, whether the block is whole) of an HTTP block."""
    try:
        head, _, body = block.partition(END)
        fields = _fields(head)
        if record_type == "revisit":
            return None, int(fields[b"content-length"]), None, True
        payload = dechunked(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body
        return payload, len(payload), digest_of(payload), True
    except (ValueError, KeyError):
        return None, None, None, False


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _number(value: bytes | None) -> int | None:
    try:
        return None if value is None else int(value)
    except ValueError:
        return None


def _parsed(fields: dict[bytes, bytes], content: bytes, keep_payload: bool) -> tuple:
    kind = _text(fields.get(b"warc-type"))
    segment = _number(fields.get(b"warc-segment-number"))
    origin = _text(fields.get(b"warc-segment-origin-id") or fields.get(b"warc-record-id"))
    stated = (_text(fields.get(b"warc-payload-digest")) or "").removeprefix("sha1:") or None
    head = (origin, segment, _number(fields.get(b"warc-segment-total-length")), kind, _number(fields.get(b"warc-page-id")), _number(fields.get(b"warc-refers-to-page-id")), _text(fields.get(b"warc-target-uri")))
    if segment is not None:
        return (*head, content, None, None, stated, None)
    payload, size, digest, whole = _decoded(kind, content)
    whole = whole and (digest is None or stated is None or digest == stated)
    return (*head, None, payload if keep_payload else None, size, digest or stated, whole)


def _stream(keep_payload: bool):
    """mapInArrow over the text source's pieces: one row for each record."""
    names = [c.split()[0] for c in PARSED.split(", ")]
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, file = b"", None
        for batch in batches:
            pieces, files = batch.column("value").to_pylist(), batch.column("file").to_pylist()
            edges = [0, *[k for k in range(1, len(files)) if files[k] != files[k - 1]], len(files)]
            rows = []
            for a, b in zip(edges, edges[1:]):
                if files[a] != file:
                    rest, file = b"", files[a]  # what a damaged file left over belongs to no other
                data, at = b"".join([rest, *[x for p in pieces[a:b] for x in (p, END)]]), 0
                while True:
                    start = data.find(b"WARC/1.", at)
                    head = data.find(END, start) if start >= 0 else -1
                    if head < 0:
                        break
                    fields = _fields(data[start:head])
                    length = _number(fields.get(b"content-length")) or 0
                    if head + 4 + length + 4 > len(data):
                        break
                    rows.append(_parsed(fields, data[head + 4 : head + 4 + length], keep_payload))
                    at = head + 4 + length + 4
                rest = data[at:]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    return run


def read_archives(spark: SparkSession, path: str, *, keep_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest, complete) of every record."""
    bound_batches(spark)
    pieces = spark.read.option("lineSep", END.decode()).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    parsed = pieces.mapInArrow(_stream(keep_payload), PARSED)
    # segments meet at their origin; the first one has the record's headers
    head = ["record_type", "page_id", "refers_to", "url", "payload", "payload_bytes", "payload_digest", "complete"]
    segments = F.sort_array(F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", F.col("content").cast("string").alias("content")))))
    grouped = parsed.groupBy("origin").agg(
        F.min_by(F.struct(*head), F.coalesce("segment", F.lit(0))).alias("head"),
        F.min("segment").alias("first"),
        F.max("total").alias("total"),
        segments.alias("segments"),
    )
    ordered = F.expr("forall(transform(segments, (s, i) -> s.segment = i + 1), x -> x)")
    block = F.array_join(F.col("segments.content"), "").cast("binary")
    whole = grouped.select(
        *[F.col(f"head.{c}") for c in head],
        F.col("first").isNotNull().alias("segmented"),
        F.when(F.col("first").isNotNull() & ordered & (F.col("total") == F.length(block)), block).alias("block"),
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in head}
            blocks = batch.column("block").to_pylist()
            for k, segmented in enumerate(batch.column("segmented").to_pylist()):
                if segmented:
                    payload, size, digest, complete = _decoded(columns["record_type"][k], blocks[k]) if blocks[k] is not None else (None, None, None, False)
                    complete = complete and columns["payload_digest"][k] in (None, digest)
                    columns["payload"][k] = payload if keep_payload else None
                    columns["payload_bytes"][k], columns["complete"][k] = size, complete
                    columns["payload_digest"][k] = digest
            types = {f.name: f.type for f in batch.schema}
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], types[c]) for c in head], names=head)

    schema = "record_type string, page_id long, refers_to long, url string, payload binary, payload_bytes long, payload_digest string, complete boolean"
    return whole.mapInArrow(finish, schema)
