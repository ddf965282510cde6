"""Operator 1: WARC archives with segmented records, written and reassembled.

Writing: every page becomes a record whose block is an HTTP response in chunked
transfer framing.  Blocks longer than ``segment_bytes`` are cut: the first part
stands in the record itself (``WARC-Segment-Number: 1``), the others follow as
``continuation`` records that name it (``WARC-Segment-Origin-ID``) and, the last
one, the length of the whole block (``WARC-Segment-Total-Length``).  Of pages
with equal payloads the one with the smallest page_id is a ``response``, the
others are ``revisit`` records without payload.

Reading: records are parsed file by file, segments grouped by their origin,
ordered by number, joined, checked against the total length, and the chunked
framing is taken off.  The parts of one record may lie in different files.

A file has at most ``records_per_file`` records of at most ``segment_bytes``
plus headers, so its size, and what one task holds of it, is bounded.

Defined cases: null html: an empty payload; null url: no target; null page_id: a
record of its own that is a revisit if an equal payload has an id, else a
response; a page_id that repeats: a record per row, and each row with the
smallest id of its payload is a response; empty table: no records; other columns
are ignored.  A record that is damaged isn't dropped: it has a ``problem`` and a
null payload (see PROBLEMS).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import lookup, require, written

SEGMENT_BYTES = 32 << 10
RECORDS_PER_FILE = 2_000
CHUNK_BYTES = 8 << 10
# Equal payloads of at least so many bytes are stored once.
REVISIT_MIN_BYTES = 0

CRLF = b"\r\n"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PROBLEMS = ("missing segment", "repeated segment", "wrong total length", "bad HTTP block",
            "bad chunk framing", "wrong payload digest", "truncated record")


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hex string: four groups of 40 bits."""
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def assign_roles(pages: DataFrame, min_bytes: int = REVISIT_MIN_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): ``refers_to`` is null for a page
    that is stored as a response."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        html.alias("html"), base32_of_hex(F.sha1(html.cast("binary"))).alias("digest"))
    long = F.octet_length("html") >= min_bytes
    first = rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"),
                                                   F.count(F.lit(1)).alias("n"))
    # A payload that occurs once needs no lookup; most do.
    shared = written(first.where("n > 1"), "payloads")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    return lookup(rows, shared, "digest", "n").withColumn(
        "refers_to", F.when(long, refers)).select("page_id", "url", "html", "digest", "refers_to")


def _chunked(payload: bytes, chunk_bytes: int) -> bytes:
    out = []
    for i in range(0, len(payload), chunk_bytes):
        part = payload[i:i + chunk_bytes]
        out += [b"%X" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def _header(lines: list[tuple[str, str]], length: int) -> bytes:
    text = "".join(f"{k}: {v}\r\n" for k, v in lines)
    return f"WARC/1.1\r\n{text}Content-Length: {length}\r\n\r\n".encode("utf-8", "surrogatepass")


def _one_line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, copy: str, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, each without its two closing line ends."""
    record_id = f"<urn:page:{'' if page_id is None else page_id}#{copy}>"
    common = [("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        common.append(("WARC-Target-URI", _one_line(url)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head = [("WARC-Record-ID", record_id), *common, ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_header([("WARC-Type", "revisit"), *head, ("WARC-Profile", REVISIT_PROFILE),
                         ("WARC-Refers-To", f"<urn:page:{refers_to}>")], len(block)) + block]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_header([("WARC-Type", "response"), *head], len(block)) + block]
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_header([("WARC-Type", "response"), *head, ("WARC-Segment-Number", "1")],
                   len(parts[0])) + parts[0]]
    for n, part in enumerate(parts[1:], 2):
        lines = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{record_id[:-1]}.{n}>"), *common,
                 ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            lines.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_header(lines, len(part)) + part)
    return out


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, chunk_bytes: int = CHUNK_BYTES,
                   min_bytes: int = REVISIT_MIN_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as gzip-compressed WARC files."""
    require(pages, ["page_id", "url", "html"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                records = []
                for r in batch.slice(i, 100).to_pylist():
                    records += page_records(
                        r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["digest"],
                        r["refers_to"], f"{part}-{row}", segment_bytes, chunk_bytes)
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    # Spark's text writer keeps the bytes and ends every record with two CRLFs.
    (assign_roles(pages, min_bytes).mapInArrow(run, "record binary")
     .select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


RECORD_SCHEMA = ("record_id string, type string, uri string, digest string, refers_to string, "
                 "origin string, segment int, total bigint, block binary, problem string")


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive.  Broken framing ends the file with a record
    whose problem is "truncated record"."""
    at = 0
    while at < len(data):
        head_end = data.find(END, at)
        if head_end < 0 or not data.startswith(b"WARC/", at):
            if data[at:].strip(CRLF):
                yield {"problem": "truncated record"}
            return
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = h.get("content-length", "")
        begin = head_end + len(END)
        fits = size.isdecimal() and begin + int(size) <= len(data)
        number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
        yield {"record_id": h.get("warc-record-id"), "type": h.get("warc-type"),
               "uri": h.get("warc-target-uri"),
               "digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
               "refers_to": h.get("warc-refers-to"),
               "origin": h.get("warc-segment-origin-id") or h.get("warc-record-id"),
               "segment": int(number) if (number or "").isdecimal() else None,
               "total": int(total) if (total or "").isdecimal() else None,
               "block": data[begin:begin + int(size)] if fits else None,
               "problem": None if fits else "truncated record"}
        if not fits:
            return
        at = begin + int(size) + len(END)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives, segments as they are."""
    import gzip

    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()),
                        ("digest", pa.string()), ("refers_to", pa.string()), ("origin", pa.string()),
                        ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
                        ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for r in parse_records(data):
                    rows.append(r)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record that isn't a continuation: its whole block.  Only the
    segments of segmented records are shuffled; a group is one record."""
    whole = records.where("segment is null").select(
        "record_id", "type", "uri", "digest", "refers_to", "block", "problem")
    parts = records.where("segment is not null").groupBy("origin").agg(
        F.first(F.when(F.col("segment") == 1, F.col("record_id")), True).alias("record_id"),
        *[F.first(F.when(F.col("segment") == 1, F.col(c)), True).alias(c)
          for c in ("type", "uri", "digest", "refers_to")],
        F.max("total").alias("total"), F.max("segment").alias("top"),
        F.count_distinct("segment").alias("kinds"), F.first("problem", True).alias("found"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    # Joining as strings keeps the bytes as they are.
    joined = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    complete = (F.col("kinds") == F.col("top")) & F.col("total").isNotNull() & F.col("record_id").isNotNull()
    problem = F.coalesce(
        F.col("found"), F.when(F.size("parts") > F.col("kinds"), F.lit("repeated segment")),
        F.when(~complete, F.lit("missing segment")),
        F.when(F.octet_length(joined) != F.col("total"), F.lit("wrong total length")))
    joined_parts = parts.select(F.coalesce("record_id", "origin").alias("record_id"), "type", "uri",
                                "digest", "refers_to", joined.alias("block"), problem.alias("problem"))
    return whole.union(joined_parts)


def unchunk(body: bytes) -> bytes | None:
    """Take the chunked transfer framing off; None if it is broken.  Chunk
    extensions and trailers are allowed."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return None
        at = end + 2
        if n == 0:
            rest = body[at:]
            return b"".join(out) if rest == CRLF or rest.endswith(END) else None
        if n < 0 or body[at + n:at + n + 2] != CRLF:
            return None
        out.append(body[at:at + n])
        at += n + 2


def payload_of(kind: str | None, block: bytes | None, digest: str | None
               ) -> tuple[bytes | None, int | None, str | None, str | None]:
    """(payload, its bytes, its digest, problem) of a whole block.  A revisit's
    payload is null; its size and digest are those that the record states."""
    head, found, body = (block or b"").partition(END)
    if not found:
        return None, None, None, "bad HTTP block"
    h = {k.strip().lower(): v.strip().lower() for k, _, v in
         (x.partition(b":") for x in head.split(CRLF)[1:])}
    stated = h.get(b"content-length", b"")
    if kind == "revisit":
        return None, int(stated) if stated.isdigit() else None, digest, None
    if h.get(b"transfer-encoding") == b"chunked":
        body = unchunk(body)
        if body is None:
            return None, None, None, "bad chunk framing"
    actual = base64.b32encode(hashlib.sha1(body).digest()).decode()
    if digest is not None and actual != digest:
        return None, None, None, "wrong payload digest"
    return body, len(body), actual, None


PAYLOAD_SCHEMA = ("record_id string, type string, uri string, refers_to string, payload binary, "
                  "payload_bytes bigint, payload_digest string, problem string")


def decode(blocks: DataFrame, with_payload: bool = True) -> DataFrame:
    """Payloads of whole records.  ``with_payload=False`` leaves the bytes null
    once they are measured and checked."""
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()),
                        ("refers_to", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows = []
                for r in batch.slice(i, 500).to_pylist():
                    payload, size, digest, problem = (None, None, None, r["problem"]) if r["problem"] \
                        else payload_of(r["type"], r["block"], r["digest"])
                    rows.append({"record_id": r["record_id"], "type": r["type"], "uri": r["uri"],
                                 "refers_to": r["refers_to"],
                                 "payload": payload if with_payload else None,
                                 "payload_bytes": size, "payload_digest": digest, "problem": problem})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return blocks.mapInArrow(run, PAYLOAD_SCHEMA)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per response or revisit record of the archives."""
    return decode(reassemble(read_records(spark, path)), with_payload)


def page_number(record_id: Column) -> Column:
    """The page_id in ``<urn:page:ID>`` or ``<urn:page:ID#copy>``."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?\d*)", 1), F.lit("")).cast("bigint")
