"""WARC records: round trips, reassembly, damaged archives."""

import base64
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnstile.llm import warc
from turnstile.llm.common import shared_path, table

SCHEMA = "page_id bigint, url string, html string, digest int, refers_to string"


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, h in rows:
        data = (h or "").encode()
        f = first.get(h or "")
        revisit = len(data) >= min_bytes and f is not None and i != f
        out.append((i, len(data), sha(data), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, pages, **options):
    path = shared_path(spark, "test-warc")
    warc.write_archives(pages, path, **options)
    return path, warc.read_archives(spark, path)


def summary(back):
    rows = back.select(warc.page_number(back.record_id), "payload_bytes", "payload_digest", "type",
                       warc.page_number(back.refers_to), "problem").collect()
    assert all(r[5] is None for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


def test_round_trip_of_pages(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    # Small segments and files, so that segments of a record lie in several files.
    path, back = round_trip(spark, pages.repartition(4), segment_bytes=700, records_per_file=9, chunk_bytes=97)
    assert summary(back) == expected(rows)
    got = {r.record_id: bytes(r.payload) for r in back.where("type = 'response'").collect()}
    want = {h.encode() for _, h in rows}
    assert set(got.values()) == want
    parts = warc.read_records(spark, path)
    assert parts.where("type = 'continuation'").count() > 100


def test_odd_pages(spark):
    same = "same " * 500
    rows = [(1, "u", ""), (2, None, None), (None, "u\r\nv", "no id"), (None, "u", "no id either"),
            (3, "u", "no id"), (4, "u", same), (5, "u", same), (5, "u", same), (4, "u", same),
            (6, "u", "WARC/1.1\r\n\r\n\r\nContent-Length: 9\r\n\r\n"), (7, "u", "ü🙂" * 60_000), (8, "u", "\r\n\r\n")]
    pages = spark.createDataFrame([(i, u, h, 3, "x") for i, u, h in rows], SCHEMA)
    for options in ({}, {"segment_bytes": 100, "chunk_bytes": 31}, {"min_bytes": 100}):
        _, back = round_trip(spark, pages, **options)
        assert summary(back) == expected([(i, h) for i, _, h in rows], options.get("min_bytes", 0))
    _, back = round_trip(spark, spark.createDataFrame([], SCHEMA))
    assert back.count() == 0


def test_base32_of_hex(spark):
    from pyspark.sql import functions as F

    data = [random.Random(i).randbytes(i) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in data], "d binary")
    got = {bytes(r[0]): r[1] for r in df.select("d", warc.base32_of_hex(F.sha1("d"))).collect()}
    assert got == {d: sha(d) for d in data}


@settings(max_examples=200, deadline=None)
@given(payload=st.binary(max_size=400), chunk=st.integers(1, 50), segment=st.integers(40, 120))
def test_chunks_and_segments(payload, chunk, segment):
    assert warc.unchunk(warc._chunked(payload, chunk)) == payload
    records = warc.page_records(9, "u", payload, sha(payload), None, "0-0", segment, chunk)
    parsed = list(warc.parse_records(b"".join(r + warc.END for r in records)))
    block = b"".join(p["block"] for p in parsed)
    assert warc.payload_of("response", block, sha(payload)) == (payload, len(payload), sha(payload), None)
    if len(parsed) > 1:
        assert parsed[-1]["total"] == len(block)
        assert [p["segment"] for p in parsed] == list(range(1, len(parsed) + 1))


@pytest.mark.parametrize("body, payload", [
    (b"5;name=x\r\nhello\r\n0\r\n\r\n", b"hello"), (b"0\r\nTrailer: y\r\n\r\n", b""),
    (b"5\r\nhell", None), (b"x\r\nhello\r\n0\r\n\r\n", None), (b"5\r\nhelloXX0\r\n\r\n", None), (b"", None),
    (b"-1\r\nhello\r\n0\r\n\r\n", None)])
def test_unchunk(body, payload):
    assert warc.unchunk(body) == payload


def test_damaged_records_are_reported(spark):
    payload = b"0123456789" * 40
    def cut(copy):
        return warc.page_records(int(copy), "u", payload, sha(payload), None, copy, 150, 64)
    a, b, c, d, e = (cut(str(k)) for k in range(1, 6))
    wrong = [x.replace(b"Total-Length: ", b"Total-Length: 1") for x in c]
    flipped = [x.replace(b"0123", b"0124", 1) for x in e]
    whole = warc.page_records(6, "u", payload, sha(payload), None, "6", 10_000, 64)
    records = a + b[:1] + b[2:] + wrong + d + [d[1]] + flipped + whole
    random.Random(1).shuffle(records)
    data = b"".join(r + warc.END for r in records) + b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort"
    rows = [(r.get("record_id"), r.get("type"), r.get("uri"), r.get("digest"), r.get("refers_to"),
             r.get("origin"), r.get("segment"), r.get("total"), r.get("block"), r["problem"])
            for r in warc.parse_records(data)]
    back = warc.decode(warc.reassemble(spark.createDataFrame(rows, warc.RECORD_SCHEMA)))
    got = {r[0]: (r[1], r[2]) for r in back.select(
        warc.page_number(back.record_id), "problem", "payload").collect()}
    assert got[1] == (None, payload) and got[6] == (None, payload)
    assert {k: got[k][0] for k in (2, 3, 4, 5)} == {
        2: "missing segment", 3: "wrong total length", 4: "repeated segment", 5: "wrong payload digest"}
    assert got[None][0] == "truncated record"
    assert all(got[k][1] is None for k in (2, 3, 4, 5, None))
