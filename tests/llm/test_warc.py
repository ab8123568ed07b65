import gzip
import hashlib

import pytest

from costloom.llm import warc
from costloom.llm.common import shared_folder

BIG = "<p>é𝒳</p>" * 9000
PAGES = [(1, "http://a/é x", "a" * 99), (2, None, "a" * 99), (5, "http://b", "b" * 100), (3, "http://c", "b" * 100), (4, "u", "b" * 100), (3, "http://c", "b" * 100),
         (6, "u", None), (7, "u", ""), (8, "u", BIG), (9, "u", BIG), (None, "u", "b" * 100), (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n" * 9),
         (11, "x\r\nInjected: 1", "q" * 40_000), (None, "u", "n" * 200)]
SCHEMA = "page_id long, url string, html string, digest string, payload string, number int"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "d", "p", 1) for r in rows], SCHEMA)


def expected(rows):
    out = []
    for i, _, text in rows:
        data = (text or "").encode()
        same = [k for k, _, t in rows if (t or "").encode() == data and k is not None]
        first = min(same) if same and len(data) >= 100 else None
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [64, 1000, warc.SEGMENT])
def test_round_trip(spark, segment):
    path = shared_folder(spark, "warc-test")
    warc.write_warc(pages(spark).repartition(3), path, segment=segment)
    found = warc.read_warc(spark, path)
    listed = warc.listing(found)
    assert sorted((tuple(r) for r in listed.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == expected(PAGES)
    assert listed.filter("error is not null").count() == 0
    texts = {r.page_id: bytes(r.payload).decode() for r in found.filter("kind = 'response'").collect() if r.page_id}
    assert texts[8] == BIG and texts[10] == PAGES[11][2] and texts[6] == ""
    assert found.filter("page_id = 8").first().segments > 1


def test_empty_table(spark):
    path = shared_folder(spark, "warc-test")
    warc.write_warc(pages(spark).limit(0), path)
    assert warc.read_warc(spark, path).count() == 0


@pytest.mark.parametrize("size", [1, 5, 4096])
def test_chunked_framing(size):
    for payload in (b"", b"x", b"\r\n0\r\n\r\n" * 50, bytes(range(256)) * 20):
        assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_damaged_records_are_reported(spark):
    made = list(warc.records(1, "u", b"z" * 500, hashlib.sha256(b"z" * 500).hexdigest(), None, "k", 200))
    other = list(warc.records(2, "u", b"y" * 500, hashlib.sha256(b"n").hexdigest(), None, "m", 10_000))
    short = list(warc.records(3, "u", b"x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), None, "n", 200))
    cut = list(warc.records(4, "u", b"w" * 500, hashlib.sha256(b"w" * 500).hexdigest(), None, "o", 200))
    records = [made[2], made[0], *other, *short[:-1], *cut[::-1]]
    data = b"".join(gzip.compress(r + b"\r\n\r\n") for r in records)
    files = spark.createDataFrame([(bytearray(data),)], "content binary")
    got = {r.page_id: (r.error, r.payload and bytes(r.payload)) for r in warc.reassembled(warc.segments(files)).collect()}
    assert got == {1: ("missing segment", None), 2: ("payload digest", None), 3: ("missing last segment", None), 4: (None, b"w" * 500)}


def damaged(*records):
    return b"".join(r if isinstance(r, bytes) else r[0] + b"\r\n\r\n" for r in records)


def one(i, size=500):
    payload = b"%d" % i * size
    return list(warc.records(i, "u", payload, hashlib.sha256(payload).hexdigest(), None, f"k{i}", 1 << 20))


def test_a_damaged_file_costs_its_own_records_only(spark):
    cut = one(2)[0][:-300] + b"\r\n\r\n"
    bare = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 500\r\n\r\nshort"
    odd = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\n\r\n\r\n"
    plain = damaged(one(1), b"one line of junk\r\n", cut, one(3), odd, one(4), b"\x00\xff junk\n", one(5)[0], b"\r\n\r\n", bare)
    packed = gzip.compress(plain)
    files = [plain, packed, gzip.compress(damaged(one(6))) + gzip.compress(damaged(one(7)))[:-40], b"", b"no archive", None]
    made = spark.createDataFrame([(f if f is None else bytearray(f),) for f in files], "content binary")
    found = warc.reassembled(warc.segments(made)).collect()
    whole = sorted(r.page_id for r in found if r.error is None)
    assert whole == sorted([1, 3, 4, 5] * 2 + [6])
    errors = sorted(r.error for r in found if r.error)
    assert errors.count("cut short") >= 4 and errors.count("record header") == 2 and errors.count("no record") >= 3
    assert "gzip member" in errors
    assert all(r.payload is None for r in found if r.error)


def test_reading_is_linear_in_a_page(spark):
    import time

    took = {}
    for mb in (4, 32):
        text = "x" * (mb << 20)
        path = shared_folder(spark, "warc-test")
        warc.write_warc(pages(spark, [(1, "u", text)]), path)
        start = time.time()
        r = warc.read_warc(spark, path).first()
        took[mb] = time.time() - start
        assert (r.error, r.payload_bytes, bytes(r.payload[-9:])) == (None, mb << 20, b"x" * 9) and r.segments > 100
    assert took[32] < 20 * took[4]
