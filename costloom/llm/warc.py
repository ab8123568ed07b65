"""WARC archives: writing with segmentation and revisits, reading with segment reassembly.

*Writing.* Of records with equal payloads of at least ``LEAST_BYTES``, the smallest page id is a ``response`` and the others become
``revisit`` records that name it. A record's block is an HTTP header and the payload in chunked transfer framing, cut into segments of ``SEGMENT`` bytes: the first carries the record's type, the others are ``continuation`` records with
the first one's id and their number, the last of them with the total length. Archives are written by Spark's own text writer, with the
record end as line separator, so that each task's files are committed once however often it is tried, and
hold ``RECORDS`` segments at most, which bounds a file.

*Reading.* Files are parsed by the lengths in their headers; gzip, whole or by members, is unpacked piece by piece. Segments of records in several pieces
are grouped by origin id, ordered by number, checked for gaps and for the total length, and joined; whole records take no
part in that shuffle. Then the chunked framing is decoded and the payload's digest checked.

Null payloads are empty; null urls give no target URI; null page ids are carried as no page header and never chosen as
response of a group with ids. Rows with equal page ids and payloads are all responses if they are the group's smallest. An
empty table gives an archive without records. A record with a gap, a wrong length, framing or digest, or cut short, has ``error`` set instead of a payload; so have
junk between records and a gzip member that ends too early, as rows without a record id. The records after them are read.
Payloads may be as long as a Spark value may be. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.spread import grouped_for_join

CRLF = b"\r\n"
LEAST_BYTES = 100
SEGMENT = 16 << 10
CHUNK = 4 << 10
READ = 1 << 20
RECORDS = 4096
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PLAIN = re.compile(r"[^\x21-\x7E]")
SEGMENTS = ("record_id string, kind string, page_id long, payload_digest string, refers_to long, uri string, origin string, number int, "
            "total long, whole boolean, length long, block binary, error string")
RECORD = ("record_id string, page_id long, uri string, kind string, refers_to long, payload binary, payload_bytes long, "
          "payload_digest string, segments int, error string")


# ---- framing ---------------------------------------------------------------

def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    out = [b"%x\r\n%s\r\n" % (len(part), part) for part in (payload[k:k + size] for k in range(0, len(payload), size))]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload in chunked framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size: at + size + 2] != CRLF:
            raise ValueError("chunk length")
        out.append(body[at: at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block), b"", block]
    return CRLF.join(lines)


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, unique: str,
            segment: int = SEGMENT) -> Iterator[bytes]:
    """The segments of one page's record, without the record end."""
    uri = None if url is None else _PLAIN.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8", "surrogatepass")), url)
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + CRLF if revisit else http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    made = [block[k:k + segment] for k in range(0, len(block), segment)]
    name = lambda k: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{unique}/{k}')}>"
    date = "2024-01-01T00:00:00Z"
    for k, part in enumerate(made):
        last = k and k + 1 == len(made)
        if k:
            head = [("WARC-Type", "continuation"), ("WARC-Segment-Origin-ID", name(0)), ("WARC-Segment-Total-Length", len(block) if last else None)]
        else:
            head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-ID", page_id),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
                    ("X-Refers-To-Page-ID", refers_to), ("X-Payload-Length", len(payload)),
                    ("Content-Type", "application/http; msgtype=response")]
        yield _record([("WARC-Record-ID", name(k)), ("WARC-Date", date), ("WARC-Target-URI", uri), *head,
                       ("WARC-Segment-Number", k + 1 if len(made) > 1 else None)], part)


# ---- writing ---------------------------------------------------------------

def with_references(pages: DataFrame, payload: str = "html", page_id: str = "page_id", url: str = "url", least: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``.

    Only payloads that several rows share are looked up; the smallest id of each is found with a sum on the map side.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = grouped_for_join(rows.filter(F.octet_length("payload") >= least), ["digest"], F.min("page_id").alias("__first"), F.count("*").alias("__n"))
    shared = shared.filter("__n > 1 and __first is not null").drop("__n")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("__first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("__first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, payload: str = "html", page_id: str = "page_id", url: str = "url", segment: int = SEGMENT) -> None:
    """Write the archive of ``pages`` to the folder ``path``."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, held = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                n += 1
                for record in records(*row, f"{row[0]}/{part}/{n}", segment):
                    out.append(record)
                    held += len(record)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    made = with_references(pages, payload, page_id, url).mapInArrow(run, "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


# ---- reading ---------------------------------------------------------------

class _Bytes:
    """The bytes of a file, those of its gzip members if it has any, read as they are asked for. ``damaged``: they end too early."""

    def __init__(self, data: bytes):
        self.source = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
        self.held, self.at, self.ended, self.damaged = b"", 0, False, False

    def ask(self, n: int) -> int:
        """Hold ``n`` bytes from the present place on, if there are so many; how many are held."""
        parts, have = [], len(self.held) - self.at
        while have < n and not self.ended:
            try:
                part = self.source.read1(READ)  # what was unpacked before a damaged place is not lost
            except (EOFError, OSError, zlib.error):
                part, self.damaged = b"", True
            self.ended = not part
            parts.append(part)
            have += len(part)
        if parts:
            self.held, self.at = b"".join([self.held[self.at:], *parts]), 0
        return have

    def find(self, what: bytes, begin: int = 0) -> int:
        """Offset of ``what`` from the present place on, -1 if it does not come; each byte is searched once."""
        while True:
            have = len(self.held) - self.at
            found = self.held.find(what, self.at + begin)
            if found >= 0:
                return found - self.at
            begin = max(begin, have - len(what) + 1)
            if self.ask(2 * have + READ) == have:
                return -1

    def starts(self, what: bytes) -> bool:
        return self.held.startswith(what, self.at)

    def take(self, n: int) -> bytes:
        out = self.held[self.at:self.at + n]
        self.at += len(out)
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers, with names in lower case, and blocks of all records, and what is wrong with them.

    What does not begin like a record is skipped up to the next line that does. A record whose length leads past the
    file's end, or to a place where no record ends, is cut before the next such line."""
    text = _Bytes(data)
    while text.ask(5):
        if text.starts(CRLF):
            text.take(2)
            continue
        if not text.starts(b"WARC/"):
            next_ = text.find(b"\nWARC/")
            text.take(text.ask(len(text.held) + READ) if next_ < 0 else next_ + 1)
            yield {}, b"", "no record"
            continue
        end = text.find(b"\r\n\r\n")
        if end < 0:
            text.take(text.ask(len(text.held) + READ))
            yield {}, b"", "record header"
            return
        lines = text.take(end + 4)[:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = head.get("content-length", "")
        if not size.isdecimal() or "warc-type" not in head:
            yield head, b"", "record header"
            continue
        size = int(size)
        have = text.ask(size + 2)
        if have < size or have > size and not text.held.startswith(CRLF, text.at + size):
            next_ = text.held.find(b"\r\nWARC/", text.at, text.at + min(have, size) + 7)
            yield head, text.take(min(have, size) if next_ < 0 else next_ - text.at), "cut short"
            continue
        yield head, text.take(size), None
    if text.damaged:
        yield {}, b"", "gzip member"


def segments(files: DataFrame) -> DataFrame:
    """``(content)`` of archive files to one row per segment."""
    def run(batches):
        import pyarrow as pa

        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in SEGMENTS.split(", "))])
        whole_number = lambda v: None if v is None or not re.fullmatch("-?[0-9]{1,18}", v) else int(v)
        for batch in batches:
            for data in batch.column("content"):
                rows, held = [], 0
                for head, block, damage in parse(data.as_py() or b""):
                    kind = head.get("warc-type")
                    if not damage and kind not in ("response", "revisit", "continuation"):
                        continue
                    record = head.get("warc-record-id")
                    number = whole_number(head.get("warc-segment-number"))
                    rows.append((record, kind, whole_number(head.get("x-page-id")), head.get("warc-payload-digest", "").removeprefix("sha256:"),
                                 whole_number(head.get("x-refers-to-page-id")), head.get("warc-target-uri"),
                                 head.get("warc-segment-origin-id", record), number or 1,
                                 whole_number(head.get("warc-segment-total-length")), number is None or damage is not None,
                                 whole_number(head.get("x-payload-length")), None if damage else block, damage))
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.select("content").mapInArrow(run, SEGMENTS)


def decoded(kind: str, block: bytes, digest: str) -> tuple[bytes | None, str | None]:
    """Payload of a complete record and what is wrong with it."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, "http header"
    if kind == "revisit":
        return None, None
    try:
        payload = unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(CRLF, b"\n")) else body
    except ValueError:
        return None, "chunked framing"
    if digest and hashlib.sha256(payload).hexdigest() != digest:
        return None, "payload digest"
    return payload, None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``. A revisit has the payload's digest and no payload."""
    return reassembled(segments(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)))


def reassembled(every: DataFrame) -> DataFrame:
    """Segments to whole records with their payloads decoded."""
    whole = every.filter("whole").select("record_id", "kind", "page_id", "payload_digest", "refers_to", "uri", "length", F.array("block").alias("blocks"),
                                         F.lit(1).alias("segments"), "error")
    # All pieces of one record are as long together as its payload was in its row.
    pieces = every.filter("not whole").groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block", "total"))).alias("s"),
        *(F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("kind", "page_id", "payload_digest", "refers_to", "uri", "length")))
    length = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    joined = pieces.withColumn("blocks", F.col("s.block")).withColumn("segments", F.size("s"))
    last = F.element_at("s", -1)
    error = (F.when(F.transform("s", lambda x: x["number"]) != F.sequence(F.lit(1), F.col("segments")), "missing segment")
             .when(last["total"].isNull(), "missing last segment")
             .when(last["total"] != length, "total length"))
    joined = joined.select(F.col("origin").alias("record_id"), "kind", "page_id", "payload_digest", "refers_to", "uri", "length", "blocks", "segments", error.alias("error"))

    def run(batches):
        import pyarrow as pa

        names = ("record_id", "page_id", "uri", "kind", "refers_to")
        for batch in batches:
            payloads, sizes, errors = [], [], []
            columns = (batch.column(c) for c in ("kind", "blocks", "payload_digest", "length", "error"))
            for kind, blocks, digest, length, wrong in (tuple(v.as_py() for v in row) for row in zip(*columns)):
                payload = None
                if not wrong:
                    payload, wrong = decoded(kind, b"".join(blocks), digest)  # the pieces are joined once, here
                payloads.append(payload)
                sizes.append(length if kind == "revisit" else None if payload is None else len(payload))
                errors.append(wrong)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()),
                 batch.column("payload_digest"), batch.column("segments"), pa.array(errors, pa.string())],
                names=[*names, "payload", "payload_bytes", "payload_digest", "segments", "error"])

    return whole.unionByName(joined).mapInArrow(run, RECORD)


def listing(found: DataFrame) -> DataFrame:
    """What an archive holds, one row per record; a revisit has the size and digest of the payload that it refers to."""
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to", "segments", "error")
