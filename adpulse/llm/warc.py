"""WARC archives: written by Spark, read back with segmented records put together and chunked framing decoded."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize

SEGMENT = 16_384        # bytes of a block in one record; longer blocks go on in continuation records
CHUNK = 4_096           # bytes of a chunk of the transfer framing
FILE_RECORDS = 4_096    # records of a file, so at most some 70 MB of blocks
SAME_FROM = 100         # bytes from which an equal payload is a revisit
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
PARSED = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload binary, problem string"
SEGMENTS = "origin string, segment int, total long, record_type string, target_uri string, payload_digest string, block binary, problem string"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0" + END


def dechunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; a ValueError where the framing is broken or cut short."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        out.append(body[at:at + size])
        at += size + 2


def _head(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def records_of(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page, each without the blank lines that end it.

    A page that refers to an equal one is a revisit with the head of the answer only. Any other is a response,
    cut into a first record and continuations where its block is longer than ``segment``.
    """
    uri = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *common, ("WARC-Refers-To", refers_to),
               ("WARC-Profile", IDENTICAL), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
        return [_head(own) + block]
    block += chunked(payload)
    cuts = range(0, len(block), segment)
    out = []
    for n, at in enumerate(cuts, 1):
        part = block[at:at + segment]
        first, many = n == 1, len(cuts) > 1
        out.append(_head([
            ("WARC-Type", "response" if first else "continuation"),
            ("WARC-Record-ID", record_id if first else f"{record_id[:-1]}:{n}>"), *common,
            ("WARC-Segment-Origin-ID", None if first else record_id),
            ("WARC-Segment-Number", n if many else None),
            ("WARC-Segment-Total-Length", len(block) if many and n == len(cuts) else None),
            ("Content-Type", "application/http; msgtype=response" if first else None), ("Content-Length", len(part)),
        ]) + part)
    return out


def write_warc(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` to compressed archives in the folder ``path``.

    Among equal payloads of at least :data:`SAME_FROM` bytes that with the smallest ``page_id`` (null: last; of
    repeated rows one) is the response, all others are revisits that refer to it. A null html is an empty payload, a
    null url is ``about:blank``. Record ids are ``<urn:page:ID:ROW>``, so rows that share an id stay apart. Spark's own
    writer commits the files, on any file system it knows. ``pages`` has to be a table or another plan that gives
    the same rows in the same partitions when it runs again.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                         F.monotonically_increasing_id().alias("row"))
    order = F.struct(F.col("page_id").isNull(), "page_id", "row")
    firsts = keyed.where(F.octet_length("payload") >= SAME_FROM).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    # written first: two plain shuffles meet in the join then, so adaptive execution can split a hot payload
    firsts = materialize(firsts.where("n > 1").selectExpr("digest", "first.page_id AS first_id", "first.row AS first_row"), "firsts")
    named = lambda page, row: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col(row), F.lit(">"))
    rows = keyed.join(firsts, "digest", "left").select(
        named("page_id", "row").alias("record_id"), "url", "payload", "digest",
        F.when(F.col("first_row") != F.col("row"), named("first_id", "first_row")).alias("refers_to"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = [r for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)) for r in records_of(*row, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    # a record's closing blank lines are the writer's line separator; its bytes pass through as they are
    records = rows.mapInArrow(build, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


class _Bytes:
    """Plain or gzip bytes (one member or many) read from front to back, without holding all that they unpack to."""

    def __init__(self, data: bytes) -> None:
        self.rest, self.at, self.ready = data, 0, bytearray()
        self.gzip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        part = self.rest[self.at:self.at + (1 << 16)]
        self.at += len(part)
        if not part:
            return False
        while self.gzip and part:
            try:
                self.ready += self.gzip.decompress(part)
            except zlib.error:  # what can't be unpacked ends the archive
                self.rest = b""
                return False
            part = self.gzip.unused_data
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
        self.ready += part
        return True

    def take(self, size: int) -> bytes:
        while len(self.ready) < size and self._more():
            pass
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out

    def until(self, mark: bytes) -> bytes | None:
        """All up to ``mark``, which is passed over; None where nothing is left."""
        start = 0
        while (found := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self._more():
                return None if not self.ready.strip() else self.take(len(self.ready))
        out = bytes(self.ready[:found])
        del self.ready[:found + len(mark)]
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """``(fields, block, problem)`` of each record of an archive; names of fields in lower case.

    What is cut short is given as far as it goes, with a problem. Bytes that are no record end the archive.
    """
    source = _Bytes(data)
    while (head := source.until(END)) is not None:
        version, *lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not version.startswith("WARC/") or not fields.get("content-length", "").isdigit():
            yield {}, b"", "not a record"
            return
        size = int(fields["content-length"])
        block = source.take(size)
        yield fields, block, None if len(block) == size and source.take(4) == END else "cut short"


def payload_of(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    """The payload of an HTTP answer, and what is wrong with it; ``digest`` is checked if it is a SHA-256."""
    head, found, body = block.partition(END)
    if not found:
        return None, "no head"
    try:
        if re.search(rb"(?im)^transfer-encoding:[^\r]*\bchunked\b", head):
            body = dechunked(body)
    except ValueError:
        return None, "broken chunks"
    if digest and digest.startswith("sha256:") and sha256(body).hexdigest() != digest[7:]:
        return body, "digest differs"
    return body, None


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _in_batches(rows: Iterator[tuple], schema: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, bytes_held = [], 0
    for row in rows:
        held.append(row)
        bytes_held += 200 + sum(len(v) for v in row if isinstance(v, bytes))
        if bytes_held > size:
            yield _batch(held, schema)
            held, bytes_held = [], 0
    if held:
        yield _batch(held, schema)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isdigit() else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, record_type, target_uri, refers_to, payload_digest, payload, problem)`` of archives below ``path``.

    Files are plain or gzip, at most 2 GB each, every file read by one task. Records whose block stands in one record
    are decoded where they are read; the others are grouped by the id of their first record, put in the order of
    their segment numbers, held against the total length and decoded then, so only they are shuffled. Equal copies of
    a segment count once. The payload of a revisit is null, see :func:`resolve`. Records that are cut, incomplete, of
    the wrong length, wrongly framed or not of their digest have a ``problem`` and are not left out.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
        for batch in batches:
            for data in batch.column(0):
                yield from parse(data.as_py())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for f, block, problem in records(batches):
                if "warc-segment-number" in f:
                    continue
                payload, digest = None, f.get("warc-payload-digest")
                if not problem and f.get("warc-type") == "response":
                    payload, problem = payload_of(block, digest)
                yield f.get("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri"), f.get("warc-refers-to"), digest, payload, problem

        return _in_batches(rows(), PARSED)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for f, block, problem in records(batches):
                if "warc-segment-number" in f:
                    yield (f.get("warc-segment-origin-id", f.get("warc-record-id")), _number(f["warc-segment-number"]),
                           _number(f.get("warc-segment-total-length")), f.get("warc-type"), f.get("warc-target-uri"),
                           f.get("warc-payload-digest"), block, problem)

        return _in_batches(rows(), SEGMENTS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for origin, parts in zip(batch.column(0), batch.column(1)):
                    origin, parts = origin.as_py(), parts.as_py()
                    first, block = parts[0], b"".join(p["block"] for p in parts)
                    payload, problem = None, next((p["problem"] for p in parts if p["problem"]), None)
                    if [p["segment"] for p in parts] != [*range(1, len(parts) + 1)] or parts[-1]["total"] is None:
                        problem = problem or "segments missing"
                    elif parts[-1]["total"] != len(block):
                        problem = problem or "wrong total length"
                    if not problem:
                        payload, problem = payload_of(block, first["payload_digest"])
                    yield origin, first["record_type"], first["target_uri"], None, first["payload_digest"], payload, problem

        return _in_batches(rows(), PARSED)

    part = F.struct("segment", "total", "record_type", "target_uri", "payload_digest", "block", "problem")
    segments = files.mapInArrow(cut, SEGMENTS).groupBy("origin").agg(F.sort_array(F.collect_set(part)).alias("parts"))
    return files.mapInArrow(whole, PARSED).unionByName(segments.mapInArrow(join, PARSED))


def resolve(records: DataFrame) -> DataFrame:
    """``(record_id, record_type, refers_to, payload_digest, payload_bytes, problem)``: each record with its full payload's size
    and bare hash, revisits with those of the record they refer to.

    ``records`` holds ``record_id, record_type, refers_to, payload_digest, payload_sha256, payload_bytes, problem`` as a stored
    table, so that a record which very many revisits name can be split by adaptive execution. A revisit whose record is missing
    or has another hash has a ``problem``.
    """
    plain = ["record_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "problem"]
    full = records.where("record_type <> 'revisit'")
    named = full.selectExpr("record_id AS refers_to", "payload_sha256 AS known", "payload_bytes AS size")
    back = records.where("record_type = 'revisit'").drop("payload_bytes").join(named, "refers_to", "left").selectExpr(
        "record_id", "record_type", "refers_to", "known AS payload_digest", "size AS payload_bytes",
        "coalesce(problem, CASE WHEN known IS NULL THEN 'no record' WHEN 'sha256:' || known <> payload_digest THEN 'digest differs' END) AS problem")
    return full.withColumn("payload_digest", F.col("payload_sha256")).select(plain).unionByName(back.select(plain))
