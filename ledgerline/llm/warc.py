"""WARC archives: one gzip member per record, written by Spark's own file writer and read back by byte ranges.

A range's task looks for the gzip magic, takes a candidate as a record only if its
first decoded bytes are a WARC header, and owns the records that start inside its
range, whatever their length. What it decodes is compared with the digests in the
headers.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, batch_of, pieces, staged
from ledgerline.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes read ahead, bytes looked through at once, and bytes of a candidate that must decode to the start of a header.
AHEAD = 4 << 20
WINDOW = 1 << 16
PROBE = 1 << 12

RECORDS = (
    "file string, offset long, record_type string, record_id string, target_uri string, date string,"
    " page_id long, refers_to_id string, payload_digest string, payload_bytes long"
)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the payload's SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _member(raw: bytes, level: int) -> bytes:
    """One gzip member; its last byte is zero, as that of every member below 16 MB of content.

    A longer record gets an empty member behind it, which readers pass over.
    """
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    member = packer.compress(raw) + packer.flush()
    if member[-1]:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        member += packer.flush()
    return member


def _uri(url: str) -> str:
    """The URL without characters that would end or split a header line."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def _record_id(page: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {kind}')}>"


def _record(kind: str, page: int | None, url: str | None, first: int | None, payload: bytes, date: str) -> bytes:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = http if kind == "revisit" else http + payload
    lines = [
        VERSION.decode("ascii"), f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page, digest, kind)}", f"WARC-Date: {date}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(first, digest, 'response')}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(batches: Iterator[pa.RecordBatch], date: str, level: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256, 8 << 20):
        kind, page, url, first = (batch.column(c).to_pylist() for c in ("kind", "page_id", "url", "first"))
        rows = zip(kind, page, url, first, as_bytes(batch.column("html")))
        # the writer puts a zero byte after each row, which is the member's last one
        members = [_member(_record(*row, date), level)[:-1] for row in rows]
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 3,
) -> None:
    """Write one record per row below ``path``, payload the html in UTF-8 (null: empty).

    Of rows with equal payloads of at least ``least_bytes`` the one with the
    largest id is a response and the others revisit it; shorter payloads are all
    responses. Rows that share that largest id are all responses, as are rows of a
    payload that only rows without id hold. Spark's text writer stores the members
    with the byte zero, each member's last, as its line end: so files are committed
    as any other output, and a repeated task leaves none twice.
    """
    raw = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), raw.alias("html")
    ).withColumn("print", F.sha2("html", 256))
    long = rows.filter(F.octet_length("html") >= least_bytes)
    groups = long.groupBy("print").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(later, "revisit").otherwise("response")
    (
        rows.join(groups.filter("n > 1").select("print", "first"), "print", "left")
        .select(kind.alias("kind"), "page_id", "url", "first", "html")
        .mapInArrow(lambda batches: _members(batches, date, level), "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", "\0")
        .text(path)
    )


class Source:
    """A file read from any place on; ``read(at, size)`` is asked for ``AHEAD`` bytes at a time."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read, self.start, self.held = read, 0, b""

    def fetch(self, at: int, size: int) -> bytes:
        if not self.start <= at or at + size > self.start + len(self.held):
            self.start, self.held = at, self.read(at, max(size, AHEAD))
        return self.held[at - self.start : at - self.start + size]


def _opened(path: str) -> Source:
    """A file of any store that Arrow reaches by its address."""
    from pyarrow import fs

    address = "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path
    store, name = fs.FileSystem.from_uri(address)
    file = store.open_input_file(name)
    return Source(lambda at, size: file.read_at(size, at))


def _starts_record(head: bytes) -> bool:
    """Whether bytes that begin with the gzip magic decode to the start of a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(head, len(VERSION)).startswith(b"WARC/")
    except zlib.error:
        return False


def _find(source: Source, start: int, stop: int) -> int | None:
    """The first record that starts in ``[start, stop)``."""
    head = source.fetch(start, PROBE) if start < stop else b""
    if head.startswith(MAGIC) and _starts_record(head):
        return start
    while start < stop:
        window = source.fetch(start, min(WINDOW, stop - start) + PROBE)
        at = window.find(MAGIC)
        while 0 <= at and start + at < stop and at < WINDOW:
            if _starts_record(window[at : at + PROBE]):
                return start + at
            at = window.find(MAGIC, at + 1)
        start += WINDOW
    return None


def _decoded(source: Source, start: int) -> tuple[bytes, int]:
    """Content of the member at ``start`` and where it ends; a damaged or cut one is an error."""
    unpacker, found, at, size = zlib.decompressobj(31), [], start, 1 << 14
    while not unpacker.eof:
        window = source.fetch(at, size)
        if not window:
            raise ValueError(f"the record at byte {start} is cut off")
        try:
            found.append(unpacker.decompress(window))
        except zlib.error as error:
            raise ValueError(f"the record at byte {start} is damaged: {error}") from error
        at += len(window)
        size = min(2 * size, AHEAD)
    return b"".join(found), at - len(unpacker.unused_data)


def records_in(source: Source, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers (names in lower case) and block of every record that starts in ``[start, stop)``."""
    at = _find(source, start, stop)
    while at is not None:
        raw, end = _decoded(source, at)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        headers = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        if len(rest) < size:
            raise ValueError(f"the record at byte {at} is shorter than its header says")
        yield at, headers, rest[:size]
        at = _find(source, end, stop)


def _row(file: str, at: int, headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of ``RECORDS``; payload digest and size are taken from the payload where there is one."""
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = headers.get("warc-type")
    http = headers.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    if kind == "revisit":
        digest, size, payload = told, None, None
    else:
        digest, size = payload_digest(payload), len(payload)
        if told is not None and told != digest:
            raise ValueError(f"the payload at byte {at} of {file} does not have the digest in its header")
    page = headers.get("page-id")
    row = (
        file, at, kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-date"),
        None if page is None else int(page), headers.get("warc-refers-to"), digest, size,
    )
    return (*row, payload) if with_payload else row


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    text, number = pa.string(), pa.int64()
    types = [text, number, text, text, text, text, number, text, text, number] + [pa.binary()] * with_payload
    schema = pa.schema([(f"c{i}", t) for i, t in enumerate(types)])
    for batch in batches:
        for file, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
            rows, held = [], 0
            for at, headers, block in records_in(_opened(file), start, stop):
                rows.append(_row(file, at, headers, block, with_payload))
                held += len(block) if with_payload else 0
                if len(rows) == 512 or held > 16 << 20:
                    yield batch_of(schema, *zip(*rows))
                    rows, held = [], 0
            if rows:
                yield batch_of(schema, *zip(*rows))


def read_records(spark: SparkSession, path: str, range_bytes: int = 32 << 20, with_payload: bool = False) -> DataFrame:
    """``RECORDS`` (and ``payload``) of every record in the files below ``path``.

    Files are cut into ranges of ``range_bytes``, whatever the records' sizes; each
    range is a task's work and yields the records that start in it. Members that
    are no WARC records are passed over; a record that is cut off, damaged or whose
    payload does not match its digest is an error. Files are opened by address, so
    the store must be one that Arrow knows. Stored content of a record that is
    itself an archive could be taken for records by a range that starts in it; text
    cannot, as the magic is not valid in it.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))
    ranges = files.select("path", "length", F.explode(starts).alias("start")).select(
        "path", "start", F.least("length", F.col("start") + range_bytes).alias("stop")
    )
    # as many tasks as ranges: by size alone these few small rows would share one
    spread = ranges.repartition(max(1, ranges.count()), "path", "start")
    kind = RECORDS + (", payload binary" if with_payload else "")
    return spread.mapInArrow(lambda batches: _read(batches, with_payload), kind)


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: revisits with what they refer to.

    A revisit takes size and page of the response that its ``WARC-Refers-To``
    names; both are null if no such record was read.
    """
    responses = records.filter("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes")
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes")
    targets = named.join(revisits.select("refers_to_id").distinct(), "refers_to_id", "left_semi").dropDuplicates(["refers_to_id"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(
        revisits.join(targets, "refers_to_id", "left").select(*columns)
    )


def round_trip(pages: DataFrame, range_bytes: int = 32 << 20, **options) -> DataFrame:
    """Write ``pages`` as archives below the shared scratch folder, read them back and resolve revisits.

    One row per page. A null html is an empty payload, equal to other empty ones; a
    null id or url leaves its header out. An empty table gives an empty result.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return resolved(staged(read_records(pages.sparkSession, path, range_bytes), "records"))
