"""WARC archives: written as gzip members, read back by tasks that each scan a range of bytes.

A reader task looks for the gzip magic number in its range, accepts a place where a member
starts whose decoded bytes begin with WARC headers, and owns the records that start inside
its range; the last one may run past the range's end. So an archive of any size is read in
parallel without an index, and a lost task is rerun on its range alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import sliced


# Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# A gzip member of nothing. The text sink puts it after each record; gzip readers see no bytes.
_NOTHING = zlib.compressobj(9, zlib.DEFLATED, 31)
EMPTY_MEMBER = _NOTHING.compress(b"") + _NOTHING.flush()

RANGE_BYTES = 16 * 1024 * 1024
_STEP = 1024 * 1024
_BATCH_BYTES = 8 * 1024 * 1024

RECORD_FIELDS = (
    "record_id string, record_type string, refers_to string, target_uri string, "
    "payload_bytes bigint, payload_digest string, payload binary, file string, offset bigint"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, html: bytes, refers_to, revisit: bool, digest: str, date: str) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n"
    block = head.encode() if revisit else head.encode() + html
    fields = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        fields.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if revisit:
        fields += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
    parts = ("\r\n".join(fields).encode() + b"\r\n\r\n", block, b"\r\n\r\n")
    return b"".join(map(gzip.compress, parts)) + gzip.flush()


_URL_SAFE = "".join(map(chr, range(0x21, 0x7F)))


def write_archives(
    pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url",
    html: str = "html", date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one record per row; of equal payloads only that with the largest id is kept whole.

    The others become revisits of it. A null html is an empty payload. Rows with the
    largest id of their payload (several if the id repeats, or all if no id is known) are
    all responses; a null id counts as the smallest. Other columns are not looked at.
    """
    source = pages.select(
        pages[f"`{page_id}`"].cast("long").alias("page_id"),
        pages[f"`{url}`"].cast("string").alias("url"),
        F.coalesce(pages[f"`{html}`"].cast("binary"), F.lit(b"")).alias("html"),
    ).withColumn("sha", F.sha1("html"))
    # only payloads that occur again are needed: few rows, one per payload
    largest = (
        source.groupBy("sha").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
        .where("n > 1").select("sha", "top")
    )
    known = source.join(largest, "sha", "left").select(
        "page_id", "url", "html", "sha", "top",
        F.expr("top is not null and (page_id is null or page_id < top)").alias("again"),
    )
    known = known.select(
        "page_id", "url", F.when(F.col("again"), F.lit(b"")).otherwise(F.col("html")).alias("html"),
        "sha", "top", "again", F.octet_length("html").alias("size"),
    )

    def members(batches):
        for batch in sliced(batches):
            out = []
            for row in batch.to_pylist():
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                body = _Sized(row["size"]) if row["again"] else row["html"]
                out.append(record(row["page_id"], row["url"], body, row["top"], row["again"], digest, date))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    written = known.mapInArrow(members, "member binary")
    # the text sink writes the bytes of a string as they are
    (written.select(F.col("member").cast("string"))
     .write.option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(folder))


class _Sized:
    """Stands for a payload that is not written, of which only the length is told."""

    def __init__(self, size: int):
        self._size = size

    def __len__(self) -> int:
        return self._size


def read_archives(
    spark: SparkSession, folder: str, *, range_bytes: int = RANGE_BYTES, payloads: bool = True
) -> DataFrame:
    """The records of all archives in a folder: ``RECORD_FIELDS``, a row per record.

    Digest and size are those of the payload read (of a revisit: those its headers tell,
    payload null). A digest other than the header's, or a record cut short, raises.
    Without ``payloads`` they are read and checked, but not returned.
    """
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start"))
    tasks = max(1, ranges.count())

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batched(_records(row["path"], row["length"], row["start"], range_bytes), payloads)

    return ranges.repartition(tasks).mapInArrow(run, RECORD_FIELDS)


def _batched(records: Iterator[tuple], payloads: bool):
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
        ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()),
    ])
    rows, size = [], 0
    for row in records:
        payload = row[6] if payloads else None
        rows.append((*row[:6], payload, *row[7:]))
        size += 500 + len(payload or b"")
        if size >= _BATCH_BYTES:
            yield _batch(rows, schema)
            rows, size = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows, schema):
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class _Window:
    """Bytes of a file from ``start`` on, read in steps; offsets are those of the file."""

    def __init__(self, stream, start: int, length: int):
        self.stream, self.start, self.length, self.data = stream, start, length, b""

    def upto(self, end: int) -> None:
        end = min(end, self.length)
        have = self.start + len(self.data)
        if end > have:
            self.stream.seek(have)
            self.data += self.stream.read(end - have)

    def find(self, pattern: bytes, at: int, end: int) -> int:
        found = self.data.find(pattern, at - self.start, end - self.start)
        return -1 if found < 0 else found + self.start

    def piece(self, at: int, size: int) -> bytes:
        self.upto(at + size)
        return self.data[at - self.start : at - self.start + size]


def open_input(path: str):
    """A file in any store that pyarrow opens, by its Hadoop-style URI."""
    from pyarrow import fs

    if ":/" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    scheme, rest = path.split(":", 1)
    store, inner = fs.FileSystem.from_uri(f"{scheme}://{rest.removeprefix('//')}")
    return store.open_input_file(inner)


def _records(path: str, length: int, start: int, range_bytes: int) -> Iterator[tuple]:
    end = min(length, start + range_bytes)
    with open_input(path) as stream:
        window = _Window(stream, start, length)
        window.upto(end + len(GZIP_MAGIC) - 1)
        at = start
        while (at := window.find(GZIP_MAGIC, at, end + len(GZIP_MAGIC) - 1)) >= 0:
            decoded = _member(window, at)
            if decoded is None:
                at += 1
                continue
            data, after = decoded
            yield (*_parsed(data, path, at), path, at)
            at = after


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The decoded member that starts there and where it ends; None if no record starts there."""
    inflate = zlib.decompressobj(31)
    out, step, position = [], 4096, at
    while not inflate.eof:
        piece = window.piece(position, step)
        if not piece:
            if out and out[0].startswith(b"WARC/"):
                raise ValueError(f"archive ends inside the record at byte {at}")
            return None
        try:
            out.append(inflate.decompress(piece))
        except zlib.error as error:
            if out and b"".join(out).startswith(b"WARC/"):
                raise ValueError(f"damaged record at byte {at}: {error}") from error
            return None
        position += len(piece)
        if len(out) == 1:
            if not out[0].startswith(b"WARC/"[: max(1, len(out[0]))]):
                return None
            step = _STEP
    data = b"".join(out)
    return (data, position - len(inflate.unused_data)) if data.startswith(b"WARC/") else None


_FIELD = re.compile(r"(?m)^([^:\r\n]+):[ \t]*([^\r\n]*)")


def _headers(head: bytes) -> dict[str, str]:
    return {name.lower(): value for name, value in _FIELD.findall(head.decode("utf-8", "replace"))}


def _parsed(data: bytes, path: str, at: int) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "revisit":
        size, digest, payload = int(_headers(http)["content-length"]), told, None
    else:
        size, digest = len(payload), base32_sha1(payload)
        if told and told != digest:
            raise ValueError(f"{path}: payload digest of the record at byte {at} does not match")
    return (
        fields["warc-record-id"], kind, fields.get("warc-refers-to"),
        fields.get("warc-target-uri"), size, digest, payload,
    )


def page_of(urn):
    """The page id in a record id (null if it tells none)."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
