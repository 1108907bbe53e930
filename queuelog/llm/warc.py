"""WARC archives: a writer with revisit records and a reader that splits archives into byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import rows_of, staged, table
from queuelog.model import scratch_path

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive that one task scans, and by which it reads on for a record that goes further.
RANGE, STEP = 4 << 20, 256 << 10
#: A record's header block is at most so long.
MAX_HEADER = 1 << 20

RECORDS = (
    "path string, offset bigint, length bigint, record_type string, record_id string, target_uri string, "
    "page_id bigint, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder: local, hdfs, s3 (s3a) or gs."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One gzip member with one record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    body = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


def write_archives(
    pages: DataFrame, folder: str, *, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write one record per row below ``folder``; returns the manifest ``path, bytes, records``.

    Payload: the text in UTF-8, empty for null. Of the rows with equal payloads of ``min_bytes`` or
    more, the one with the largest page_id is the response and the others are revisits of it; several
    rows with that same page_id, and rows of a group without any page_id, are all responses. Null
    urls give no target line. An empty table gives no archive. Other columns are ignored.

    A task writes archives under names of its own attempt, and only the manifest, written by Spark,
    tells which count: a lost or repeated task leaves at worst a file that nobody reads.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    big = F.octet_length("payload") >= min_bytes
    top = rows.where(big).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    top = top.where("n > 1").select(F.col("digest").alias("_digest"), "top")
    rows = rows.join(top, (F.col("digest") == F.col("_digest")) & big, "left").select("page_id", "url", "payload", "digest", "top")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = store(folder)
        files.create_dir(place, recursive=True)
        out, path, size, n = None, "", 0, 0
        for p, u, data, raw, first in rows_of(batches):
            if out is None:
                path = f"{place}/{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                out = files.open_output_stream(path, compression=None)
            revisit = first is not None and p != first
            member = record(p, u, data, base64.b32encode(raw).decode(), first, revisit, date)
            out.write(member)
            size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": n}])

    return staged(rows.mapInArrow(write, "path string, bytes bigint, records bigint"), "manifest")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class _Range:
    """Bytes of an archive from ``start`` on, read further as records need it."""

    def __init__(self, file, start: int, end: int):
        self.file, self.start, self.end = file, start, end
        file.seek(start)
        self.data = bytearray(file.read(end - start + len(MAGIC) - 1))

    def more(self) -> bool:
        piece = self.file.read(STEP)
        self.data += piece
        return bool(piece)

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The record that starts at byte ``at`` of the range and its length in the file; None where
        the bytes are no member that opens with a whole WARC header."""
        unpack, out, fed, valid = zlib.decompressobj(31), bytearray(), at, False
        while not unpack.eof:
            if fed >= len(self.data) and not self.more():
                break
            piece = bytes(self.data[fed : fed + (STEP if valid else 1024)])
            try:
                out += unpack.decompress(piece)
            except zlib.error as e:
                if valid:
                    raise ValueError(f"broken record at byte {self.start + at}: {e}") from e
                return None
            fed += len(piece)
            if not valid:
                if not out.startswith(b"WARC/"[: len(out)]) or b"\r\n\r\n" not in out and len(out) > MAX_HEADER:
                    return None
                valid = out.startswith(b"WARC/") and b"\r\n\r\n" in out
        if not unpack.eof:
            if valid:
                raise ValueError(f"record cut off at byte {self.start + at}")
            return None
        return (bytes(out), fed - at - len(unpack.unused_data)) if valid else None

    def records(self) -> Iterator[tuple[int, int, bytes]]:
        """Offset, length and content of every record that starts in the range."""
        at, last = 0, self.end - self.start
        while 0 <= (at := self.data.find(MAGIC, at)) < last:
            if (found := self.member(at)) is None:
                at += 1
                continue
            yield self.start + at, found[1], found[0]
            at += found[1]
            if at >= last:
                return


def parse(path: str, offset: int, length: int, content: bytes, keep: bool) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    number = lambda name: int(fields[name]) if name in fields else None
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, size = fields.get("warc-payload-digest", "").removeprefix("sha1:"), number("x-payload-length")
    if fields["warc-type"] == "response":
        size, found = len(payload), base32_sha1(payload)
        if digest not in ("", found):
            raise ValueError(f"{path}, byte {offset}: the payload's digest is {found}, the header says {digest}")
        digest = found
    return {
        "path": path, "offset": offset, "length": length, "record_type": fields["warc-type"],
        "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
        "page_id": number("x-page-id"), "payload_bytes": size, "payload_digest": digest,
        "refers_to": number("x-refers-to-page-id"), "payload": payload if keep else None,
    }


def read_archives(archives: DataFrame, folder: str, *, range_bytes: int = RANGE, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``path, bytes`` of a manifest, one row each.

    Every archive is cut into ranges of ``range_bytes``. A task looks for the gzip magic in its range,
    takes a place for a record only if its first bytes inflate to a WARC header, and owns the records
    that start in the range, reading past its end for the last one. A payload whose digest differs
    from its header, or a record cut short, is an error.
    """
    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()),
        ("record_id", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    cuts = archives.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start")
    )
    cuts = cuts.select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    cuts = cuts.repartition(max(1, cuts.count()))  # a task per range

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(folder)
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(path) as file:
                    rows, held = [], 0
                    for offset, length, content in _Range(file, start, end).records():
                        rows.append(parse(path, offset, length, content, payloads))
                        held += len(content) if payloads else 256
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return cuts.mapInArrow(read, RECORDS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    found = read_archives(manifest, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
    max(page_id) OVER (PARTITION BY sha1(body)) AS top
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS BIGINT), 1)),
    lambda a, b: a || b) AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""
