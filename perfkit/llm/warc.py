"""WARC archives, and reading them as a table of payload chunks.

Writing: pages are grouped by payload digest; of equal payloads the one with the smallest page_id
becomes a response record and the others revisit records that refer to it. Each task writes
gzip archives (a member per record), and the manifest names the archives of the tasks that
succeeded. Reading: an archive is decompressed as a stream and every payload comes out as rows
(record, chunk number, bytes, bytes so far, digest so far), so no payload is ever held whole; the
digest of the last chunk is checked against the record's header.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfkit.llm.common import scratch, ship, stored

CHUNK_BYTES = 1 << 20
#: An archive is closed when its payloads pass this size.
ARCHIVE_BYTES = 64 << 20
#: Payloads of fewer bytes are always response records.
MIN_REVISIT_BYTES = 0
GZIP_LEVEL = 1
#: Header lines are read in pieces of at most this size.
LINE_BYTES = 1 << 16
#: Pages carry no time of their own.
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

CHUNK_DDL = ("record_id string, page_id long, record_type string, refers_to long, chunk int, data binary, "
             "payload_bytes long, payload_digest string, last boolean")


def base32_sha1(h) -> str:
    return base64.b32encode(h.digest()).decode()


def _pieces(payload: memoryview) -> Iterator[memoryview]:
    for at in range(0, len(payload), CHUNK_BYTES):
        yield payload[at:at + CHUNK_BYTES]


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(record_id: str | None) -> int | None:
    """The page of a record id of this writer; None for any other id."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", record_id or "")
    return int(found[1]) if found and -2**63 <= int(found[1]) < 2**63 else None


class Archive:
    """Writes records to one stream, each as a gzip member, piece by piece."""

    def __init__(self, stream):
        self.stream, self.payload_bytes, self.records = stream, 0, 0

    def add(self, page_id: int | None, url: str | None, payload: memoryview, refers_to: int | None) -> None:
        digest = hashlib.sha1()
        for piece in _pieces(payload):
            digest.update(piece)
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload)}\r\n\r\n").encode()
        kind = "response" if refers_to is None else "revisit"
        body = payload if refers_to is None else payload[:0]
        head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}",
                f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~-._')}",
                f"WARC-Payload-Digest: sha1:{base32_sha1(digest)}"]
        if refers_to is not None:
            head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
        head += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(http) + len(body)}", "", ""]
        pack = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        self.stream.write(pack.compress("\r\n".join(head).encode() + http))
        for piece in _pieces(body):
            self.stream.write(pack.compress(piece))
        self.stream.write(pack.compress(b"\r\n\r\n") + pack.flush())
        self.payload_bytes += len(body)
        self.records += 1


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``refers_to``: the smallest page_id with an equal payload, if that is another one."""
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload).alias("sha"))
    # Stored, so that the join can split a payload that very many pages share.
    first = stored(keyed.where(F.octet_length("html") >= min_bytes).groupBy("sha")
                   .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select("sha", "first"), "first-payloads")
    joined = keyed.join(first, "sha", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in ``folder``; returns the stored manifest
    (file, records). Archives of lost or repeated task attempts are not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        made, archive, name = [], None, None
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*cols):
                if archive is not None and archive.payload_bytes >= ARCHIVE_BYTES:
                    archive.stream.close()
                    made.append((name, archive.records))
                    archive = None
                if archive is None:
                    store.create_dir(root, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    archive = Archive(store.open_output_stream(f"{root}/{name}", compression=None))
                archive.add(page_id.as_py(), url.as_py(), memoryview(html.as_buffer()), refers_to.as_py())
        if archive is not None:
            archive.stream.close()
            made.append((name, archive.records))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["file", "records"])

    return stored(mark_revisits(pages, min_bytes).mapInArrow(run, "file string, records long"), "archives")


def _headers(stream, limit: int | None = None) -> tuple[dict[str, str], int]:
    """Fields up to the empty line, and the bytes read: at most ``limit``, so never beyond the record."""
    out, used = {}, 0
    while limit is None or used < limit:
        line = stream.readline(LINE_BYTES if limit is None else min(LINE_BYTES, limit - used))
        used += len(line)
        if line in (b"\r\n", b"\n", b""):
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out, used


def _length(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("[0-9]{1,18}", text) else None


def _skip(stream, left: int, record_id: str | None) -> None:
    while left:
        data = stream.read(min(left, CHUNK_BYTES))
        if not data:
            raise ValueError(f"{record_id}: the archive ends inside the record")
        left -= len(data)


def read_records(stream) -> Iterator[tuple]:
    """Rows of CHUNK_DDL from a decompressed archive stream.

    Records of other kinds (warcinfo, request, ...) are skipped. Archives of other writers: page_id and
    refers_to are null where the id is not this writer's, a block that is not HTTP is payload from its
    first byte, only SHA-1 digests are checked, and a revisit without digest or length has nulls there.
    An archive that ends inside a record, or a record without a length, raises ValueError; one that
    ends inside a gzip member raises EOFError.
    """
    while line := stream.readline(LINE_BYTES):
        if not line.strip():
            continue
        if not re.fullmatch(rb"WARC/[0-9.]+", line.strip()):
            raise ValueError(f"not a record: {line[:40]!r}")
        head, _ = _headers(stream)
        left = _length(head.get("content-length"))
        record_id, kind = head.get("warc-record-id"), head.get("warc-type")
        if left is None:
            raise ValueError(f"{record_id}: no length")
        if kind not in ("response", "revisit"):
            _skip(stream, left, record_id)
            continue
        http = {}
        if head.get("content-type", "").lower().startswith("application/http"):
            status = len(stream.readline(min(left, LINE_BYTES)))
            http, used = _headers(stream, left - status)
            left -= status + used
        declared = head.get("warc-payload-digest", "")
        digest_there = declared[5:].upper() if declared.lower().startswith("sha1:") else None
        who = (record_id, _page_of(record_id), kind, _page_of(head.get("warc-refers-to")))
        if kind == "revisit":
            _skip(stream, left, record_id)
            yield (*who, 0, b"", _length(http.get("content-length")), digest_there, True)
            continue
        digest, size, chunk = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, CHUNK_BYTES))
            if len(data) < min(left, CHUNK_BYTES):
                raise ValueError(f"{record_id}: the archive ends inside the payload")
            left -= len(data)
            size += len(data)
            digest.update(data)
            so_far = base32_sha1(digest)
            if not left and digest_there and so_far != digest_there:
                raise ValueError(f"{record_id}: payload digest {so_far}, header {digest_there}")
            yield (*who, chunk, data, size, so_far, not left)
            chunk += 1
            if not left:
                break


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """The chunk table of the manifest's archives: one row per payload chunk, in order within a
    record; payload_bytes and payload_digest cover the payload up to and with the chunk. A
    revisit is one empty chunk with the size and digest of the payload it refers to."""
    names = [c.split(" ")[0] for c in CHUNK_DDL.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(),
             pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    rows, held = [], 0
                    for row in read_records(gzip.GzipFile(fileobj=raw)):
                        rows.append(row)
                        held += len(row[5])
                        if held >= CHUNK_BYTES or len(rows) >= 4096:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = max(1, manifest.count())
    numbered = manifest.select("file", F.row_number().over(Window.orderBy("file")).alias("i"))  # a row per file
    return numbered.repartitionById(files, (F.col("i") - 1).cast("int")).mapInArrow(run, CHUNK_DDL)


def warc_roundtrip(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``folder`` (default: the shared folder) and returns the
    chunk table read back from there.

    Null html is an empty payload, null url an empty target; a null page_id has a random record
    id, reads back as null, and revisits if its payload has a row with an id. Rows that repeat the
    smallest page_id of a payload are responses all. Extra columns are not written. An empty table
    writes no archive and gives an empty result.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    folder = folder if "://" in folder else f"file://{folder}"
    return read_warc(write_warc(pages, folder, min_bytes), folder)


ship(__name__)
