"""WARC archives: written and read back by parallel tasks, one gzip member per record.

Each task writes archives of its own, rolled over at ``max_archive_bytes``. A
reader takes one archive sequentially: compressed bytes are inflated piece by
piece, a member's end closes a record, the record's Content-Length frames its
block, and block and payload digests are checked (a mismatch fails the task).

Among records with equal payloads of at least ``min_payload`` bytes the one
with the smallest page id is a response; the others are revisits that refer to
it and carry only the HTTP headers.

Defined cases: a null html is an empty payload; a null url gives no target
header and reads back as null; rows repeating the smallest page id are all
responses; a null page id is larger than any other (several of them alone are
all responses); no rows give no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import utf8
from strata.llm.files import create, open_file

MAX_ARCHIVE_BYTES = 512 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
_PIECE = 1 << 20
_BATCH_BYTES = 8 << 20
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [("WARC-Type", kind), ("WARC-Date", WARC_DATE), *headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))).replace("%", ""))))
    if refers_to is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], http)


def mark_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (the response's page id; null for responses)."""
    rows = pages.select("page_id", "url", utf8(F.col("html")).alias("payload")).withColumn("__sha", F.sha1("payload"))
    copies = (rows.where(F.length("payload") >= min_payload).groupBy("__sha")
              .agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("__first"))
    return (rows.join(copies, "__sha", "left")
            .select("page_id", "url", "payload", F.when(F.col("__first").isNotNull() & later, F.col("__first")).alias("refers_to")))


def write_archives(marked: DataFrame, folder: str, max_archive_bytes: int = MAX_ARCHIVE_BYTES) -> DataFrame:
    """Write ``mark_revisits`` rows; (file, bytes, records) per archive. Stage the result: each evaluation writes anew."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, size, n, done = None, "", 0, 0, []
        try:
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
                for i in range(batch.num_rows):
                    if out is None:
                        uri, out = create(folder, "pages", ".warc.gz")
                        info = record("warcinfo", [("WARC-Record-ID", f"<urn:archive:{uri.rsplit('-', 1)[1]}>"), ("Content-Type", "application/warc-fields")],
                                      b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        size, n = len(info), 0
                    data = page_record(*(c[i].as_py() for c in columns))
                    out.write(data)
                    size, n = size + len(data), n + 1
                    if size >= max_archive_bytes:
                        out.close()
                        done.append((uri, size, n))
                        out = None
        finally:
            if out is not None:
                out.close()
                done.append((uri, size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["file", "bytes", "records"])

    return marked.mapInArrow(write, "file string, bytes long, records long")


def members(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The inflated content of each gzip member of a byte stream; an unfinished last member is an error."""
    unpack, parts = None, []
    for piece in pieces:
        while piece:
            if unpack is None:
                unpack, parts = zlib.decompressobj(16 + zlib.MAX_WBITS), []
            parts.append(unpack.decompress(piece))
            piece = b""
            if unpack.eof:
                piece = unpack.unused_data
                yield b"".join(parts)
                unpack = None
    if unpack is not None:
        raise ValueError("archive ends inside a gzip member")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; framing and block digest are checked."""
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(headers["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')}: content length {size} does not frame its block")
    if headers.get("warc-block-digest", "") != f"sha1:{digest(block)}":
        raise ValueError(f"record {headers.get('warc-record-id')}: block digest differs")
    return headers, block


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_records(uri: str) -> Iterator[tuple]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of each page record, in order."""
    from urllib.parse import unquote

    with open_file(uri) as f:
        for member in members(iter(lambda: f.read(_PIECE), b"")):
            h, block = parse(member)
            if h["warc-type"] == "warcinfo":
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            stated = h["warc-payload-digest"].removeprefix("sha1:")
            if h["warc-type"] == "response" and (len(payload) != length or digest(payload) != stated):
                raise ValueError(f"record {h['warc-record-id']}: payload differs from its length or digest")
            url = h.get("warc-target-uri")
            yield (_page(h["warc-record-id"]), None if url is None else unquote(url), length, stated, h["warc-type"],
                   _page(h.get("warc-refers-to")), payload if h["warc-type"] == "response" else None)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All page records of the archives named in column ``file``; each archive is read by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows, held = [], 0
                for r in read_records(uri):
                    rows.append(r if payloads else (*r[:-1], None))
                    held += 200 + len(rows[-1][-1] or b"")
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    n = max(1, archives.count())
    return archives.select("file").repartition(n, "file").mapInArrow(read, _RECORD)
