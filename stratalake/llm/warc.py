"""WARC archives: writing, normalising to one gzip member per record with an offset index, reading.

A crawl hands over *monolithic* archives: one gzip stream for a whole file, which can only be read
from its start. The normaliser inflates such a stream once, in pieces, rewrites each record as a
gzip member of its own and writes a sidecar index of (record id, type, offset, length). After that,
each record can be read alone, and a file can be read in parts.

Each archive is one task's work in every step, and memory holds one record at a time. Files are
written under a name of their own for each attempt; only the names that a finished task returns are
used afterwards, so a lost executor or a second attempt leaves at most files that nobody reads.
Folders are URIs that pyarrow's file systems know (file, hdfs, s3, gs) or plain paths.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id is a
response; the others are revisits that name it and carry the HTTP header alone. Smaller ones are all
responses. Rows that repeat an id and its payload all are what that id is. A null payload is empty; a
null id is written as ``-``, is never the smallest and is read back as null; a null url is left out.
An empty table makes no archives. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.shared import lean, written

MIN_REVISIT = 100
#: An archive is closed when so many bytes were written to it before compression.
ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        scheme, _, path = uri.partition(":")
        if scheme == "file":
            return pa.fs.LocalFileSystem(), "/" + path.lstrip("/")
        return pa.fs.FileSystem.from_uri(uri)
    return pa.fs.LocalFileSystem(), uri


def record_types(pages: DataFrame) -> DataFrame:
    """The pages as (page_id, url, body, digest, refers_to); refers_to is null for responses.

    Only digests that several ids share are joined, and a page that nobody shares never waits for
    one that thousands do: adaptive execution splits the join of a hot digest.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), body.alias("body"))
    pages = pages.withColumn("digest", F.sha2("body", 256))
    large = pages.where(F.length("body") >= MIN_REVISIT)
    shared = large.groupBy(F.col("digest").alias("_digest")).agg(
        F.min("page_id").alias("_first"), F.count("*").alias("_n")
    )
    shared = shared.where("_n > 1 and _first is not null").drop("_n")
    joined = pages.join(shared, F.col("digest") == F.col("_digest"), "left")
    other = ~F.col("_first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "body", "digest", F.when(other, F.col("_first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    payload = base64.b32encode(bytes.fromhex(digest)).decode().rstrip("=")
    header = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'-' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{payload}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        header.append(f"WARC-Target-URI: {url.replace(chr(13), ' ').replace(chr(10), ' ')}")
    if refers_to is not None:
        header.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        header.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(header).encode() + _END + block + _END


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write monolithic archives under ``folder``; returns their paths (written, one row each)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base)
        out = coder = path = None
        size = 0
        for batch in batches:
            for page_id, url, body, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{base}/{uuid4().hex}.warc.gz"
                    out, coder, size = files.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0
                data = record(page_id, url, body, digest, refers_to)
                out.write(coder.compress(data))
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    out.write(coder.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [path]})
        if out is not None:
            out.write(coder.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [path]})

    return written(records.mapInArrow(lean(write), "archive string"))


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of WARC bytes, without the blank lines after them."""
    buffer = bytearray()
    for piece in pieces:
        buffer += piece
        at = 0
        while (end := buffer.find(_END, at)) >= 0:
            length = int(_header(bytes(buffer[at:end]))["content-length"])
            stop = end + 4 + length
            if len(buffer) < stop + 4:
                break
            yield bytes(buffer[at:stop])
            at = stop + 4
        del buffer[:at]
    if buffer:
        raise ValueError(f"the archive ends within a record: {len(buffer)} bytes are left")


def _header(head: bytes) -> dict[str, str]:
    """The fields of a header; names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}


def inflate(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, in pieces of bounded size."""
    decoder = None
    for piece in pieces:
        decoder = decoder or zlib.decompressobj(31)
        while piece:
            if decoder.eof:
                decoder = zlib.decompressobj(31)
            yield decoder.decompress(piece, PIECE)
            piece = decoder.unconsumed_tail or decoder.unused_data
    if decoder and not decoder.eof:
        yield decoder.flush()
        if not decoder.eof:
            raise ValueError("the archive ends within a member of its gzip stream")


def _pieces(stream: pa.NativeFile) -> Iterator[bytes]:
    while piece := stream.read(PIECE):
        yield piece


INDEX = "archive string, record_id string, record_type string, offset long, length long"
_INDEX = pa.schema(
    [(c, pa.string()) for c in ("archive", "record_id", "record_type")] + [(c, pa.int64()) for c in ("offset", "length")]
)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one member per record; returns the index (written, one row per record).

    Beside each file stands its index as lines of ``record_id type offset length``.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path, rows, offset = f"{base}/{uuid4().hex}.warc.gz", [], 0
                reader, name = _open(source)
                with reader.open_input_stream(name, compression=None) as stream, files.open_output_stream(path, compression=None) as out:
                    for data in split_records(inflate(_pieces(stream))):
                        fields = _header(data[: data.index(_END)])
                        member = gzip.compress(data + _END, 6, mtime=0)
                        out.write(member)
                        rows.append((path, fields["warc-record-id"], fields["warc-type"], offset, len(member)))
                        offset += len(member)
                with files.open_output_stream(f"{path}.idx", compression=None) as out:
                    out.write("".join(f"{i} {t} {o} {n}\n" for _, i, t, o, n in rows).encode())
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX, strict=True)], schema=_INDEX)

    return written(archives.mapInArrow(lean(rewrite), INDEX))


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("intact", pa.bool_()),
    ]
)


def read_records(index: DataFrame) -> DataFrame:
    """What the records that an index names hold; each is read alone, by its offset.

    Digest and size of a revisit are those of the full payload, which its header names. ``intact``: a
    response's payload has the digest that its header names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, name, file = [], None, None
            for path, _, _, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != name:
                    files, inner = _open(path)
                    name, file = path, files.open_input_file(inner)
                file.seek(offset)
                rows.append(parse(gzip.decompress(file.read(length))))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)], schema=_RECORDS)

    return index.mapInArrow(lean(read), RECORDS)


def _page(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-") else None


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None, bool]:
    """One record's row of ``RECORDS``."""
    split = data.index(_END)
    fields = _header(data[:split])
    block = data[split + 4 : split + 4 + int(fields["content-length"])]
    http, _, body = block.partition(_END)
    code = fields["warc-payload-digest"].removeprefix("sha256:")
    named = base64.b32decode(code + "=" * (-len(code) % 8)).hex()
    response = fields["warc-type"] == "response"
    size = int(_header(http)["content-length"])
    digest = hashlib.sha256(body).hexdigest() if response else named
    intact = not response or (digest == named and len(body) == size)
    found = len(body) if response else size
    return _page(fields["warc-record-id"]), found, digest, fields["warc-type"], _page(fields.get("warc-refers-to")), intact
