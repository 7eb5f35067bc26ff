"""WARC archives of pages: written by Spark's tasks, and read back record by record.

An archive is a row of gzip members, one a record. The reader inflates a member bit
by bit as bytes arrive, cuts the record out by its Content-Length, and checks the
block's and the payload's digest; it never holds more than one record.

Equal payloads of at least `LEAST_PAYLOAD` bytes are stored once: the page with the
smallest id is a response, the others are revisits, which have the headers of the
response and no payload.

Archives lie in the folder that driver and executors share; tasks reach it by
pyarrow's file systems (mounted folders, s3, gs, hdfs). A task that runs again
writes archives of other names, and only those of the run that counted are listed
in the manifest, so lost executors leave no record twice.

Edge cases: a NULL html is an empty payload, and a response. A page without an id
never is the one others refer to; if none of the equal pages has one, all are
responses. Rows that repeat a page with its id are all responses. Empty tables
give empty results. Other columns are never looked at. Payloads go by whole, as
long as one row is.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import new_folder
from .common import saved, without

LEAST_PAYLOAD = 100
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 256 << 10
LONGEST_HEADER = 1 << 20
# Fixed texts of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"


class WarcError(ValueError):
    """An archive that is not what it says."""


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as tasks reach it, and the folder's path in it."""
    scheme, _, rest = folder.partition(":")
    if scheme in ("s3a", "s3n"):
        folder = f"s3:{rest}"
    elif scheme == "file":
        folder = "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder)


@dataclass(frozen=True)
class Record:
    """One record: its headers by lower-case name, and its block."""

    headers: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """The HTTP headers in the block, and what follows them."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return fields(head.split(b"\r\n")[1:]), body


def fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header: {line[:80]!r}")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    refers_to: int | None,
    told: tuple[str, int] | None = None,
) -> bytes:
    """The gzip member of one page's record; a revisit may go by its payload's digest and length."""
    digest, length = told or (sha256(payload), len(payload))
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}"
        "\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    named = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": page_urn(page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": digest,
        "WARC-Block-Digest": sha256(block),
        "Content-Type": HTTP,
        "Content-Length": str(len(block)),
    }
    if url is not None:
        named["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=%~")
    if refers_to is not None:
        named |= {"WARC-Refers-To": page_urn(refers_to), "WARC-Profile": PROFILE}
    head = "".join(f"{name}: {value}\r\n" for name, value in named.items()).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    parts = (VERSION + b"\r\n", head, b"\r\n", block, b"\r\n\r\n")
    return b"".join(map(packer.compress, parts)) + packer.flush()


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The inflated pieces of each gzip member of a stream, in turn."""
    rest = b""

    def inflated() -> Iterator[bytes]:
        nonlocal rest
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            data = rest or next(chunks, b"")
            if not data:
                raise WarcError("the archive ends within a record")
            try:
                piece = unpack.decompress(data, READ_BYTES)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            rest = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            if piece:
                yield piece

    while True:
        rest = rest or next(chunks, b"")
        if not rest:
            return
        yield inflated()


def read_record(pieces: Iterator[bytes]) -> Record:
    """One record out of the pieces of its member, framed by Content-Length and verified."""
    head = bytearray()
    while (cut := head.find(b"\r\n\r\n")) < 0:
        if len(head) > LONGEST_HEADER:
            raise WarcError("a record's header has no end")
        piece = next(pieces, None)
        if piece is None:
            raise WarcError("a record ends within its header")
        head += piece
    version, *lines = bytes(head[:cut]).split(b"\r\n")
    if version != VERSION:
        raise WarcError(f"not a record: {version[:40]!r}")
    headers = fields(lines)
    try:
        size = int(headers["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("a record without a length") from error
    block = bytearray(head[cut + 4 :])
    for piece in pieces:
        block += piece
        if len(block) > size + 4:
            raise WarcError("a record is longer than it says")
    if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
        raise WarcError("a record is shorter than it says")
    del block[size:]
    if headers.get("warc-block-digest") != sha256(block):
        raise WarcError("a block does not match its digest")
    record = Record(headers, bytes(block))
    if headers.get("warc-type") == "response":
        http, payload = record.http
        if int(http["content-length"]) != len(payload):
            raise WarcError("a payload is not as long as it says")
        if headers.get("warc-payload-digest") != sha256(payload):
            raise WarcError("a payload does not match its digest")
    return record


def read_archive(folder: str, name: str) -> Iterator[Record]:
    """The records of an archive, one after the other."""
    store, path = store_of(folder)
    with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
        chunks = iter(lambda: stream.read(READ_BYTES), b"")
        for pieces in members(chunks):
            yield read_record(pieces)


def plan_records(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Responses with their html, and revisits with the page they refer to, digest and length.

    Which page is which is found by ids, digests and lengths; html is not shuffled.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digested = saved(
        pages.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("page_id").cast("long").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            payload.alias("html"),
            F.sha2(payload.cast("binary"), 256).alias("digest"),
            F.octet_length(payload).cast("long").alias("bytes"),
        ),
        "pages",
    )
    narrow = digested.select("uid", "page_id", "url", "digest", "bytes")
    first = (
        narrow.filter(F.col("bytes") >= least_payload)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .select("digest", "refers_to")
    )
    again = narrow.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    again = saved(again, "revisits")
    told = ("page_id", "url", "html", "refers_to", "digest", "bytes")
    revisits = again.withColumn("html", F.lit(None).cast("string")).select(*told)
    nobody = F.lit(None).cast("long").alias("refers_to")
    others = without(digested, again.select("uid")).withColumn("refers_to", nobody)
    return others.select(*told).unionByName(revisits)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records below a shared folder; the manifest: `archive` and its `records`."""

    told = ("page_id", "url", "html", "refers_to", "digest", "bytes")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        store.create_dir(path, recursive=True)
        context = TaskContext.get()
        attempt = f"{context.partitionId():06d}-{uuid.uuid4().hex}"
        out, name, count, done = None, "", 0, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in told), strict=True):
                page_id, url, html, refers_to, digest, length = (x.as_py() for x in row)
                if out is None:
                    name, count = f"{attempt}-{len(done):04d}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                payload = (html or "").encode()
                known = (f"sha256:{digest}", length)
                out.write(record_bytes(page_id, url, payload, refers_to, known))
                count += 1
                if out.tell() >= archive_bytes:
                    out.close()
                    done.append((name, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())],
            ["archive", "records"],
        )

    return saved(records.mapInArrow(write, "archive string, records long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives a manifest lists, each archive read by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, expected in zip(
                batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True
            ):
                rows = []
                for record in read_archive(folder, name):
                    headers, (http, _) = record.headers, record.http
                    rows.append(
                        (
                            page_of(headers["warc-record-id"]),
                            int(http["content-length"]),
                            headers["warc-payload-digest"].removeprefix("sha256:"),
                            headers["warc-type"],
                            page_of(headers.get("warc-refers-to")),
                        )
                    )
                if len(rows) != expected:
                    raise WarcError(f"{name} has {len(rows)} records, not {expected}")
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record for each page below the shared folder and read all of them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), folder)
