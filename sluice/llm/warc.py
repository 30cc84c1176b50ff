"""WARC archives: a writer with revisit records, and a sequential reader.

A record is one gzip member. The writer rolls its files by size. The reader decompresses
incrementally, frames blocks by their content length and verifies their digests, so it needs
the memory of one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import filesystem, map_rows, staged, utf8
from sluice.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 64 << 20
CHUNK = 1 << 16
_ID = "urn:sluice:page:"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """A response record, or a revisit of ``refers_to`` with the HTTP header only, as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest: sha1:" + payload_digest(payload),
        "WARC-Block-Digest: sha1:" + payload_digest(block),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head = utf8("\r\n".join(lines)) + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


class _Members:
    """The bytes of consecutive gzip members, decompressed as they are asked for."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.rest, self.unpack = stream, b"", None
        self.held = bytearray()

    def start(self) -> bool:
        """Goes to the next member; false at the end of the file."""
        if not self.rest:
            self.rest = self.stream.read(CHUNK)
        self.unpack = zlib.decompressobj(31) if self.rest else None
        return bool(self.rest)

    def more(self) -> bool:
        """Decompresses one chunk; false at the end of the member."""
        if self.unpack.eof:
            return False
        given = self.unpack.unconsumed_tail or self.rest or self.stream.read(CHUNK)
        if not given:
            raise ValueError("the archive ends within a record")
        self.rest = b""
        self.held += self.unpack.decompress(given, CHUNK * 4)
        if self.unpack.eof:
            self.rest = self.unpack.unused_data
        return True

    def until(self, mark: bytes) -> bytes:
        searched = 0
        while (at := self.held.find(mark, searched)) < 0:
            searched = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                raise ValueError("a record's header has no end")
        found = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise ValueError("a record is shorter than its content length")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, verified; ``ValueError`` if one is damaged."""
    members = _Members(stream)
    while members.start():
        first, *lines = members.until(b"\r\n\r\n").decode("utf-8", "surrogatepass").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = members.exactly(int(fields["content-length"]))
        if members.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end after its content")
        while members.more():
            pass
        if members.held:
            raise ValueError("a gzip member holds more than one record")
        digest = fields.get("warc-block-digest")
        if digest and digest != "sha1:" + payload_digest(block):
            raise ValueError(f"digest of {fields.get('warc-record-id')} differs")
        yield fields, block


def decided(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> DataFrame:
    """``page_id, url, html, refers_to``: null where the page is a response, else the response it revisits.

    Of equal payloads of ``min_bytes`` or more the smallest id is the response. Rows that repeat
    that id are responses too; a null id counts as larger than all, and pages without any id to
    refer to are responses.
    """
    each = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )
    each = each.withColumn("_digest", F.sha2(F.col("html").cast("binary"), 256))
    first = each.where(F.octet_length("html") >= min_bytes).groupBy("_digest").agg(F.min("page_id").alias("_first"))
    revisits = ~F.col("page_id").eqNullSafe(F.col("_first"))
    return each.join(first, "_digest", "left").select(
        "page_id", "url", "html", F.when(revisits, F.col("_first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, where: str, *, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes the pages of ``decided`` below ``where`` and returns the manifest: ``path, records, bytes``.

    Every attempt of a task writes files of new names, and only the names that a successful
    attempt returns are in the manifest: a task that runs again leaves nothing behind that is read.
    """

    def work(rows):
        files, base = filesystem(where)
        files.create_dir(base, recursive=True)
        out, name, count, size = None, "", 0, 0
        for page, url, html, refers_to in rows:
            if out is None:
                name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            member = record(page, url, utf8(html), refers_to, date)
            out.write(member)
            count, size = count + 1, size + len(member)
            if size >= file_bytes:
                out.close()
                yield f"{where}/{name}", count, size
                out = None
        if out is not None:
            out.close()
            yield f"{where}/{name}", count, size

    return staged(map_rows(pages.select("page_id", "url", "html", "refers_to"), work, "path string, records bigint, bytes bigint"), "warc")


def read_archives(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Every record of the files of a manifest: ids, type, and length and digest of the full payload."""

    def number(uri: str):
        text = uri.strip("<>").removeprefix(_ID)
        return (text if id_type == "string" else int(text)) if text else None

    def work(rows):
        for path, records in rows:
            files, name = filesystem(path)
            seen = 0
            with files.open_input_stream(name, compression=None) as stream:
                for fields, block in read_records(stream):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(head.rpartition(b"Content-Length: ")[2])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
                        raise ValueError(f"payload of {fields['warc-record-id']} differs")
                    target = number(fields["warc-refers-to"]) if kind == "revisit" else None
                    yield number(fields["warc-record-id"]), length, digest, kind, target
                    seen += 1
            if seen != records:
                raise ValueError(f"{path} has {seen} records, not {records}")

    files = manifest.count()
    schema = (
        f"page_id {id_type}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}"
    )
    return map_rows(manifest.select("path", "records").repartition(max(1, files)), work, schema)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back. No pages, no rows."""
    chosen = decided(pages, **columns)
    manifest = write_archives(chosen, scratch_path(pages.sparkSession, "warc-files"))
    return read_archives(manifest, dict(chosen.dtypes)["page_id"])
