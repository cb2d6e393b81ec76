"""WARC archives: written with one gzip member per record, read back by a sequential reader.

Writer: each page is one record (block = its payload). Pages of equal payload (by SHA-1) are one ``response``, that of the smallest
page_id, and ``revisit`` records without payload that name it. Archives are rows (name, content) of a Parquet table in the
shared folder, gathered to about ``ARCHIVE`` bytes each, so any store that Spark writes to will do; ``files`` reads
archives that lie as files in a folder.

Reader: goes through an archive member by member in one pass, inflating a small window at a time, and frames each record by its
Content-Length. Payload digests are checked; a record whose digest, length or framing is wrong raises. A revisit's own block is
empty, its payload digest is that of the page it refers to.

Null payloads are empty ones. A page without an id never is the response of a group that has one, and a group without any id is
all responses, as are repeated rows of the smallest id. Other columns are ignored; no pages give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import pieces, store

#: Bytes of payload in an archive, bytes inflated at a time, gzip level.
ARCHIVE, WINDOW, LEVEL = 8_000_000, 1 << 16, 6
VERSION = "WARC/1.1"
#: Fixed value: the profile that names a revisit of equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID(int=0x5741524300000000000000000000)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None, payload_digest: str, size: int) -> bytes:
    """One gzip member. ``size`` is that of the full payload, which a revisit leaves out."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {uri}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("Content-Type", "text/html"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(size)),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("X-Refers-To-Page", str(refers_to))]
    block = payload if refers_to is None else b""
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{head}\r\n".encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


class _Members:
    """Bytes of the gzip members of a stream, one member after the other, inflated a window at a time."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.rest = stream, b""

    def open(self) -> bool:
        """Go to the next member; False at the end of the stream."""
        if not self.rest:
            self.rest = self.stream.read(WINDOW)
        self.inflater, self.held = zlib.decompressobj(31), b""
        return bool(self.rest)

    def _more(self) -> bool:
        while not self.inflater.eof:
            data = self.inflater.unconsumed_tail or self.rest or self.stream.read(WINDOW)
            if data is self.rest:
                self.rest = b""
            if not data:
                raise ValueError("archive ends within a record")
            out = self.inflater.decompress(data, WINDOW)
            if self.inflater.eof:
                self.rest = self.inflater.unused_data + self.rest
            if out:
                self.held += out
                return True
        return False

    def line(self) -> bytes:
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("record without end of head")
        out, self.held = self.held[:at], self.held[at + 2 :]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise ValueError("record shorter than its Content-Length")
            out, self.held = self.held[:size], self.held[size:]
            size -= len(out)
            yield out

    def close(self) -> None:
        if b"".join(self.take(4)) != b"\r\n\r\n" or self.held or self._more():
            raise ValueError("record does not end where its Content-Length says")


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head fields (names in lower case) and block of each record of an archive, in order; wrong digests raise."""
    members = _Members(stream)
    while members.open():
        if not members.line().startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while line := members.line():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        sha1, block = hashlib.sha1(), []
        for chunk in members.take(int(fields["content-length"])):
            sha1.update(chunk)
            block.append(chunk)
        members.close()
        named = fields.get("warc-payload-digest", "")
        if fields.get("warc-type") != "revisit" and named and named != "sha1:" + base64.b32encode(sha1.digest()).decode():
            raise ValueError(f"digest of record {fields.get('warc-record-id')} is wrong")
        yield fields, b"".join(block)


def write_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives of all pages (page_id, url, html): rows name, content. Payloads under ``least`` bytes are never revisited."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    groups = own.filter(F.length("payload") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Only payloads that come again are looked up; kept as a table, so a payload with very many pages is split in the join.
    again = store(groups.filter("n > 1 and first is not null").select("sha1", "first"), "warc_again")
    marked = own.join(again, "sha1", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    rows = marked.select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, size, held = TaskContext.get().partitionId(), 0, 0, []

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": [f"part-{task:06d}-{number:06d}.warc.gz"], "content": [b"".join(held)]}, schema=pa.schema([("name", pa.string()), ("content", pa.binary())]))

        for part in pieces(batches, ARCHIVE):
            for page_id, url, body, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                held.append(record(page_id, url, body, refers_to, digest(body), len(body)))
                size += len(body)
                if size >= ARCHIVE:
                    yield archive()
                    number, size, held = number + 1, 0, []
        if held:
            yield archive()

    return store(rows.mapInArrow(run, "name string, content binary"), "warc_archives")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Archives that lie as .warc.gz files in a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select(F.col("path").alias("name"), "content")


_READ = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, uri string, block binary"


def read_archives(archives: DataFrame, blocks: bool = True) -> DataFrame:
    """A row per record of the archives; ``block`` is left null where only the heads are wanted (it is read and checked all the same)."""
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, held = [], 0
                for fields, block in records(io.BytesIO(content.as_py())):
                    own, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
                    out.append(
                        {
                            "page_id": int(own) if own else None,
                            "record_type": fields["warc-type"],
                            "payload_bytes": int(fields.get("x-payload-length", len(block))),
                            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or digest(block),
                            "refers_to": int(refers) if refers else None,
                            "uri": fields.get("warc-target-uri"),
                            "block": block if blocks else None,
                        }
                    )
                    held += len(block) * blocks + 200
                    if held >= ARCHIVE:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return archives.select("name", "content").mapInArrow(run, _READ)
