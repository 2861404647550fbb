"""WARC archives, written and read in chunks.

A payload is a run of chunks: rows of record identifier and chunk number that
carry the digest so far. Pages are cut into chunks as they are read, and only
chunks are shuffled, compressed, written and read back; no row, buffer or shuffle
block behind the input's own cell holds an oversized payload as a whole. Each
record is one gzip member, so archives can be read from any record's offset, and
are: the index is dealt to readers by spans of bytes. Tasks write archives under
names of their own into the shared folder and return an index of what they wrote;
the index, a table, is what makes an archive count, so an executor that is lost
or a task that runs twice leaves a file that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import release, slices, table, utf8, work_path, written

CHUNK = 1 << 20
#: Payloads from this many bytes on are written once, and revisited.
LEAST_REVISITED = 1000
#: Compressed bytes after which a task begins another archive.
ARCHIVE = 256 << 20
#: Compressed bytes that a reader takes at once, and readers at most: beyond it each takes several runs.
SPAN = 4 << 20
READERS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


CHUNKS = "page_id long, url string, origin string, chunk_no int, data binary, last boolean, bytes long, sha1 string, sha256 string, payload_sha256 string"


def chunk_rows(pages: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunks of each page's payload: page_id, url, origin, chunk_no, data, last, and bytes, sha1 and sha256 of all up to this one.

    Rows of one origin are one record's, whatever else repeats; payload_sha256
    is that of the whole payload. Null html is an empty payload, which is one
    empty chunk. Without ``data`` only the last chunk's row comes out, and its
    data is null.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, kinds = _arrow(CHUNKS)
        part, row = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in slices(batches, "html"):
            for page, url, payload in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), utf8(batch.column("html"))):
                whole = hashlib.sha256(payload).hexdigest()  # by views of the cell, without a copy
                one, two = hashlib.sha1(usedforsecurity=False), hashlib.sha256()
                for k, at in enumerate(range(0, max(1, len(payload)), chunk)):
                    piece = payload[at : at + chunk]
                    one.update(piece)
                    last = at + chunk >= len(payload)
                    if data:
                        two.update(piece)
                    if data or last:
                        rows.append((page, url, f"{part}.{row}", k, bytes(piece) if data else None, last, at + len(piece), one.hexdigest(), two.hexdigest() if data else whole, whole))
                        held += len(piece) if data else 64
                    if held >= 8 * CHUNK:
                        yield batch_of()
                        rows, held = [], 0
                row += 1
            if rows:
                yield batch_of()
                rows, held = [], 0

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInArrow(of, CHUNKS)


def _arrow(schema: str) -> tuple[list[str], list[pa.DataType]]:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    pairs = [x.split() for x in schema.split(", ")]
    return [n for n, _ in pairs], [types[t] for _, t in pairs]


def _text_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def decided(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """Which pages are written in full: (page_key, sha256, sha1, payload_bytes, refers_to), refers_to being null for these."""
    digests = written(chunk_rows(pages, data=False).select("page_id", "bytes", "sha1", F.col("payload_sha256").alias("sha256")), "payload-digests")
    groups = digests.where(F.col("bytes") >= least).groupBy("sha256", "bytes").agg(F.max("page_id").alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    other = F.when(F.col("stays").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stays")), F.col("stays"))
    return digests.join(groups, ["sha256", "bytes"], "left").select(_text_key("page_id").alias("page_key"), "sha256", "sha1", F.col("bytes").alias("payload_bytes"), other.alias("refers_to")).distinct()


def record_id(page: int | None, sha1: str, again: str = "") -> str:
    """Of a page's payload; ``again`` tells rows apart that repeat both, and rows without page_id."""
    return f"<urn:x-page:{'' if page is None else page}:{sha1}{':' + again if again else ''}>"


def header(record: str, url: str, kind: str, sha1: str, length: int, refers_to: str | None) -> bytes:
    """A record's head. White space and control characters of a URL are percent-encoded, as a header's line can't hold them."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join(quote(c) if c.isspace() or not c.isprintable() else c for c in url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {length}",
    ]
    if kind == "revisit":
        lines[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def http_header(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


class Archive:
    """An archive that is being written, one gzip member a record."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        fs, inner = pa.fs.FileSystem.from_uri(self.path)
        fs.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out, self.size, self.begin, self.packer = fs.open_output_stream(inner, compression=None), 0, 0, None

    def open_record(self) -> None:
        self.begin, self.packer = self.size, zlib.compressobj(1, zlib.DEFLATED, 31)

    def add(self, part: bytes | memoryview) -> None:
        self._put(self.packer.compress(part))

    def close_record(self) -> tuple[str, int, int]:
        self._put(self.packer.flush())
        return self.path, self.begin, self.size - self.begin

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def close(self) -> None:
        self.out.close()


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISITED, chunk: int = CHUNK) -> DataFrame:
    """Writes a record for each page and gives the index: path, offset, length.

    pages: page_id, url, html; other columns are ignored. Null html is an empty
    payload, a null url an empty one. Of pages whose payloads are equal and of
    at least ``least`` bytes, those of the largest page_id are response and all
    others revisit it, rows without page_id too; smaller ones are all response.
    Record identifiers are unique, also of repeated rows.
    """
    decisions = decided(pages, least)
    rows = chunk_rows(pages, chunk).select(_text_key("page_id").alias("page_key"), "page_id", "url", "origin", "chunk_no", "data", "last", F.col("payload_sha256").alias("sha256"))
    rows = rows.join(decisions, ["page_key", "sha256"])
    rows = rows.where("refers_to IS NULL OR chunk_no = 0").select("page_key", "sha256", "origin", "chunk_no", "page_id", "url", "sha1", "payload_bytes", "refers_to", F.when(F.col("refers_to").isNull(), F.col("data")).alias("data"), "last")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        archive, before = None, None
        for batch in batches:
            places = []
            columns = [batch.column(c).to_pylist() for c in ("page_key", "sha256", "origin", "chunk_no", "page_id", "url", "sha1", "payload_bytes", "refers_to", "last")]
            for i, (key, sha256, origin, k, page, url, sha1, size, refers, last) in enumerate(zip(*columns)):
                if k == 0:
                    if archive is None or archive.size >= ARCHIVE:
                        if archive is not None:
                            archive.close()
                        archive = Archive(folder)
                    own = record_id(page, sha1, origin if page is None or (key, sha256) == before else "")
                    before = key, sha256
                    top = http_header(size) if refers is None else b""
                    archive.open_record()
                    archive.add(header(own, url or "", "response" if refers is None else "revisit", sha1, len(top) + size if refers is None else 0, None if refers is None else record_id(refers, sha1)))
                    archive.add(top)
                if refers is None:
                    archive.add(batch.column("data")[i].as_buffer())
                if last or refers is not None:
                    archive.add(b"\r\n\r\n")
                    places.append(archive.close_record())
            if places:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*places), (pa.string(), pa.int64(), pa.int64()))], names=["path", "offset", "length"])
        if archive is not None:
            archive.close()

    return written(rows.sortWithinPartitions("page_key", "sha256", "origin", "chunk_no").mapInArrow(of, "path string, offset long, length long"), "warc-index")


def inflated(stream, size: int) -> Iterator[bytes]:
    """The bytes of a file of gzip members, a chunk at a time."""
    unpack = zlib.decompressobj(31)
    while data := stream.read(size):
        while data:
            if part := unpack.decompress(data, size):
                yield part
            data = unpack.unconsumed_tail
            if unpack.eof:
                data = unpack.unused_data
                unpack = zlib.decompressobj(31)


class Reader:
    """Bytes that come in chunks, read by lines and lengths."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, bytearray()

    def more(self) -> bool:
        data = next(self.chunks, b"")
        self.held += data
        return bool(data)

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("an archive ends within a record")
                return None
        out = bytes(self.held[:end])
        del self.held[: end + len(mark)]
        return out

    def take(self, n: int, most: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("an archive ends within a record")
            part = bytes(self.held[: min(n, most)])
            del self.held[: len(part)]
            n -= len(part)
            yield part


def records(chunks: Iterator[bytes], most: int = CHUNK) -> Iterator[tuple[dict[str, str], int, bytes, bool, int, str]]:
    """(headers, chunk_no, data, last, bytes so far, SHA-1 so far) of each payload in an archive's bytes; checks digests and lengths."""
    reader = Reader(chunks)
    while (head := reader.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("a record that doesn't begin with its version")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        left = int(fields["content-length"])
        digest = hashlib.sha1(usedforsecurity=False)
        total = k = 0
        if left:
            http = reader.until(b"\r\n\r\n")
            left -= len(http) + 4
        if left == 0:
            yield fields, 0, b"", True, 0, digest.hexdigest()
        for part in reader.take(left, most):
            digest.update(part)
            total += len(part)
            yield fields, k, part, total == left, total, digest.hexdigest()
            k += 1
        if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{base64.b32encode(digest.digest()).decode()}":
            raise ValueError(f"{fields['warc-record-id']}: the payload doesn't have its digest")
        if b"".join(reader.take(4, 4)) != b"\r\n\r\n":
            raise ValueError("a record that doesn't end with its length")


def _page(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").split(":")
    return int(digits[2]) if len(digits) > 2 and digits[2] else None


class Span:
    """Bytes ``first`` to ``end`` of an open file."""

    def __init__(self, file, first: int, end: int) -> None:
        self.file, self.left = file, end - first
        file.seek(first)

    def read(self, size: int) -> bytes:
        data = self.file.read(min(size, self.left))
        self.left -= len(data)
        return data


def spans(index: DataFrame, span: int = SPAN) -> DataFrame:
    """(path, first, end): runs of whole records of about ``span`` bytes, dealt to a task each, to READERS tasks at most."""
    runs = index.groupBy("path", F.floor(F.col("offset") / span).alias("run")).agg(F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("end"))
    runs = written(runs.select("path", "first", "end"), "warc-spans")  # without it the planner takes the grouping's few partitions for the reader's
    return runs.repartitionByRange(min(READERS, max(1, runs.count())), "path", "first")


def read_archives(index: DataFrame, data: bool = False, chunk: int = CHUNK, span: int = SPAN) -> DataFrame:
    """Reads back the archives that an index names, by spans of their bytes.

    With ``data``: the chunk table record_id, chunk_no, data, last, bytes, sha1.
    Else a row for each record: record_id, page_id, url, record_type, refers_to,
    payload_bytes and payload_digest (of a revisit: 0 and what its header says).
    """
    schema = "record_id string, chunk_no int, data binary, last boolean, bytes long, sha1 string" if data else RECORD
    names, kinds = _arrow(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for path, first, end in (x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("path", "first", "end")))):
            fs, inner = pa.fs.FileSystem.from_uri(path)
            with fs.open_input_file(inner) as file:
                rows, held = [], 0
                for fields, k, part, last, total, sha1 in records(inflated(Span(file, first, end), chunk), chunk):
                    if data:
                        rows.append((fields["warc-record-id"], k, part, last, total, sha1))
                        held += len(part)
                    elif last:
                        kind = fields["warc-type"]
                        digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex() if kind == "revisit" else sha1
                        rows.append((fields["warc-record-id"], _page(fields["warc-record-id"]), fields["warc-target-uri"], kind, _page(fields.get("warc-refers-to")), total, digest))
                    if len(rows) >= 10_000 or held >= 8 * chunk:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spans(index, span).mapInArrow(of, schema)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the pages' archives, reads them back and gives page_id, payload_bytes, payload_digest, record_type and refers_to.

    What a revisit's payload is comes from the response that it refers to.
    Repeated rows are written and read as often. An empty table gives an empty one.
    """
    folder = folder or work_path(pages.sparkSession, "warc")
    read = written(read_archives(write_archives(pages, folder)), "warc-records")
    full = read.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    sizes = full.where("page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    again = read.where("record_type = 'revisit'").drop("payload_bytes").join(sizes, ["refers_to", "payload_digest"], "left")
    return full.unionByName(again.select(*full.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


SQL = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS stays
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> stays THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> stays THEN stays END AS refers_to
FROM sized
"""
