"""WARC archives as a table of chunks.

A payload travels as rows (record, chunk number, bytes), so neither the writer nor the reader ever allocates a whole record: the
writer compresses chunk after chunk into the archive, the reader gives chunk after chunk with the digest carried along. Archives are
gzip files with one member per record, in the cluster's shared folder; a table lists those of the tasks that succeeded, so files of
lost or repeated tasks are never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from hanok.llm.shared import work_folder, written

CHUNK = 1 << 16  # bytes of a payload in a row
MIN_REVISIT = 1000  # smaller payloads are always written
FILE_BYTES = 32 << 20  # an archive is closed once it has as many
READ = 1 << 16
# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:x-page:"


def chunks(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``pages`` (page_id, url, html) as consecutive chunk rows with what each record needs.

    Of pages with equal payloads of ``MIN_REVISIT`` bytes or more, those with the largest page_id are responses and the others revisit
    it. Payloads meet only as digests; pages of a frequent payload are spread by the join like other skewed keys.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    pages = pages.withColumn("size", F.octet_length("payload").cast("long"))
    latest = pages.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.max("page_id").alias("latest"))
    pages = pages.join(latest, "digest", "left").withColumn(
        "refers_to", F.when((F.col("size") >= MIN_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("latest")) & F.col("latest").isNotNull(), F.col("latest"))
    )
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    pages = pages.withColumn("body", body).drop("payload", "latest")
    places = F.sequence(F.lit(0), F.greatest(F.floor((F.octet_length("body") - 1) / chunk), F.lit(0)).cast("int"))
    return pages.select("page_id", "url", "digest", "size", "refers_to", "body", F.explode(places).alias("chunk_no")).select(
        "page_id", "url", "digest", "size", "refers_to", "chunk_no", F.substring("body", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("chunk")
    )


def _fields(page_id, url, digest: str, size: int, refers_to) -> tuple[bytes, bytes]:
    """The record's header without its length, and the HTTP header before the payload."""
    kind = "response" if refers_to is None else "revisit"
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD}{uuid.uuid4() if page_id is None else page_id}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < "!" else c for c in url))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{RECORD}{refers_to}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    return "\r\n".join(lines).encode(), http.encode()


class Writer:
    """Archives in a folder, one after the other."""

    def __init__(self, folder: str):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.path, recursive=True)
        self.folder, self.out, self.done = folder, None, []

    def begin(self, page_id, url, digest: str, size: int, refers_to) -> None:
        if self.out is None or self.bytes >= FILE_BYTES:
            self.close()
            self.name, self.bytes, self.records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        head, http = _fields(page_id, url, digest, size, refers_to)
        length = len(http) + (size if refers_to is None else 0)
        self.gzip, self.left = zlib.compressobj(1, wbits=31), length - len(http)
        self._put(self.gzip.compress(head + f"\r\nContent-Length: {length}\r\n\r\n".encode() + http))

    def chunk(self, data: bytes) -> None:
        self.left -= len(data)
        self._put(self.gzip.compress(data))

    def end(self) -> None:
        if self.left:
            raise ValueError("a record's chunks do not add up to its payload")
        self._put(self.gzip.compress(b"\r\n\r\n") + self.gzip.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.out.write(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.bytes))
            self.out = None


def write(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Write a record per row of ``pages``; (path, records, bytes) of the archives, as a written table."""
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "warc")
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, begun = Writer(folder), False
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, digest, size, refers_to, chunk_no, data = (batch.column(c)[i] for c in range(7))
                if chunk_no.as_py() == 0:
                    if begun:
                        writer.end()
                    writer.begin(page_id.as_py(), url.as_py(), digest.as_py(), size.as_py(), refers_to.as_py())
                    begun = True
                writer.chunk(memoryview(data.as_buffer()) if data.is_valid else b"")
        if begun:
            writer.end()
        writer.close()
        paths, records, size = zip(*writer.done) if writer.done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(records, pa.int64()), pa.array(size, pa.int64())], names=["path", "records", "bytes"])

    return written(chunks(pages, chunk).mapInArrow(run, "path string, records long, bytes long"), "warc-list")


class _Input:
    """An archive's decompressed bytes, a block at a time."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.raw, self.zip, self.held = fs.open_input_stream(name, compression=None), zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Hold one block more, if there is one."""
        while True:
            data = self.zip.unconsumed_tail or self.zip.unused_data
            if self.zip.eof:
                self.zip = zlib.decompressobj(31)
            data = data or self.raw.read(READ)
            if not data:
                return False
            out = self.zip.decompress(data, READ)
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is passed; None at the end."""
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a record")
                return None
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def exactly(self, size: int, most: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces of ``most``."""
        while size:
            piece = min(size, most)
            while len(self.held) < piece:
                if not self.more():
                    raise ValueError("the archive ends inside a record")
            yield self.held[:piece]
            self.held, size = self.held[piece:], size - piece


def _parsed(lines: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in lines.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse(path: str, chunk: int = CHUNK) -> Iterator[tuple]:
    """(page_id, url, record_type, refers_to, chunk_no, last, bytes so far, digest, chunk) of an archive's records.

    The digest is the payload's on the last chunk, else None. A revisit has one row without payload, with the size and the digest of
    the payload that it refers to.
    """
    source = _Input(path)
    while (head := source.until(b"\r\n\r\n")) is not None:
        fields = _parsed(head)
        kind, number = fields["warc-type"], fields.get("warc-page-id")
        refers_to = fields["warc-refers-to"].strip("<>").removeprefix(RECORD) if kind == "revisit" else None
        who = (None if number is None else int(number), fields.get("warc-target-uri"), kind, None if refers_to is None else int(refers_to))
        http = source.until(b"\r\n\r\n")
        size, stated = int(fields["content-length"]) - len(http) - 4, fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "revisit":
            yield (*who, 0, True, int(_parsed(http)["content-length"]), stated, b"")
        else:
            sha, seen, n = hashlib.sha1(), 0, 0
            for data in source.exactly(size, chunk) if size else (b"",):
                sha.update(data)
                seen += len(data)
                last = seen == size
                if last and sha.hexdigest() != stated:
                    raise ValueError(f"a payload of {path} does not have its digest")
                yield (*who, n, last, seen, sha.hexdigest() if last else None, data)
                n += 1
        if b"".join(source.exactly(4, 4)) != b"\r\n\r\n":
            raise ValueError(f"a record of {path} does not end where it should")


CHUNK_SCHEMA = "page_id long, url string, record_type string, refers_to long, chunk_no int, last boolean, payload_bytes long, payload_digest string, chunk binary"


def read(spark: SparkSession, archives: DataFrame, payloads: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of the listed archives; without ``payloads`` only each record's last row, its chunk left out."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for listed in batches:
            for path in listed.column(0).to_pylist():
                for row in parse(path, chunk):
                    if payloads or row[5]:
                        rows.append(row if payloads else (*row[:8], None))
                        size += len(row[8]) * payloads + 200
                    if size >= 1 << 22:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    count = max(1, archives.count())
    return archives.select("path").repartition(count).mapInArrow(run, CHUNK_SCHEMA)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to per row.

    Null html is an empty payload, a null url leaves its field out, a null page_id its number; a page without page_id revisits like
    others and is never revisited. Rows with the same page_id and payload are all responses where that is the largest.
    """
    found = read(pages.sparkSession, write(pages), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
