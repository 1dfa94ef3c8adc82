"""WARC archives as Zstandard files: written by tasks, read back through Spark's file reader.

An archive starts with a skippable frame that holds a dictionary; each record is one frame
compressed with it. Equal payloads are stored once: the page with the largest id is the response,
the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.storage import materialize, new_path

# Fixed values of the formats: the magic number of the dictionary's skippable frame, the magic
# number of a dictionary, the profile of a revisit, and the alphabet of base32.
SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 64 << 20  # raw bytes after which a task starts its next archive
SAMPLE_BYTES = 1 << 20  # raw bytes of the leading records a dictionary is trained on
DICTIONARY_BYTES = 16 << 10
STEP_BYTES = 4 << 10

WRITTEN = "archive string, records long"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(page_id or 0) % (1 << 64) + ((page_id is None) << 64))}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.removeprefix("<urn:uuid:").removesuffix(">")).int
    if number >> 64:
        return None
    return number - (1 << 64) if number >> 63 else number


def _clean(url: str | None) -> str:
    """A header value: one line."""
    return re.sub(r"[\r\n]+", " ", url or "")


def encode_record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes, first: str) -> tuple[dict[str, str], bytes]:
    head, gap, rest = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith(first):
        raise ValueError(f"no {first} header block")
    named = dict(line.split(": ", 1) for line in lines[1:])
    return {k.lower(): v for k, v in named.items()}, rest


def decode_record(raw: bytes) -> tuple:
    """Validate headers, lengths and digests; a wrong record is an error, never a shorter one."""
    head, rest = _headers(raw, "WARC/1.1")
    length = int(head["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {head['warc-record-id']}: {len(rest) - 4} bytes, header says {length}")
    block = rest[:length]
    if head["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"record {head['warc-record-id']}: block digest differs")
    http, payload = _headers(block, "HTTP/1.1")
    size, sha1 = int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
    kind, refers = head["warc-type"], None
    if kind == "revisit":
        if payload or head["warc-profile"] != REVISIT_PROFILE:
            raise ValueError(f"record {head['warc-record-id']}: not a revisit by payload")
        refers = page_of(head["warc-refers-to"])
    elif kind != "response" or len(payload) != size or digest(payload) != sha1:
        raise ValueError(f"record {head['warc-record-id']}: payload differs from its header")
    return page_of(head["warc-record-id"]), head["warc-target-uri"], size, sha1, kind, refers, payload


def dictionary_of(records: list[bytes]) -> bytes:
    """A dictionary trained on leading records, or none where they are too few or too alike."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True, write_checksum=True)


def read_archive(content: bytes) -> Iterator[tuple]:
    """Dictionary from the leading skippable frame, then one frame per record."""
    at, dictionary = 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", content, 4)[0]
        stored = content[8 : 8 + size]
        at = 8 + size
        if len(stored) != size:
            raise ValueError("the archive ends inside its dictionary")
        if stored[:4] == zstandard.FRAME_HEADER:  # a dictionary may itself be compressed
            stored = zstandard.ZstdDecompressor().decompress(stored)
        if stored:
            if struct.unpack_from("<I", stored)[0] != DICTIONARY_MAGIC:
                raise ValueError("the leading frame holds no dictionary")
            dictionary = zstandard.ZstdCompressionDict(stored)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(content)
    while at < len(content):
        one, raw = reader.decompressobj(), []
        # Fed in steps: what a step holds beyond the frame's end is all that is handed back.
        while not one.eof and at < len(content):
            raw.append(one.decompress(view[at : at + STEP_BYTES]))
            at += STEP_BYTES
        if not one.eof:
            raise ValueError("the archive ends inside a record")
        at = min(at, len(content)) - len(one.unused_data)
        yield decode_record(b"".join(raw))


class _Archives:
    """The archives of one task; a file appears under its name only when complete."""

    def __init__(self, folder: str, part: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.part, self.number = part, 0
        self.waiting: list[bytes] = []
        self.size = self.count = 0
        self.file = self.frames = None
        self.done: list[tuple[str, int]] = []

    def add(self, record: bytes) -> None:
        self.count += 1
        self.size += len(record)
        if self.file:
            self.file.write(self.frames.compress(record))
        else:
            self.waiting.append(record)
            if self.size >= SAMPLE_BYTES:
                self._open()
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def _open(self) -> None:
        dictionary = dictionary_of(self.waiting)
        self.frames = _compressor(dictionary)
        self.name = f"{self.root}/part-{self.part:06d}-{self.number:04d}.warc.zst"
        self.hidden = f"{self.root}/_{uuid.uuid4().hex}"
        self.file = self.store.open_output_stream(self.hidden, compression=None)
        self.file.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        for record in self.waiting:
            self.file.write(self.frames.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.count and not self.file:
            self._open()
        if self.file:
            self.file.close()
            # A repeated task writes the same archive under the same name.
            self.store.move(self.hidden, self.name)
            self.done.append((self.name, self.count))
            self.number += 1
        self.file, self.size, self.count = None, 0, 0


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``sha1`` (hex) and ``refers_to``: the largest page id of the same payload, if another."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha1"))
    shared = (
        hashed.filter(F.octet_length("html") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("sha1", "response")
    )
    # Only the digests of repeated payloads come back; pages stay where they were read, unless
    # so many payloads repeat that both sides must be sorted.
    joined = hashed.join(shared, "sha1", "left")
    refers = F.when(F.col("response") != F.col("page_id"), F.col("response"))
    return joined.select("page_id", "url", "html", "sha1", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per page into ``folder``; returns ``(archive, records)``, already written.

    NULL html is an empty payload and NULL urls are empty. Pages of a repeated id are records of
    their own. A page whose id is NULL never is a response others refer to. ``folder`` must be a
    URI or path that tasks can open through Arrow (a shared mount, HDFS, an object store).
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = _Archives(folder, TaskContext.get().partitionId())
        for batch in batches:
            for page, url, html, sha1, refers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                short = base64.b32encode(bytes.fromhex(sha1)).decode()
                out.add(encode_record(page, url, html.encode(), short, refers))
        out.close()
        names, counts = zip(*out.done, strict=True) if out.done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return materialize(with_references(pages, min_bytes).mapInArrow(write, WRITTEN), "archives")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in ``folder``; the payload of a revisit is empty.

    A folder without archives gives no rows. Damaged frames, headers, lengths or digests raise.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in read_archive(content.as_py()):
                    rows.append(row)
                    size += len(row[-1])
                    if size > 8 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(read, READ)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` and read them back: one row per page, without payloads."""
    folder = new_path(spark, "warc")
    write_archives(pages, folder, min_bytes)
    return read_archives(spark, folder).drop("payload", "url")
