"""WARC archives, compressed record by record with a dictionary that each file carries.

A file begins with a skippable frame that holds a Zstandard dictionary built from the file's first
records; every record follows as a frame of its own, so that it can be read by itself. Records are WARC/1.1:
a page's html is the payload of a ``response``; a page whose payload another one has already is a ``revisit``,
which holds the digest and refers to that record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import new_scratch_dir
from .files import chunks, new_file, open_stream, qualified
from .tables import partitions, stored

#: Fixed values of the formats: magic number of the dictionary's frame, profile of revisit records.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records that a dictionary is built from, and of the dictionary; bytes of records of one file.
SAMPLE_BYTES, DICTIONARY_BYTES, FILE_BYTES = 1 << 21, 1 << 15, 1 << 28
LEVEL = 3
#: Groups of equal payloads are dealt to so many tasks each.
SALTS = 32
#: Date of records; the pages do not tell when they were fetched.
DATE = "1970-01-01T00:00:00Z"

_SKIPPABLE = struct.Struct("<II")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def format_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        # a url may hold anything; what is not printable ASCII is written as %XX
        "WARC-Target-URI": None if url is None else quote(url, safe="".join(map(chr, range(33, 127))).replace("%", "")),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": _name(refers_to) if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises ValueError if it is not whole."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if first != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    return fields, rest[:length]


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary; the bytes of the records themselves if they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


class ArchiveWriter:
    """Writes one file: the first records wait until there are enough to build the dictionary."""

    def __init__(self, folder: str):
        self.address, self.file = new_file(folder, ".warc.zst")
        self.waiting: list[bytes] = []
        self.compressor = None
        self.bytes = self.records = 0

    def add(self, record: bytes) -> None:
        self.bytes += len(record)
        self.records += 1
        if self.compressor:
            self.file.write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        if self.bytes >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        raw = build_dictionary(self.waiting)
        self.file.write(_SKIPPABLE.pack(DICTIONARY_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        for record in self.waiting:
            self.file.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> None:
        if not self.compressor:
            self._begin()
        self.file.close()


def read_archive(parts: Iterable[bytes]) -> Iterator[bytes]:
    """The records of a file's bytes, one at a time."""
    parts = iter(parts)
    buffer = b""
    while len(buffer) < _SKIPPABLE.size or len(buffer) < _SKIPPABLE.size + _SKIPPABLE.unpack_from(buffer)[1]:
        part = next(parts, None)
        if part is None:
            raise ValueError("no dictionary")
        buffer += part
    magic, size = _SKIPPABLE.unpack_from(buffer)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary")
    raw, buffer = buffer[_SKIPPABLE.size : _SKIPPABLE.size + size], buffer[_SKIPPABLE.size + size :]
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    while True:
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            if not buffer:
                buffer = next(parts, b"")
                if not buffer:
                    if out:
                        raise ValueError("a record is cut off")
                    return
            out.append(frame.decompress(buffer))
            buffer = frame.unused_data
        yield b"".join(out)


def write_archives(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record for each row of ``pages (page_id, url, html, ...)``; returns the stored list ``(file, records, bytes)``.

    The payload is the html in UTF-8; NULL counts as empty. Of records with equal payloads of ``min_bytes`` or more that
    with the largest ``page_id`` is the response and the others revisit it. A row without ``page_id`` is always a response
    that nothing refers to, and so are repeated rows of the largest id, each of them. Other columns are ignored. An empty table
    has no files. Payloads are equal if their SHA-1 and length are, as the format has it.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or new_scratch_dir(spark, "warc"))
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keys = [F.unhex(F.sha1(payload.cast("binary"))).alias("digest"), F.octet_length(payload).alias("size")]
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"), *keys)
    # groups with several ids: counted and combined before the shuffle, so a group of any size is a row
    groups = rows.where(F.col("page_id").isNotNull() & (F.col("size") >= min_bytes)).groupBy("digest", "size")
    groups = groups.agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("other")).where("other < keeper").drop("other")
    groups = stored(groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "payload_groups")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups, ["digest", "size", "salt"], "left")
    refers = F.when(F.col("page_id") < F.col("keeper"), F.col("keeper"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for page_id, url, html, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    writer = ArchiveWriter(folder)
                writer.add(format_record(page_id, url, html.encode("utf-8", "surrogatepass"), to))
                if writer.bytes >= FILE_BYTES:
                    yield _closed(writer)
                    writer = None
        if writer is not None:
            yield _closed(writer)

    listed = joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(run, "file string, records long, bytes long")
    return stored(listed, "archives")


def _closed(writer: ArchiveWriter) -> pa.RecordBatch:
    writer.close()
    return pa.RecordBatch.from_arrays([pa.array([writer.address]), pa.array([writer.records]), pa.array([writer.bytes])], ["file", "records", "bytes"])


def read_archives(files: DataFrame) -> DataFrame:
    """The records of listed files: ``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)``.

    Size and digest of a response are worked out from its payload and must agree with its header; a revisit has them in its header. A
    damaged file raises an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch["file"].to_pylist():
                rows = []
                with open_stream(address) as stream:
                    for raw in read_archive(chunks(stream)):
                        rows.append(_row(*parse_record(raw)))
                        if len(rows) == 1024:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    n = partitions(files.sparkSession)
    return files.select("file").repartition(n, "file").mapInArrow(run, RECORD)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    size, digest = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if (size, digest) != (len(payload), digest_of(payload)):
            raise ValueError("a payload differs from its header")
    return _page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], _page(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in RECORD.split(", ")])
